import base64
import random

import numpy as np
import public_tokenizers
import pytest

from cargolens.llm.chat_format import ChatTemplate, Tokens, format_conversations, loss_mask

T = ChatTemplate()


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def chat(spark, rows, ranks, **settings):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    return format_conversations(df, ranks, public_tokenizers.PATTERN, **settings).collect()


def brute(rows):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[:2]) + tuple((x is not None, x or "") for x in r[2:])
    out = {}
    for conv, _, role, text in sorted(rows, key=key):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def check(got, rows, ranks):
    want, by_id = brute(rows), {i: t for t, i in ranks.items()}
    top = max(by_id) + 1
    by_id |= {top + i: c.encode() for i, c in enumerate(T.controls)}
    turns, trained = {}, {}
    for r in sorted(got, key=lambda r: r.part):
        turns.setdefault(r.conv_id, []).extend(T.read(r.formatted))
        assert b"".join(by_id[i] for i in r.ids).decode() == r.formatted
        assert r.n_turns == len(T.read(r.formatted))
        loss = b"".join(by_id[i] for i, m in zip(r.ids, r.loss, strict=True) if m)
        trained[r.conv_id] = trained.get(r.conv_id, "") + T.unescape(loss.decode())
    assert turns == want
    assert trained == {c: "".join(t for role, t in said if role == "assistant") for c, said in want.items()}


def test_conversations(spark, ranks):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    check(format_conversations(table, ranks, public_tokenizers.PATTERN).collect(), rows, ranks)


def test_odd_rows(spark, ranks):
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 0, None, None), (1, 0, None, None),
            (2, None, "assistant", ""), (2, 1, "ass\nis[TEXT]tant", "\\"), (2, 1, "assistant", "\\<s>\\\\[INST]<\\s>"), (None, 3, "user", "no id"),
            (None, 1, "assistant", "\n\n  é👍"), (3, 0, "assistant", "<"), (3, 1, "assistant", "[TEXT]"), (4, 0, "user", "x " * 300_000),
            (4, 1, "assistant", "y" * 1000), (5, 0, "assistant", "\n"), (5, 0, "assistant", " ")]
    check(chat(spark, rows, ranks), rows, ranks)


def test_long_conversation_goes_on_in_parts(spark, ranks):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " * 9) for i in range(200)] + [(2, 0, "user", "a")]
    whole, parts = chat(spark, rows, ranks), chat(spark, rows, ranks, part_chars=500)
    assert len(parts) > len(whole) == 2
    check(parts, rows, ranks)
    joined = [i for r in sorted(parts, key=lambda r: r.part) if r.conv_id == 1 for i in r.ids]
    assert joined == next(r.ids for r in whole if r.conv_id == 1)


def test_empty_table(spark, ranks):
    assert chat(spark, [], ranks) == []


def test_escapes_read_back():
    rng = random.Random(2)
    parts = [*T.controls, "\\", "<", "[", "s>", "INST]", "/", "a", "\n", "]", ">"]
    for _ in range(2000):
        turns = [(rng.choice(["user", "assistant", "".join(rng.choices(parts, k=3))]), "".join(rng.choices(parts, k=rng.randrange(9)))) for _ in range(4)]
        text, spans = T.render(turns)
        assert T.read(text) == turns
        assert [T.unescape(text[a:b]) for a, b, _ in spans] == [t for _, t in turns]
    with pytest.raises(ValueError):
        T.read("loose text")


def test_mask_against_every_pair():
    rng = np.random.default_rng(3)
    for _ in range(200):
        edges = np.concatenate([[0], np.cumsum(rng.integers(1, 5, rng.integers(1, 12)))])
        marks = np.sort(rng.integers(0, edges[-1] + 1, 2 * rng.integers(0, 4))).reshape(-1, 2)
        want = [any(s < e and a < e and s < b for s, e in marks) for a, b in zip(edges, edges[1:], strict=False)]
        assert loss_mask(edges, marks).tolist() == want


@pytest.mark.parametrize("blank", [" ", "\n", "\t", " \n", "\u3000"])
@pytest.mark.parametrize("around", ["{}", "{}word", "word{}", "a{}b{}[INST]c", "{}\x1c."])
def test_runs_of_white_space(ranks, blank, around):
    """As the library would, where it can; the pattern's own limit is far above these."""
    tokens = Tokens(ranks, public_tokenizers.PATTERN, T)
    for n in (255, 256, 257, 5000):
        text = around.replace("{}", blank * n)
        assert tokens.encode(text)[0].tolist() == tokens.encoding.encode(text, allowed_special="all")


def test_very_long_runs_of_white_space(spark, ranks):
    texts = [" " * 3_000_000, "\n" * 3_000_000 + "word", "\t" * 3_000_000, "a" + " \n" * 1_500_000 + "b"]
    rows = [(i, 0, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    check(chat(spark, rows, ranks), rows, ranks)
