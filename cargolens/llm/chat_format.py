"""Chat formatting with offset-aligned loss masks.

Whole conversations are rendered with a template, encoded once, and the sorted
spans of the turns' texts are intersected with the token spans by binary
search: a token that touches a trained role's text is under the loss mask.

Control strings mark turns and are single tokens of their own. Inside roles
and texts a backslash after their first character takes their meaning away
(backslashes are doubled), so a rendered conversation reads back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters after which a conversation goes on in a further row, at the next turn.
PART_CHARS = 4_000_000

#: Runs of white space, as the pattern of the tokenizer has it, that are cut out before the library sees the text.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{256,}")


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings around a role and its text; ``trained`` roles are under the loss."""

    open_turn: str = "[INST]"
    close_turn: str = "[/INST]"
    open_trained: str = "<s>"
    close_trained: str = "</s>"
    body: str = "[TEXT]"
    trained: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, ...]:
        return self.open_turn, self.close_turn, self.open_trained, self.close_trained, self.body

    @cached_property
    def _special(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, ("\\", *sorted(self.controls, key=len, reverse=True)))))

    @cached_property
    def _turn(self) -> re.Pattern:
        o, c, ot, ct, b = map(re.escape, self.controls)
        return re.compile(f"(?:{o}|{ot})(.*?){b}(.*?)(?:{c}|{ct})", re.DOTALL)

    def escape(self, text: str) -> str:
        return self._special.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, bool]]]:
        """The formatted text and, per turn, the span of its escaped text and whether it is trained."""
        pieces, spans, at = [], [], 0
        for role, text in turns:
            trained = role in self.trained
            head = (self.open_trained if trained else self.open_turn) + self.escape(role) + self.body
            body = self.escape(text)
            tail = self.close_trained if trained else self.close_turn
            pieces += head, body, tail
            spans.append((at + len(head), at + len(head) + len(body), trained))
            at += len(head) + len(body) + len(tail)
        return "".join(pieces), spans

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted text."""
        out, at = [], 0
        for m in self._turn.finditer(formatted):
            if m.start() != at:
                raise ValueError("not a formatted conversation")
            out.append((self.unescape(m[1]), self.unescape(m[2])))
            at = m.end()
        if at != len(formatted):
            raise ValueError("not a formatted conversation")
        return out


class Tokens:
    """Encodes rendered text and keeps the byte span of every token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, template: ChatTemplate):
        top = max(ranks.values()) + 1
        special = {c: top + i for i, c in enumerate(template.controls)}
        self._control = re.compile("|".join(map(re.escape, special)))
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.lengths = np.zeros(top + len(special), np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        for token, i in special.items():
            self.lengths[i] = len(token.encode())

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, edges)``: token k covers bytes ``edges[k]:edges[k + 1]``.

        The library's pattern cannot match a very long run of white space. All
        of such a run but the character before a word is one pre-token, which is
        merged by itself; what stands around it is encoded as ever.
        """
        ids, at = [], 0
        for run in LONG_BLANK.finditer(text) if LONG_BLANK.search(text) else ():
            # at the end of the text, or before a control string, the whole run is one pre-token
            ends = run.end() == len(text) or self._control.match(text, run.end())
            end = run.end() if ends else run.end() - 1
            ids += self.encoding.encode(text[at : run.start()], allowed_special="all")
            ids += self.encoding._encode_single_piece(text[run.start() : end].encode())
            at = end
        ids = np.array(ids + self.encoding.encode(text[at:], allowed_special="all"), np.int64)
        return ids, np.concatenate([[0], np.cumsum(self.lengths[ids])])


def loss_mask(edges: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """True for tokens that overlap one of the sorted ``[start, end)`` byte spans."""
    steps = np.zeros(len(edges), np.int32)
    spans = spans[spans[:, 0] < spans[:, 1]]
    np.add.at(steps, np.searchsorted(edges[1:], spans[:, 0], "right"), 1)
    np.add.at(steps, np.searchsorted(edges[:-1], spans[:, 1], "left"), -1)
    return np.cumsum(steps[:-1]) > 0


def masked(formatted: str, ids: np.ndarray, loss: np.ndarray, lengths: np.ndarray) -> list[str]:
    """The pieces of a formatted text under the mask; ``lengths`` are the tokens' bytes by id."""
    raw = formatted.encode()
    edges = np.concatenate([[0], np.cumsum(lengths[ids])])
    change = np.flatnonzero(np.diff(loss.astype(np.int8), prepend=0, append=0))
    return [raw[edges[a] : edges[b]].decode() for a, b in change.reshape(-1, 2)]


def byte_spans(text: str, spans: list[tuple[int, int, bool]]) -> np.ndarray:
    """Spans of trained texts in UTF-8 bytes."""
    chars = np.array([s[:2] for s in spans if s[2]], np.int64).reshape(-1, 2)
    if text.isascii():
        return chars
    starts = np.flatnonzero((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(text.encode()))[chars]


SCHEMA = "conv_id {id}, part int, n_turns long, formatted string, ids array<int>, loss array<boolean>"


def format_conversations(
    turns: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    template: ChatTemplate | None = None,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """``conv_id, part, n_turns, formatted, ids, loss`` of all conversations.

    ``turns`` has ``conv_id, turn, role, text``; others are not read. A
    conversation's rows are taken by turn (null first; rows of one turn by role
    and text; repeated rows stay). Null role or text is empty; rows without a
    ``conv_id`` are one conversation. The rows of a conversation meet in one
    task in order, as a stream: ``part`` 0 is the whole of it, and one longer
    than ``part_chars`` goes on, between two turns, in further rows. Control
    strings are tokens of their own, so the parts' ids are those of the whole.
    Runs of white space may be of any length.
    """
    template = template or ChatTemplate()
    shared = turns.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None

        def finished(rows: list) -> pa.RecordBatch:
            nonlocal tokens
            tokens = tokens or Tokens(*shared.value, template)
            columns: list[list] = [[], [], [], [], [], []]
            for conv, part, said in rows:
                text, spans = template.render(said)
                ids, edges = tokens.encode(text)
                mask = loss_mask(edges, byte_spans(text, spans))
                for column, value in zip(columns, (conv, part, len(said), text, ids.astype(np.int32), mask), strict=True):
                    column.append(value)
            kinds = [batch.schema.field("conv_id").type, pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_())]
            names = ["conv_id", "part", "n_turns", "formatted", "ids", "loss"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        done, said, conv, part, chars, waiting = [], [], None, 0, 0, 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for c, role, text in zip(*columns, strict=True):
                if said and (c != conv or chars >= part_chars):
                    done.append((conv, part, said))
                    waiting += chars
                    part, chars, said = (part + 1 if c == conv else 0), 0, []
                    if waiting >= PART_CHARS // 4:
                        yield finished(done)
                        done, waiting = [], 0
                elif not said:
                    part = 0
                conv = c
                said.append((role or "", text or ""))
                chars += len(role or "") + len(text or "")
        if said:
            yield finished([*done, (conv, part, said)])

    kind = turns.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    dealt = turns.select(*order).repartition("conv_id").sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in order))
    return dealt.mapInArrow(run, SCHEMA.format(id=kind))
