"""Registered queries of the training-data operators, and their DuckDB text where SQL has one."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.llm import (
    bpe,
    chat_format,
    collocations,
    fingerprint,
    hard_negatives,
    langid,
    mixing,
    neighbours,
    reachable,
    secrets,
    simhash,
    substring_dedup,
    topk,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reachable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_substring_dedup",
    f"""
    with w as (select doc_id, {WORDS} as ws from documents),
    win as (
      select doc_id, i, array_to_string(ws[i:i + 49], ' ') as k
      from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 48, 1))) as i from w)
    ),
    earliest as (select k, min(doc_id) as m from win group by k),
    gone as (
      select distinct doc_id, unnest(range(i, i + 50)) as p
      from win join earliest using (k) where m < doc_id
    ),
    words as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as p from w),
    kept as (
      select doc_id, string_agg(word, ' ' order by p) as t, count(*) as n
      from words anti join gone using (doc_id, p) group by doc_id
    )
    select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
      sha256(coalesce(t, '')) as kept_sha256
    from w left join kept using (doc_id)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=50, with_text=False)


def ranks_of(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


TEMPLATE = chat_format.ChatTemplate()


def escaped(text: str) -> str:
    """SQL of the template's escape."""
    sql = f"replace({text}, '\\', '\\\\')"
    for c in TEMPLATE.controls:
        sql = f"replace({sql}, '{c}', '{c[0]}\\{c[1:]}')"
    return sql


@query(
    "op2_chat_formatting",
    f"""
    with c as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
      union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
      union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ),
    marked as (
      select *, case when role = 'assistant' then {len(TEMPLATE.open_trained + TEMPLATE.close_trained + TEMPLATE.body)}
        else {len(TEMPLATE.open_turn + TEMPLATE.close_turn + TEMPLATE.body)} end
        + length({escaped("role")}) + length({escaped("text")}) as chars
      from c
    ),
    agreed as (
      select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
        coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as loss,
        sum(chars) as chars
      from marked group by conv_id
    )
    select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss)::bigint as loss_chars,
      sha256(loss) as loss_sha256, chars::bigint as formatted_chars
    from agreed
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(*added.columns).unionByName(added)
    ranks = ranks_of("byte_bpe_multi_50k.tiktoken")
    made = chat_format.format_conversations(turns, ranks, public_tokenizers.PATTERN, TEMPLATE)
    lengths = chat_format.Tokens(ranks, public_tokenizers.PATTERN, TEMPLATE).lengths
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations read back from the formatted texts and masks; their parts follow each other."""
        state: list | None = None

        def line(s: list) -> pa.RecordBatch:
            conv, n, turns, chars, loss, formatted = s
            values = [conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                conv, part, text, ids, loss = (batch.column(c)[i] for c in ("conv_id", "part", "formatted", "ids", "loss"))
                if part.as_py() == 0:
                    if state:
                        done.append(line(state))
                    state = [conv.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                formatted = text.as_py()
                for role, said in TEMPLATE.read(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                mask = loss.values.to_numpy(zero_copy_only=False)
                for run in chat_format.masked(formatted, ids.values.to_numpy(), mask, lengths):
                    said = TEMPLATE.unescape(run)
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(formatted)
            if done:
                yield pa.concat_batches(done)
        if state:
            yield line(state)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return made.mapInArrow(digests, schema)


@query("op3_document_fingerprints")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.against_edits(table(spark, sf_dir, "documents"), with_texts=False)
    return found.drop("text").withColumnRenamed("edited", "edited_sha256")


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary, packed=True)
    return bpe.decode(encoded, vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op5_secret_scans")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("secrets", lambda s: s["number"] < len(kinds))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


@query(
    "op6_exact_topk",
    """
    with v as (
      select vec_id, [floor(1024 * x::double) for x in embedding] as v from embeddings
      where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    ),
    scored as (
      select q.vec_id as query_id, d.vec_id, list_inner_product(q.v, d.v)::bigint as score
      from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 100 = 0
    )
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
    from scored qualify rank <= 10
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), topk.scaled(F.col("embedding")).alias("vec"))
    return topk.top_k(data.filter(F.col("id") % 100 == 0), data, k=10)


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.learn(docs))
    return found.select(
        "doc_id", langid.held_out().alias("held_out"), F.col("language.pred").alias("lang_pred"), F.col("language.score").alias("score")
    )


@query(
    "op8_source_mixing",
    f"""
    with d as (select doc_id, source, len({WORDS})::bigint as size from documents),
    drawn as (
      select *, ('0x' || substr(md5('1:' || coalesce(doc_id::varchar, 'null') || ':' || coalesce(source, 'null') || ':' || size || ':' || copy), 1, 12))::bigint as draw
      from (select *, row_number() over (partition by doc_id, source, size) - 1 as copy from d)
    ),
    s as (select source, sum(size)::bigint as source_size from d group by source),
    weighed as (
      select *, [3.0, 1.0, 2.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight,
        2.0::double * source_size as at_most
      from s
    ),
    level as (
      select *,
        greatest(1.5::double * sum(source_size) over () - coalesce(sum(at_most) over b, 0), 0)
          / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
      from weighed
      window b as (order by at_most / weight, source nulls last rows between unbounded preceding and 1 preceding)
    ),
    t as (
      select source, source_size,
        case when at_most <= level * weight then at_most
          else max(level) filter (where at_most > level * weight) over () * weight end as target
      from level
    ),
    p as (
      select *, case when source_size > 0 then floor(target / source_size) else 0 end as certain,
        target - case when source_size > 0 then floor(target / source_size) else 0 end * source_size as rest
      from t
    ),
    reached as (
      select p.source, sum(least(size::double, rest)) as reach from drawn join p on drawn.source is not distinct from p.source group by 1
    ),
    odds as (
      select drawn.*, p.source_size, p.target, p.certain, p.rest, (draw + 0.5::double) / 281474976710656::double as u,
        case when rest > 0 and reach > 0 then rest / reach * case when size > rest then rest / size else 1 end end as i
      from drawn join p on drawn.source is not distinct from p.source join reached r on drawn.source is not distinct from r.source
    ),
    ranked as (
      select *, case when i < 1 then (u / (1 - u)) / (i / (1 - i)) when i >= 1 then 0 end as ratio from odds
    ),
    numbered as (
      select *, least(floor(ratio / (1 + ratio) * 281474976710656::double)::bigint, 281474976710655) as place from ranked
    ),
    first as (
      select *, coalesce(size <= 2 * rest and sum(case when size <= 2 * rest then size end) over o - size / 2.0 <= rest, false) as in1
      from numbered window o as (partition by source order by place, doc_id, size, copy)
    ),
    left1 as (select *, rest - sum(case when in1 then size else 0 end) over (partition by source) as rest2 from first),
    second as (
      select *, coalesce(not in1 and rest2 > 0 and size <= 2 * rest2 and i is not null
        and sum(case when not in1 and size <= 2 * rest2 then size end) over o - size / 2.0 <= rest2, false) as in2
      from left1 window o as (partition by source order by place, doc_id, size, copy)
    ),
    left2 as (select *, rest2 - sum(case when in2 then size else 0 end) over (partition by source) as rest3 from second),
    third as (
      select *, coalesce(not in1 and not in2 and rest3 > 0 and size <= 2 * rest3 and i is not null
        and sum(case when not in1 and not in2 and size <= 2 * rest3 then size end) over o - size / 2.0 <= rest3, false) as in3
      from left2 window o as (partition by source order by place, doc_id, size, copy)
    )
    select doc_id, size, source_size, target, (size * (certain + case when in1 or in2 or in3 then 1 else 0 end))::bigint as taken
    from third
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("mix.size") * F.col("mix.copies")).alias("taken")
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", taken)


@query("op9_simhash_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


@query(
    "op10_warc",
    """
    with p as (select page_id, coalesce(html, '') as html from pages),
    d as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as h, max(page_id) over (partition by html) as keeper from p)
    select page_id, payload_bytes,
      array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::int >> (15 - 5 * (i % 4))) & 31)::int, 1)
        for i in range(0, 32)], '') as payload_digest,
      case when page_id < keeper then 'revisit' else 'response' end as record_type,
      case when page_id < keeper then keeper end as refers_to
    from d
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(table(spark, sf_dir, "pages"), least_bytes=0)
    return records.select(
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


@query(
    "op11_hard_negatives",
    """
    with v as (
      select vec_id, [floor(256 * x::double) for x in embedding] as v, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
      from embeddings
      where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    ),
    scored as (
      select q.vec_id as anchor_id, d.vec_id, q.label = d.label as same, list_inner_product(q.v, d.v)::bigint as score
      from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 100 = 0
    ),
    positive as (
      select anchor_id, vec_id as positive_id, score as positive_score from scored where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
    ),
    negative as (
      select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
        row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank
      from positive join scored using (anchor_id)
      where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
    )
    select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negative where rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    vec = topk.scaled(F.col("embedding"), 256).alias("vec")
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), vec, moved)
    return hard_negatives.mine(rows, rows.filter(F.col("id") % 100 == 0), positives=5, negatives=10, low=30, high=90)


@query(
    "op12_phrase_collocations",
    r"""
    with piece as (
      select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws
      from (
        select lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents)
    ),
    run as (
      select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase
      from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from piece, (values (1), (2), (3)) t(k))
    ),
    f as (select lang, k, phrase, count(*) as f from run group by all having count(*) >= 10),
    total as (select lang, count(*) as n from run where k = 1 group by lang),
    cut as (
      select lang, size, phrase, a, c as k, array_to_string(w[1:c], ' ') as head, array_to_string(w[c + 1:], ' ') as tail
      from (select lang, k as size, phrase, f as a, string_split(phrase, ' ') as w, unnest(range(1, k)) as c from f where k > 1)
    ),
    scored as (
      select cut.lang, cut.size, cut.phrase, a, h.f as l, t.f as r, (1000000::hugeint * a * a // (h.f::hugeint * t.f))::bigint as score
      from cut join f h on h.lang = cut.lang and h.phrase = head join f t on t.lang = cut.lang and t.phrase = tail
      qualify row_number() over (partition by cut.lang, cut.phrase order by score, cut.k) = 1
    ),
    around as (
      select lang, phrase, max(f) as around from (
        select lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) as phrase
        from f where k = 3)
      group by all
    ),
    kept as (
      select * from scored left join around using (lang, phrase) where around is null or 100 * around < 50 * a
    )
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
    from kept join total using (lang) qualify rank <= 2000
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, longest=3, cover=50, top=2000)


@query("op13_nearest_neighbours")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return neighbours.nearest_neighbours(data.filter(F.col("id") % 50 == 0), data, k=5)
