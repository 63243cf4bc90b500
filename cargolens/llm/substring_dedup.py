"""Substring dedup by fixed-block anchors.

A repeat of ``window`` words always holds one whole block of the text it
repeats when that text is cut into blocks of ``(window + 1) // 2`` words from
its start. So only those non-overlapping blocks are indexed, and every rolling
run of that many words probes the index:

1. probe: documents are dealt into chunks of a bounded size; each chunk sends one entry per
   distinct rolling hash to the hash's bucket, flagged if it is a block there
   and if two documents of the chunk have it. A bucket sends back the hashes
   that are a block of one document and occur in another one: the anchors.
2. extend: around each anchor, as far as ``window`` words reach, the chunk
   sends the hashes of the whole windows with their smallest document, and gets
   the smallest document of all chunks back. Windows that an earlier document
   has, overlapping or in sequence, join to the maximal exact repeats.
3. cut: the words under those windows are removed.

No pairs of documents are built. A passage that a third of all documents share
is one entry per chunk, so neither a bucket nor a chunk grows with the number
of copies. The texts are shuffled once; Spark reuses that exchange in all
three steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from cargolens.llm.textbytes import Words, rolling, slices, utf8
from cargolens.session import staged

#: Ids of documents without one sort behind all others.
NO_ID = np.iinfo(np.int64).max

#: Bytes of text that a chunk holds on average, at most.
CHUNK_BYTES = 16 << 20

PACKED = "bucket int, chunk int, body binary"
RESULT = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, "
    "spans array<struct<start: long, end: long>>"
)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as compressed bytes; equal bytes of all rows stand together."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)
    return len(columns[0]).to_bytes(8, "little") + bytes(pa.compress(planes, "zstd", asbytes=True))


def unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    n = int.from_bytes(body[:8], "little")
    widths = [np.dtype(k).itemsize for k in kinds]
    if not n:
        return [np.zeros(0, k) for k in kinds]
    planes = np.frombuffer(pa.decompress(body[8:], n * sum(widths), "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for k, w in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(planes[at : at + n * w].reshape(w, n).T).view(k).reshape(n))
        at += n * w
    return out


def deltas(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def packed_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    buckets, chunks, bodies = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table(
        {"bucket": pa.array(buckets, pa.int32()), "chunk": pa.array(chunks, pa.int32()), "body": pa.array(bodies, pa.binary())}
    )


def texts_of(table: pa.Table) -> Iterator[tuple[np.ndarray, Words]]:
    """``(doc ids, words)`` of slices of a chunk."""
    ids = table.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
    offsets, data = utf8(table.column("text"))
    for lo, hi in slices(offsets):
        part = offsets[lo : hi + 1]
        yield ids[lo:hi], Words(part - part[0], data[part[0] : part[-1]])


def runs_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(position, row, hash)`` of every ``size`` words that follow each other in a text."""
    rows = words.rows()
    n = len(rows)
    if n < size:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    at = np.flatnonzero(rows[: n - size + 1] == rows[size - 1 :])
    return at, rows[at], rolling(words.hashes(), at, at + size)


def split_hash(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the high half, 32 other bits of the hash in the low half."""
    low = h & np.uint64(0xFFFFFFFF)
    return (((h >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | low


def send(keys: np.ndarray, chunk: int, *more: np.ndarray) -> list[tuple[int, int, bytes]]:
    """One packed row per bucket from keys sorted by bucket."""
    bucket = (keys >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    out = []
    for lo, hi in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
        low = keys[lo:hi].astype(np.uint32)
        out.append((int(bucket[lo]), chunk, pack(deltas(low), *(m[lo:hi] for m in more))))
    return out


def firsts(sorted_keys: np.ndarray) -> np.ndarray:
    """True at the first of equal keys."""
    out = np.ones(len(sorted_keys), bool)
    out[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return out


def probes(window: int, buckets: int):
    block = (window + 1) // 2

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        keys, flags, owner = [], [], []
        for ids, words in texts_of(docs):
            at, row, h = runs_of(words, block)
            whole = (words.counts >= window)[row]
            at, row, h = at[whole], row[whole], h[whole]
            keys.append(split_hash(h, buckets))
            flags.append(((at - words.first[row]) % block == 0).astype(np.uint8))
            owner.append(ids[row])
        k, f, o = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (flags, np.uint8), (owner, np.int64)))
        order = np.argsort(k, kind="stable")
        k, f, o = k[order], f[order], o[order]
        new = firsts(k)
        cuts = np.flatnonzero(new)
        if not len(cuts):
            return packed_table([])
        block_here = np.maximum.reduceat(f, cuts)
        shared = np.minimum.reduceat(o, cuts) != np.maximum.reduceat(o, cuts)
        return packed_table(send(k[cuts], key[0].as_py(), block_here | (shared.astype(np.uint8) << 1)))

    return run


def gathered(table: pa.Table, *kinds: str) -> tuple[np.ndarray, ...]:
    """All entries of a bucket, sorted by key, each with its chunk."""
    parts, chunks = [], []
    for chunk, body in zip(table.column("chunk").to_pylist(), table.column("body").to_pylist(), strict=True):
        part = unpack(body, *kinds)
        part[0] = np.cumsum(part[0], dtype=part[0].dtype)
        parts.append(part)
        chunks.append(np.full(len(part[0]), chunk, np.int32))
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.argsort(columns[0], kind="stable")
    return (*(c[order] for c in columns), np.concatenate(chunks)[order])


def send_back(bucket: int, chunk: np.ndarray, keys: np.ndarray, *more: np.ndarray) -> pa.Table:
    order = np.argsort(chunk, kind="stable")
    chunk, keys, more = chunk[order], keys[order], [m[order] for m in more]
    cuts = np.flatnonzero(firsts(chunk))
    rows = [
        (bucket, int(chunk[lo]), pack(deltas(keys[lo:hi]), *(m[lo:hi] for m in more)))
        for lo, hi in zip(cuts, np.append(cuts, len(chunk))[1:], strict=True)
    ]
    return packed_table(rows)


def anchors(key: tuple, table: pa.Table) -> pa.Table:
    """Of one bucket: hashes that are a block somewhere and occur in two documents."""
    k, f, chunk = gathered(table, "uint32", "uint8")
    new = firsts(k)
    cuts = np.flatnonzero(new)
    many = np.diff(np.append(cuts, len(k))) > 1
    any_flag = np.bitwise_or.reduceat(f, cuts)
    alive = ((any_flag & 1) > 0) & (many | (any_flag >= 2))
    mine = alive[np.cumsum(new) - 1]
    return send_back(key[0].as_py(), chunk[mine], k[mine])


def near_anchor(words: Words, window: int, buckets: int, alive: np.ndarray):
    """``(position, row, hash)`` of the windows that hold an anchor."""
    block = (window + 1) // 2
    at, _, h = runs_of(words, block)
    hit = np.zeros(len(words.starts) + 1, np.int64)
    if len(alive) and len(at):
        k = split_hash(h, buckets)
        place = np.minimum(np.searchsorted(alive, k), len(alive) - 1)
        hit[at[alive[place] == k] + 1] = 1
    sums = np.cumsum(hit)
    at, row, h = runs_of(words, window)
    held = sums[at + window - block + 1] > sums[at]
    return at[held], row[held], h[held]


def alive_keys(back: pa.Table) -> np.ndarray:
    out = []
    for bucket, body in zip(back.column("bucket").to_pylist(), back.column("body").to_pylist(), strict=True):
        (low,) = unpack(body, "uint32")
        out.append(np.cumsum(low, dtype=np.uint32).astype(np.uint64) | np.uint64(bucket << 32))
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def extensions(window: int, buckets: int):
    def run(key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
        alive = alive_keys(back)
        if not len(alive):
            return packed_table([])
        keys, owner = [], []
        for ids, words in texts_of(docs):
            _, row, h = near_anchor(words, window, buckets, alive)
            keys.append(h)
            owner.append(ids[row])
        k, o = np.concatenate(keys), np.concatenate(owner)
        bucket = (k >> np.uint64(32)) % np.uint64(buckets)
        order = np.lexsort((o, k, bucket))
        k, o, bucket = k[order], o[order], bucket[order]
        cuts = np.flatnonzero(firsts(k))
        if not len(cuts):
            return packed_table([])
        last = np.append(cuts[1:], len(k)) - 1
        shared = (o[cuts] != o[last]).astype(np.uint8)
        k, o, bucket = k[cuts], o[cuts], bucket[cuts].astype(np.int64)
        rows = []
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(k)), strict=True):
            rows.append((int(bucket[lo]), key[0].as_py(), pack(deltas(k[lo:hi]), o[lo:hi], shared[lo:hi])))
        return packed_table(rows)

    return run


def earliest(key: tuple, table: pa.Table) -> pa.Table:
    """Of one bucket: the smallest document of each window that two documents have."""
    k, o, shared, chunk = gathered(table, "uint64", "int64", "uint8")
    new = firsts(k)
    cuts = np.flatnonzero(new)
    first_doc = np.minimum.reduceat(o, cuts)
    several = (np.diff(np.append(cuts, len(k))) > 1) | (np.maximum.reduceat(shared, cuts) > 0)
    run = np.cumsum(new) - 1
    mine = several[run]
    return send_back(key[0].as_py(), chunk[mine], k[mine], first_doc[run][mine])


def cutting(window: int, with_text: bool):
    def run(key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
        keys, first_doc = [], []
        for body in back.column("body").to_pylist():
            k, o = unpack(body, "uint64", "int64")
            keys.append(np.cumsum(k, dtype=np.uint64))
            first_doc.append(o)
        k = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        o = np.concatenate(first_doc) if keys else np.zeros(0, np.int64)
        order = np.argsort(k)
        k, o = k[order], o[order]
        done = []
        for ids, words in texts_of(docs):
            steps = np.zeros(len(words.starts) + 1, np.int32)
            if len(k):
                at, row, h = runs_of(words, window)
                place = np.minimum(np.searchsorted(k, h), len(k) - 1)
                at = at[(k[place] == h) & (o[place] < ids[row])]
                steps[at] += 1
                steps[at + window] -= 1
            gone = np.cumsum(steps[:-1]) > 0
            sums = np.zeros(len(gone) + 1, np.int64)
            np.cumsum(gone, out=sums[1:])
            removed = np.diff(sums[words.first])
            offsets, kept = words.joined(~gone)
            raw, ends = kept.tobytes(), offsets.tolist()
            texts = [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            columns = {
                "doc_id": pa.array(ids, pa.int64(), mask=ids == NO_ID),
                "n_words": pa.array(words.counts),
                "n_removed": pa.array(removed),
                "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
            }
            if with_text:
                columns["kept_text"] = pa.array([t.decode() for t in texts], pa.string())
                columns["spans"] = spans_of(words, gone)
            done.append(pa.table(columns))
        return pa.concat_tables(done)

    return run


def spans_of(words: Words, gone: np.ndarray) -> pa.Array:
    """Maximal removed repeats of each text as word ranges ``[start, end)``."""
    rows = words.rows()
    edge = np.ones(len(gone) + 1, bool)
    if len(gone):
        edge[1:-1] = (gone[1:] != gone[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(edge)
    lo, hi = at[:-1], at[1:]
    lo, hi = lo[gone[lo]], hi[gone[lo]]
    base = words.first[rows[lo]]
    item = pa.StructArray.from_arrays([pa.array(lo - base), pa.array(hi - base)], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(lo, words.first), pa.int32()), item)


def in_one_order(docs: DataFrame) -> DataFrame:
    """``docs``, staged if its plan has a shuffle, whose rows come in another order each time."""
    plan = docs._jdf.queryExecution().executedPlan().toString()
    return staged(docs, "ordered") if "Exchange" in plan else docs


def chunks_for(docs: DataFrame) -> int:
    """The session's shuffle partitions, or as many as leave each chunk CHUNK_BYTES of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // CHUNK_BYTES))


def one_a_task(rows: DataFrame, key: str, n: int) -> GroupedData:
    """Groups of ``key``, the numbers below ``n``, each in the partition of its number."""
    return rows.repartitionById(n, F.col(key)).groupBy(key)


def remove_repeats(docs: DataFrame, window: int = 50, chunks: int | None = None, with_text: bool = True) -> DataFrame:
    """Each document without the words that ``window`` words of an earlier document cover.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. A null
    text is empty; a document without an id comes after all others and is never
    removed on account of one without. Rows of one id are one document for the
    purpose of "earlier", so they do not remove each other's words. Returns a
    row per input row: ``doc_id, n_words, n_removed, kept_sha256`` and, unless
    ``with_text`` is false, ``kept_text`` (kept words joined by one blank) and
    ``spans`` (removed repeats as word ranges).

    ``chunks`` is the number of chunks and of buckets, a task each. By default
    it is the session's shuffle partitions, or more where a chunk would then hold
    over CHUNK_BYTES of text, for which the lengths of the texts are summed
    first. Rows are dealt by their place in the input, so that a row that is
    repeated goes to all chunks; for that the rows have to come in one order each
    time they are read. Those of files do, and an input with a shuffle in it is
    staged first. Equality of windows is equality of 64-bit hashes.
    """
    if window < 2:
        raise ValueError("window must be 2 or more words")
    docs = in_one_order(docs.select("doc_id", "text"))
    n = chunks or chunks_for(docs)
    place = F.xxhash64(F.monotonically_increasing_id())
    dealt = docs.withColumn("chunk", F.pmod(place, F.lit(n)).cast("int"))
    by_chunk = one_a_task(dealt, "chunk", n)
    found = one_a_task(by_chunk.applyInArrow(probes(window, n), PACKED), "bucket", n).applyInArrow(anchors, PACKED)
    grown = by_chunk.cogroup(one_a_task(found, "chunk", n)).applyInArrow(extensions(window, n), PACKED)
    first = one_a_task(grown, "bucket", n).applyInArrow(earliest, PACKED)
    schema = RESULT if with_text else RESULT.partition(", kept_text")[0]
    return by_chunk.cogroup(one_a_task(first, "chunk", n)).applyInArrow(cutting(window, with_text), schema)
