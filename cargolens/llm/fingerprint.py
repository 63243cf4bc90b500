"""Document fingerprints: improbable-feature digests in chained Bloom filters.

Every window of ``WINDOW`` bytes is ranked by the entropy of its bytes; windows
of running text crowd at middling entropies, so the higher a window's entropy
the rarer it is. A window is a feature if it has the best rank among the
windows that start within ``WINDOW`` bytes of it often enough. Features are put
into Bloom filters, a new one chained on whenever one is full. Two digests are
compared by the bits their filters have in common beyond chance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.textbytes import rolling, slices, utf8

#: Bytes of a window, spans it must win, and ranks that entropies are told apart by.
WINDOW, WINS, RANKS = 32, 8, 1000

#: Bits of a filter, bits set per feature, features until the next filter is chained on.
FILTER_BITS, BITS_PER_FEATURE, FEATURES = 2048, 5, 160

#: Bytes worked on at a time, few enough to stay in a processor's cache.
SLICE = 1 << 18

#: ``count * log2(count)`` in whole steps, so that sums over a text are exact.
STEP = 1 << 20
WEIGHTED = np.array([0, *(round(c * np.log2(c) * STEP) for c in range(1, WINDOW + 1))], np.int64)


def window_sums(data: np.ndarray) -> np.ndarray:
    """Sum of ``count * log2(count)`` over the bytes of each window, by what enters and leaves it."""
    n = len(data)
    order = np.argsort(data, kind="stable")
    small = n < 1 << 22
    keys = (data[order].astype(np.int32 if small else np.int64) << (22 if small else 40)) + order.astype(np.int32 if small else np.int64)
    # counts of the same byte from each place on and before it; pairs m places apart in the order of bytes
    ahead, behind = np.ones(n, np.int8), np.zeros(n, np.int8)
    m, at = 1, None
    while m < min(n, WINDOW) and at is None:
        close = (keys[m:] - keys[:-m]) < WINDOW
        ahead[:-m] += close
        behind[m:] += close
        if np.count_nonzero(close) < n >> 5:
            at = np.flatnonzero(close)
        m += 1
    while at is not None and len(at):
        at = at[at + m < n]
        at = at[keys[at + m] - keys[at] < WINDOW]
        ahead[at] += 1
        behind[at + m] += 1
        m += 1
    leaves, enters = np.empty(n, np.int64), np.empty(n, np.int64)
    leaves[order] = WEIGHTED[ahead] - WEIGHTED[ahead - 1]
    enters[order] = WEIGHTED[behind + 1] - WEIGHTED[behind]
    sums = np.cumsum(enters)[WINDOW - 1 :]
    sums[1:] -= np.cumsum(leaves)[: n - WINDOW]
    return sums


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of the features of texts that lie one behind the other, in order.

    A text that has none is a feature as a whole; an empty one has none.
    """
    n, lengths = len(data), np.diff(offsets)
    row, start = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n >= WINDOW:
        # ranks are kept above positions, so that a maximum is the best rank furthest left
        entropy = (np.log2(WINDOW) * WINDOW * STEP - window_sums(data)) / (WINDOW * STEP)
        rank = np.rint(entropy * (RANKS / np.log2(WINDOW))).astype(np.int64) + 1
        whole = np.zeros(n + 1, np.int32)
        long = lengths >= WINDOW
        whole[offsets[:-1][long]] += 1
        np.add.at(whole, offsets[1:][long] - WINDOW + 1, -1)
        inside = np.cumsum(whole[:-1])[: n - WINDOW + 1] > 0
        width = n.bit_length()
        low = (1 << width) - 1
        best = np.where(inside, rank << width | (low - np.arange(len(rank))), 0)
        best = np.append(best, np.zeros(WINDOW - 1, np.int64))
        reach = 1
        while reach < WINDOW:  # best of 2, 4, ... windows from each place on
            best[:-reach] = np.maximum(best[:-reach], best[reach:])
            reach *= 2
        winner = np.where(inside, low - (best[: len(rank)] & low), -1)
        edge = np.flatnonzero(np.append(True, winner[1:] != winner[:-1]))
        wins = np.diff(np.append(edge, len(winner)))
        start = winner[edge[(wins >= WINS) & (winner[edge] >= 0)]]
        row = np.searchsorted(offsets, start, "right") - 1
    hashes = rolling(data, start, start + WINDOW)
    have = np.zeros(len(lengths), bool)
    have[row] = True
    alone = np.flatnonzero(~have & (lengths > 0))
    row = np.concatenate([row, alone])
    hashes = np.concatenate([hashes, rolling(data, offsets[alone], offsets[alone + 1])])
    order = np.lexsort((hashes, row))
    again = np.zeros(len(order), bool)
    again[1:] = (row[order][1:] == row[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    first = np.sort(order[~again])
    order = first[np.argsort(row[first], kind="stable")]
    return row[order], hashes[order]


def filters(offsets: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
    """Per text its chained filters, a row of bits each."""
    row, hashes = features(offsets, data)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    chained = -(-counts // FEATURES)
    base = np.concatenate([[0], np.cumsum(chained)])
    bits = np.zeros((int(base[-1]), FILTER_BITS), bool)
    place = base[row] + number // FEATURES
    for i in range(BITS_PER_FEATURE):
        bits[place, (hashes >> np.uint64(11 * i)).astype(np.int64) % FILTER_BITS] = True
    return [bits[a:b] for a, b in zip(base, base[1:], strict=False)]


def to_text(chain: np.ndarray) -> str:
    """Filters as base64, joined by commas; empty for an empty text."""
    return ",".join(base64.b64encode(np.packbits(f).tobytes()).decode() for f in chain)


def from_text(text: str) -> np.ndarray:
    chain = [np.unpackbits(np.frombuffer(base64.b64decode(f), np.uint8)) for f in text.split(",")] if text else []
    return np.array(chain, bool).reshape(-1, FILTER_BITS)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: each filter of the shorter chain against the one most like it, by bits set.

    The bits two filters share are counted from what chance gives (0) to the
    smaller one's whole (1). Equal digests are 1, empty ones like nothing else.
    """
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    x, y = a.astype(np.float32), b.astype(np.float32)
    common, in_a, in_b = x @ y.T, x.sum(1)[:, None], y.sum(1)[None, :]
    chance, least = in_a * in_b / FILTER_BITS, np.minimum(in_a, in_b)
    share = np.where(least > chance, (common - chance) / np.maximum(least - chance, 1e-9), common == least)
    best = np.clip(share.max(1), 0, 1)
    return float((best * in_a[:, 0]).sum() / in_a.sum())


def fingerprints(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (``text``) and ``fingerprint``; equal texts have equal ones, null is empty."""
    if "fingerprint" in docs.columns:
        raise ValueError("there is a column fingerprint already")

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            offsets, data = utf8(text)
            out = []
            for lo, hi in slices(offsets, SLICE):
                out += map(to_text, filters(offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]))
            yield pa.array(out, pa.string())

    return docs.withColumn("fingerprint", F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)("text"))


def likenesses(pairs: DataFrame, a: str, b: str, name: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of two fingerprint columns; null where one is null."""

    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        both = zip(x.to_pylist(), y.to_pylist(), strict=True)
        return pa.array([None if p is None or q is None else likeness(from_text(p), from_text(q)) for p, q in both], pa.float64())

    return pairs.withColumn(name, F.arrow_udf(run, "double", F.ArrowUDFType.SCALAR)(a, b))


def dealt_in_order(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, text, range, borrowed``, sorted in each partition: the order of all, in stretches.

    A range of ids is one stretch; the first document of the range after it
    (after the last: of the first) stands borrowed at its end, so every
    document has its successor beside it. Documents of one id are in order of
    their texts; null ids come first. The bounds and the borrowed documents are
    as many as there are ranges.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = ranges or 8 * partitions
    shares = [i / n for i in range(1, n)]
    found = docs.select(F.percentile_approx("doc_id", shares, 20 * n)).first()[0] if shares else []
    bounds = np.unique(np.array(found or [], np.int64))

    def number(ids: pa.Array) -> pa.Array:
        place = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), "left").astype(np.int32)
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), -1, place), pa.int32())

    ranged = F.arrow_udf(number, "int", F.ArrowUDFType.SCALAR)("doc_id").alias("range")
    ids = docs.select(ranged, "doc_id").groupBy("range").agg(F.min("doc_id").alias("doc_id"))
    heads = sorted(ids.collect(), key=lambda r: r.range)
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select("doc_id", text)
    lent = [(h.doc_id, before.range) for before, h in zip([heads[-1], *heads], heads, strict=False)]
    lent = spark.createDataFrame(lent, "head long, range int")
    lent = rows.join(F.broadcast(lent), F.col("doc_id").eqNullSafe(F.col("head")))
    lent = lent.groupBy("range").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    whole = rows.select("doc_id", "text", ranged, F.lit(False).alias("borrowed"))
    whole = whole.unionByName(lent.withColumn("borrowed", F.lit(True)))
    order = ["range", "borrowed", F.col("doc_id").asc_nulls_first(), "text"]
    return whole.repartition(partitions, "range").sortWithinPartitions(*order)


EDITED = (
    "doc_id long, n_chars long, text string, edited string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, after: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    part = len(text) // 4
    return text[: len(text) - part] + after[:part]


def against_edits(docs: DataFrame, with_texts: bool = True) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    A table of one document has itself as the next one.
    """
    dealt = dealt_in_order(docs) if docs.head(1) else docs.selectExpr("doc_id", "text", "0 as range", "false as borrowed")

    def chains(texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        return filters(offsets, np.frombuffer(b"".join(raw), np.uint8))

    def finished(ids: list, texts: list[str], ends: list[bool]) -> pa.RecordBatch:
        """Rows of a stretch, the last of which is only a successor."""
        own = [i for i in range(len(texts) - 1) if not ends[i]]
        changed = [edited(texts[i], texts[i + 1]) for i in own]
        plain, other = chains(texts), chains(changed)
        columns = [
            pa.array([ids[i] for i in own], pa.int64()),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([texts[i] if with_texts else None for i in own], pa.string()),
            pa.array(changed if with_texts else [hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([to_text(plain[i]) for i in own], pa.string()),
            pa.array([to_text(c) for c in other], pa.string()),
            pa.array([likeness(plain[i], c) for i, c in zip(own, other, strict=True)], pa.float64()),
            pa.array([likeness(plain[i], plain[i + 1]) for i in own], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in EDITED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, ends, size = [], [], [], 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "borrowed")), strict=True)
            for doc_id, text, borrowed in rows:
                ids.append(doc_id)
                texts.append(text)
                ends.append(borrowed)
                size += len(text)
                if size >= SLICE and len(texts) > 1:
                    yield finished(ids, texts, ends)
                    ids, texts, ends, size = ids[-1:], texts[-1:], ends[-1:], len(text)
        if len(texts) > 1:
            yield finished(ids, texts, ends)

    return dealt.select("doc_id", "text", "borrowed").mapInArrow(run, EDITED)
