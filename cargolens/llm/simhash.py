"""SimHash near-dedup: fingerprints linked through pigeonhole blocks.

Fingerprints are cut into blocks; two that differ in at most ``max_bits`` bits
agree in all but ``max_bits`` of them, so they share one of the keys made of
the remaining blocks. Documents join on these keys and Hamming distance is
verified. Equal fingerprints are one node from the start, so copies never pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.textbytes import Words, slices, utf8
from cargolens.session import drop_staged, staged

SEED = 42

#: Members of a block key that are paired directly; larger ones link through neighbours.
PAIRED_MEMBERS = 64

#: Shingle hashes turned into bits at a time.
HASHES_AT_ONCE = 1 << 16


def shingle_hashes(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: XXH64 of all shingles, text r having ``first[r]:first[r + 1]``."""
    offsets, data = words.joined()
    line = Words(offsets, data)
    n = line.counts
    per_text = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(per_text)])
    row = np.repeat(np.arange(len(n)), per_text)
    at = line.first[row] + np.arange(first[-1]) - first[row]
    last = np.minimum(at + shingle, line.first[row + 1]) - 1
    raw, digest = data.tobytes(), xxhash.xxh64_intdigest
    spans = zip(line.starts[at].tolist(), line.ends[last].tolist(), strict=True)
    return np.fromiter((digest(raw[a:b], SEED) for a, b in spans), np.uint64, first[-1]), first


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text the bits set in over half of its hashes; zero for a text without any."""
    n_rows = len(first) - 1
    counts = np.zeros((n_rows, 64), np.int64)
    for lo in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[lo : lo + HASHES_AT_ONCE]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        a = int(np.searchsorted(first, lo, "right")) - 1
        b = int(np.searchsorted(first, lo + len(part), "left"))
        starts = np.maximum(first[a:b], lo) - lo
        have = np.flatnonzero(np.diff(np.append(starts, len(part))) > 0)
        # rows that have hashes here are contiguous runs of bits
        sums = np.add.reduceat(bits, starts[have], axis=0, dtype=np.int64)
        counts[a + have] += sums
    over = counts * 2 > np.diff(first)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(n_rows).astype(np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, simhash`` (the 64 bits as a long) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            for lo, hi in slices(offsets):
                part = offsets[lo : hi + 1] - offsets[lo]
                raw = np.frombuffer(data[offsets[lo] : offsets[hi]].tobytes().lower(), np.uint8)
                prints = majority_bits(*shingle_hashes(Words(part, raw), shingle))
                own = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(prints.view(np.int64))], ["doc_id", "text_hash", "simhash"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, simhash long")


def block_keys(simhash: Column, max_bits: int, blocks: int) -> Column:
    """All keys of one fingerprint: the bits outside ``max_bits`` of the blocks, tagged by which."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for no, left_out in enumerate(combinations(range(blocks), max_bits)):
        mask = 0
        for b in set(range(blocks)) - set(left_out):
            mask |= ((1 << (edges[b + 1] - edges[b])) - 1) << edges[b]
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(no).alias("no"), simhash.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.explode(F.array(*keys))


def links(nodes: DataFrame, max_bits: int = 2, blocks: int = 4) -> DataFrame:
    """``(a, b)`` edges whose components are those of all pairs within ``max_bits``.

    ``nodes`` has distinct fingerprints in ``node``. Keys with few members are
    paired and verified. Members of a larger one meet at the values up to one
    bit away from them instead: whoever is close shares such a value and is
    linked to the smallest fingerprint there, so no pairs arise.
    """
    keyed = nodes.select("node", block_keys(F.col("node"), max_bits, blocks).alias("key"))
    sizes = staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "keys")
    few = keyed.join(sizes.filter(F.col("members") <= PAIRED_MEMBERS), "key").select("key", F.col("node").alias("a"))
    paired = (
        few.join(few.withColumnRenamed("a", "b"), "key")
        .filter("a < b")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )
    crowd = keyed.join(sizes.filter(F.col("members") > PAIRED_MEMBERS), "key").select("node").distinct()
    return paired.unionByName(star_links(crowd, max_bits)).distinct()


def star_links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Links through shared neighbours, exact for a distance of 0 to 2.

    Two values at most 2 bits apart have a common neighbour at most one bit
    from both, and all that share such a neighbour are at most 2 bits apart.
    For a distance of 1, two values meet where the bit they differ in is cleared.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("crowded keys are linked for a distance of 0 to 2 bits")
    bits = F.sequence(F.lit(0), F.lit(63))
    if max_bits == 1:
        near = F.transform(bits, lambda i: F.struct(i, F.col("node").bitwiseAND(F.bitwise_not(one_bit(i)))))
    else:
        near = F.concat(F.array("node"), F.transform(bits, lambda i: F.col("node").bitwiseXOR(one_bit(i))))
    at = nodes.select("node", F.explode(near).alias("near"))
    centre = at.groupBy("near").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return at.join(centre, "near").filter("node > a").select("a", F.col("node").alias("b"))


def one_bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for nodes that have an edge.

    Each round hooks a node, and the node its label names, to the smallest
    label among its neighbours, and then follows labels one step, so a chain
    shortens by half or more per round. Every round is written to the shared
    folder: plans stay short, a lost executor's part is read again, and joins
    read both sides through an exchange, where Spark splits a crowded node.
    """
    spark = edges.sparkSession
    edges = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = staged(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).select("a", F.col("label").alias("other"))
        near = near.groupBy("a").agg(F.min("other").alias("other")).join(labels, F.col("a") == F.col("node"))
        hooked = near.select("node", F.least("label", "other").alias("label")).unionByName(
            near.select(F.col("label").alias("node"), F.least("label", "other").alias("label"))
        )
        hooked = staged(hooked.groupBy("node").agg(F.min("label").alias("label")), "labels")
        step = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = staged(hooked.join(step, "label").select("node", F.col("further").alias("label")), "labels")
        old = labels.withColumnRenamed("label", "old")
        changed = after.join(old, "node").filter("label <> old").limit(1).count()
        drop_staged(spark, labels, hooked)
        labels = after
        if not changed:
            drop_staged(spark, edges)
            return labels.withColumnRenamed("label", "component")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, blocks: int = 4
) -> DataFrame:
    """``doc_id, fingerprint, component_id, component, text_hash`` for every row of ``docs``.

    Texts are lower-cased (A-Z only) and cut into words; a text with fewer
    words than ``shingle`` is one shingle, one without words (null included)
    has fingerprint zero and is linked like any other. ``component_id`` is the
    smallest ``doc_id`` reachable over links of at most ``max_bits`` differing
    bits; ``component`` is its smallest fingerprint, as a long. Rows without a
    ``doc_id`` take part with their text; a component in which no row has an id
    has a null ``component_id``. Rows of one id each keep a row with its own
    component; ``text_hash`` tells them apart. Only ``doc_id`` and ``text`` are read.
    """
    if not 0 <= max_bits < blocks:
        raise ValueError("max_bits must be below the number of blocks")
    prints = staged(fingerprints(docs, shingle), "simhash")
    nodes = prints.groupBy("simhash").agg(F.min("doc_id").alias("doc_id"))
    nodes = staged(nodes.withColumnRenamed("simhash", "node"), "nodes")
    found = components(links(nodes, max_bits, blocks))
    classes = staged(nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "classes")
    smallest = staged(classes.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    named = classes.join(smallest, "component").select(F.col("node").alias("simhash"), "component_id", "component")
    return prints.join(staged(named, "named"), "simhash").select(
        "doc_id",
        F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"),
        "component_id",
        "component",
        "text_hash",
    )


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of ``docs`` per component of ``near_duplicates(docs)``: that of the smallest id, or without id if none has one.

    Of rows that share the smallest id, the one with the smallest text hash
    stays; of wholly repeated rows, one.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("x")
    kept = classes.groupBy("component").agg(first).select(F.col("x.doc_id").alias("_id"), F.col("x.text_hash").alias("_hash"))
    met = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    hashed = docs.join(kept, met, "left_semi").withColumn("_hash", F.xxhash64("text"))
    return hashed.dropDuplicates(["doc_id", "_hash"]).drop("_hash")
