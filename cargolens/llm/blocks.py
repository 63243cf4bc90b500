"""Vectors as packed blocks that meet by key, and the best matches kept while they do.

A block is a row ``key, ids, more, body``: up to MOST_ROWS vectors of one key,
their ids, and a matrix of further whole numbers. Blocks are packed where the
rows are read, brought to an even size per key, and a key with many rows is many
blocks, so neither a task nor a group grows with one key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.substring_dedup import NO_ID

#: Vectors of a block, and bytes of vectors gathered before they are packed.
MOST_ROWS, PACK_BYTES = 4096, 16 << 20

#: Matches that a task keeps before it weeds them out.
KEPT_MATCHES = 1 << 18

BLOCK = "key int, n int, ids binary, more binary, body binary"


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Vectors as rows; components that a shorter one lacks are zero."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    edges = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[edges[0] : edges[-1]]
    out = np.zeros((len(column), width), kind)
    out[np.arange(width) < np.diff(edges)[:, None]] = values
    return out


def gathered(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Batches put together to about PACK_BYTES of vectors."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows * width * 8 >= PACK_BYTES:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def block_rows(key: np.ndarray, ids: np.ndarray, more: np.ndarray, body: np.ndarray, most: int) -> pa.RecordBatch:
    """Blocks of the given rows."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.flatnonzero(np.diff(key, prepend=-1))
    ends = np.append(cuts[1:], len(key))
    spans = [(at, min(at + most, b)) for a, b in zip(cuts, ends, strict=True) for at in range(a, b, most)]
    parts = [order[a:b] for a, b in spans]
    columns = [
        pa.array([int(key[a]) for a, _ in spans], pa.int32()),
        pa.array([len(p) for p in parts], pa.int32()),
        *[pa.array([np.ascontiguousarray(x[p]).tobytes() for p in parts], pa.binary()) for x in (ids, more, body)],
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "n", "ids", "more", "body"])


def packed(rows: DataFrame, more: list[str], width: int, kind, keys_of: Callable, most: int = MOST_ROWS) -> DataFrame:
    """Blocks of ``rows`` (``id, vec`` and the longs ``more``) of at most ``most`` rows.

    ``keys_of(body, more)`` gives ``(row, key)``: which rows go to which keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, width):
            body = matrix(table.column("vec"), width, kind)
            ids = table.column("id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            extra = np.stack([table.column(c).to_numpy() for c in more], 1).astype(np.int64)
            row, key = keys_of(body, extra)
            # the copies of a slice at a time, as one row may go to many keys
            step = max(1, PACK_BYTES // (8 * width))
            order = np.argsort(key, kind="stable")
            for lo in range(0, len(order), step):
                part = order[lo : lo + step]
                r = row[part]
                yield block_rows(key[part], ids[r], extra[r], body[r], most)

    return rows.select("id", "vec", *more).mapInArrow(run, BLOCK)


def evened(blocks: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``key, salt`` and about ``most`` rows per block; ``blocks`` is staged, so that its rows can be numbered."""
    sizes = blocks.groupBy("key").agg(F.sum("n").alias("rows"))
    salts = F.ceil(F.col("rows") / most)
    dealt = blocks.join(sizes, "key").withColumn("salt", F.pmod(F.xxhash64("ids", "more"), salts).cast("int"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        joined = [b"".join(table.column(c).to_pylist()) for c in ("ids", "more", "body")]
        values = [key[0].as_py(), key[1].as_py(), sum(table.column("n").to_pylist()), *joined]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = ["key", "salt", "n", "ids", "more", "body"]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    shape = BLOCK.replace("key int", "key int, salt int")
    return dealt.select("key", "salt", "n", "ids", "more", "body").groupBy("key", "salt").applyInArrow(run, shape)


def met(queries: DataFrame, data: DataFrame) -> DataFrame:
    """Each block of queries beside each block of data of its key."""
    asked = queries.select("key", *[F.col(c).alias(f"q_{c}") for c in ("ids", "more", "body")])
    # neither side is broadcast: repeated vectors are small on disk but not in memory
    where = data.select("key", "salt")
    return asked.hint("merge").join(where, "key").join(data.hint("merge"), ["key", "salt"])


def arrays(batch: pa.RecordBatch, row: int, width: int, kind, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, more, body)`` of a block."""
    ids, more, body = (batch.column(f"{prefix}{c}")[row].as_py() for c in ("ids", "more", "body"))
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(more, np.int64).reshape(len(ids), -1), np.frombuffer(body, kind).reshape(len(ids), width)


class Best:
    """The ``k`` best matches of each group among those added: highest score, then smallest id."""

    def __init__(self, k: int, score_type: pa.DataType):
        self.k, self.kind, self.held, self.count = k, score_type, [], 0

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, rid: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Passes on what is held when even the weeded matches are too many to keep."""
        self.held.append((group, score, ids, rid))
        self.count += len(group)
        if self.count > KEPT_MATCHES:
            self._weed()
            if self.count > KEPT_MATCHES // 2:
                yield from self.rest()

    def _weed(self) -> None:
        group, score, ids, rid = (np.concatenate(x) for x in zip(*self.held, strict=True))
        down = ~score if score.dtype == np.int64 else -score
        order = np.lexsort((rid, ids, down, group))
        g, r = group[order], rid[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])  # one row found through two keys
        order, g = order[new], g[new]
        first = np.searchsorted(g, g)
        order = order[np.arange(len(g)) - first < self.k]
        self.held = [(group[order], score[order], ids[order], rid[order])]
        self.count = len(order)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            self._weed()
            group, score, ids, rid = self.held[0]
            columns = [pa.array(group), pa.array(score, self.kind), pa.array(ids, mask=ids == NO_ID), pa.array(rid)]
            yield pa.RecordBatch.from_arrays(columns, ["grp", "score", "id", "rid"])
        self.held, self.count = [], 0
