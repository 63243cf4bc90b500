"""Byte-level BPE encoding and decoding with a two-tier lookup.

Texts are cut into pre-tokens; a minimal perfect hash over the vocabulary
resolves those that are tokens themselves, for a whole slice of texts at once.
Each distinct other one is merged once per slice: a heap of candidate merges
over a linked list of its bytes, smallest rank first, leftmost first.

The split follows the pattern of the public rank files

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

by classes of characters rather than by a match per token.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from cargolens.llm.textbytes import mix, rolling, slices, utf8

OTHER, LETTER, NUMBER, SPACE = range(4)

#: Letters that a leading apostrophe takes with it; fixed by the pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

#: Bytes of merged pre-tokens, and of a single one, that a Python worker remembers between slices;
#: EACH is what an entry takes besides its bytes.
REMEMBERED, REMEMBERED_PIECE, EACH = 96 << 20, 1 << 10, 200


def character_classes() -> np.ndarray:
    """Class of every code point."""
    codes = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4")
    text = codes.tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            out[codes[m.start() : m.end()]] = kind
    return out


def pre_tokens(offsets: np.ndarray, data: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(edges, first)``: byte edges of all pre-tokens, text r having ``first[r]:first[r + 1]``."""
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    n = len(code)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    byte_at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(byte_at, offsets)] = True
    kind = classes[code]
    run = edge[:-1].copy()
    run[1:] |= kind[1:] != kind[:-1]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = code[:-1] == 32
    blank_before &= ~edge[:-1]
    space = kind == SPACE
    begins = run & (space | ~blank_before)
    # the last white space before a visible character goes with it or stands alone
    begins[:-1] |= space[:-1] & ~space[1:] & ~edge[1:-1]
    quote = np.flatnonzero((code == 39) & run & ~blank_before)
    padded = np.append(code, [0, 0])
    edges2 = np.append(edge, [True, True])
    for letters in CONTRACTIONS:
        k = len(letters)
        hit = quote
        for j, c in enumerate(letters, 1):
            hit = hit[(padded[hit + j] == ord(c)) & ~edges2[hit + j]]
        begins[hit + 1] = False
        after = hit + 1 + k
        begins[after[after < n]] = True
    starts = np.flatnonzero(begins)
    edges = np.append(byte_at[starts], len(data))
    return edges, np.searchsorted(edges[:-1], offsets)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of collision-free bits, numbered by rank."""

    def __init__(self, keys: np.ndarray):
        self.levels = []
        left, numbered = np.asarray(keys, np.uint64), 0
        while len(left):
            size = max(64, 2 * len(left))
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            number = np.where(alone, np.cumsum(alone) - 1 + numbered, -1).astype(np.int32)
            numbered += int(alone.sum())
            self.levels.append(number)
            left = left[~alone[at]]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; of a key that was not given, any number or -1."""
        out = np.full(len(keys), -1, np.int32)
        todo = np.arange(len(keys))
        for level, number in enumerate(self.levels):
            out[todo] = number[self._place(keys[todo], level, len(number))]
            todo = todo[out[todo] < 0]
        return out


def joined(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([[0], np.cumsum([len(t) for t in tokens])]), np.frombuffer(b"".join(tokens), np.uint8)


def gather(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the ranges that begin at ``first``, one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - ends + lengths, lengths)


class Vocabulary:
    """Ranks of byte strings, as read from a ``.tiktoken`` file."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        self.ranks = ranks
        tokens = list(ranks)
        offsets, data = joined(tokens)
        keys = rolling(data, offsets[:-1], offsets[1:])
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two tokens have one hash")
        self.hash = PerfectHash(keys)
        order = np.argsort(self.hash(keys))
        self.slot_key = keys[order]
        self.slot_id = np.array([ranks[t] for t in tokens], np.uint32)[order]
        by_id = sorted(ranks.items(), key=lambda x: x[1])
        self.ids = np.array([i for _, i in by_id], np.int64)
        self.token_offsets, self.token_data = joined([t for t, _ in by_id])
        self.classes = character_classes()
        self.no_rank = max(ranks.values()) + 1
        self.byte_pairs = [ranks.get(bytes([a, b]), self.no_rank) for a in range(256) for b in range(256)]
        #: pre-tokens merged before, with their ids
        self.merged: dict[bytes, bytes] = {}
        self.remembered = 0

    def remember(self, piece: bytes, ids: bytes) -> None:
        """Keep what was merged; all is dropped when it takes REMEMBERED bytes, and long ones are not kept."""
        if len(piece) > REMEMBERED_PIECE:
            return
        taken = len(piece) + len(ids) + EACH
        if self.remembered + taken > REMEMBERED:
            self.merged.clear()
            self.remembered = 0
        self.merged[piece] = ids
        self.remembered += taken

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            pairs = (line.split() for line in f)
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def whole(self, keys: np.ndarray) -> np.ndarray:
        """Id of each pre-token that is a token, else -1, by the hash of its bytes."""
        slot = self.hash(keys)
        known = (slot >= 0) & (self.slot_key[slot] == keys)
        return np.where(known, self.slot_id[slot].astype(np.int64), -1)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(length of each token, all bytes)``."""
        place = np.searchsorted(self.ids, ids)
        if len(ids) and (place.max() >= len(self.ids) or (self.ids[place] != ids).any()):
            raise ValueError("an id is not in the vocabulary")
        lengths = np.diff(self.token_offsets)[place]
        return lengths, self.token_data[gather(self.token_offsets[place], lengths)]


def merge(piece: bytes, vocabulary: Vocabulary) -> bytes:
    """Ids of one pre-token as little-endian 32-bit values: a heap of merges over linked bytes.

    ``pair[i]`` is the rank of the part at i with the one after it; a heap entry
    whose rank is no longer that has been overtaken by another merge.
    """
    n = len(piece)
    ranks, no_rank = vocabulary.ranks, vocabulary.no_rank
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair = [vocabulary.byte_pairs[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
    pair.append(no_rank)
    shift = n.bit_length()
    low = (1 << shift) - 1
    heap = [r << shift | i for i, r in enumerate(pair) if r != no_rank]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & low
        if pair[i] != entry >> shift:
            continue
        mid = after[i]
        end = after[i] = after[mid]
        pair[mid] = no_rank
        if end < n:
            before[end] = i
            r = pair[i] = ranks.get(piece[i : after[end]], no_rank)
            if r != no_rank:
                heappush(heap, r << shift | i)
        else:
            pair[i] = no_rank
        j = before[i]
        if j >= 0:
            r = pair[j] = ranks.get(piece[j:end], no_rank)
            if r != no_rank:
                heappush(heap, r << shift | j)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return array("I", out).tobytes()


def encode_texts(
    offsets: np.ndarray, data: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """``(first, ids)`` of texts that lie one behind the other; text r has ``ids[first[r]:first[r + 1]]``."""
    cache = vocabulary.merged
    edges, first = pre_tokens(offsets, data, vocabulary.classes)
    starts, ends = edges[:-1], edges[1:]
    keys = rolling(data, starts, ends)
    for distinct in (True, False):
        ids = vocabulary.whole(keys)
        missed = np.flatnonzero(ids < 0)
        if distinct:
            _, example, which = np.unique(keys[missed], return_index=True, return_inverse=True)
            example = missed[example]
        else:  # two byte strings had one hash: look at each pre-token itself
            missed = example = np.arange(len(starts))
            which = missed
        raw, merged = data.tobytes(), []
        for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True):
            piece = raw[a:b]
            got = cache.get(piece)
            if got is None:
                whole = vocabulary.ranks.get(piece)
                got = merge(piece, vocabulary) if whole is None else whole.to_bytes(4, "little")
                vocabulary.remember(piece, got)
            merged.append(got)
        sizes = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
        pool = np.frombuffer(b"".join(merged), "<u4").astype(np.int64)
        # every pre-token takes a range of the pool; the whole tokens lie behind the merged ones
        hits = np.flatnonzero(ids >= 0) if distinct else np.zeros(0, np.int64)
        lengths = np.ones(len(ids), np.int64)
        begin = np.zeros(len(ids), np.int64)
        lengths[missed] = sizes[which]
        begin[missed] = (np.cumsum(sizes) - sizes)[which]
        begin[hits] = len(pool) + np.arange(len(hits))
        out = np.concatenate([pool, ids[hits]])[gather(begin, lengths)]
        if not distinct or np.array_equal(vocabulary.decode(out)[1], data):
            break
    return np.concatenate([[0], np.cumsum(lengths)])[first], out.astype(np.uint32)


def encode(docs: DataFrame, vocabulary: Vocabulary, packed: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row of ``docs`` (``doc_id, text``).

    ``ids`` is an array of ints, or with ``packed`` its little-endian unsigned
    32-bit form. No special tokens are used: their strings are ordinary text.
    A null text is empty and has no ids; ids of rows (null, repeated) are kept
    as they are; other columns are not read. The vocabulary goes to the
    executors as one broadcast value; its size does not depend on the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column("text"))
            for lo, hi in slices(offsets):
                part = offsets[lo : hi + 1] - offsets[lo]
                first, ids = encode_texts(part, data[offsets[lo] : offsets[hi]], shared.value)
                if packed:
                    ends = pa.py_buffer((first * 4).astype(np.int32))
                    column = pa.Array.from_buffers(pa.binary(), hi - lo, [None, ends, pa.py_buffer(ids.astype("<u4"))])
                else:
                    column = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(first)), column],
                    ["doc_id", "n_tokens", "ids"],
                )

    kind = "binary" if packed else "array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type(docs)}, n_tokens long, ids {kind}")


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def decode(encoded: DataFrame, vocabulary: Vocabulary, column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (bytes) added, from ids of either form; null ids give null."""
    if "decoded" in encoded.columns:
        raise ValueError("there is a column decoded already")
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    names, at = encoded.columns, encoded.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(at)
            if pa.types.is_list(ids.type):
                edges, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
            else:
                _, ends, raw = ids.buffers()
                edges = np.frombuffer(ends, np.int32)[ids.offset : ids.offset + len(ids) + 1] // 4
                flat = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
                flat = flat[: int(edges[-1]) * 4].view("<u4")
            for lo, hi in slices(edges.astype(np.int64), 1 << 18):
                lengths, data = shared.value.decode(flat[edges[lo] : edges[hi]].astype(np.int64))
                sums = np.concatenate([[0], np.cumsum(lengths)])
                ends = pa.py_buffer(sums[edges[lo : hi + 1] - edges[lo]].astype(np.int32))
                whole = pa.Array.from_buffers(pa.binary(), hi - lo, [None, ends, pa.py_buffer(data)])
                empty = ids.slice(lo, hi - lo).is_null()
                whole = pc.if_else(empty, pa.scalar(None, pa.binary()), whole)
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, whole], [*names, "decoded"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{kept}, decoded binary")
