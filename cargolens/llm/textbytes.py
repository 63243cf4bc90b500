"""Texts as numpy arrays: UTF-8 views of Arrow columns, words and rolling hashes.

Words are maximal runs of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that separate words.
SEPARATORS = b" \t\n\x0b\x0c\r"
IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True

#: Bytes of text worked on at a time; one longer text is a slice of its own.
SLICE_BYTES = (2 << 20) - (1 << 16)

#: Odd multiplier of the rolling hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C55
BASE_INVERSE = pow(BASE, -1, 1 << 64)

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, modulo 2**64; grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        size = max(1 << 16, 1 << n.bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 1 << 23:  # tables for a text beyond the slice size are not kept
            _POWERS[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result; one to one."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for each pair, from prefix sums; equal runs have equal hashes."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n)[:n], out=sums[1:])
    h = sums[ends] - sums[starts]
    h *= _powers(BASE_INVERSE, n)[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h)


#: Bytes up to which words are hashed eight bytes after eight bytes, all words at a time.
LANE_BYTES = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each word; every step depends on all bytes before it, so no pattern of letters cancels out."""
    lengths = ends - starts
    loads = lanes_of(data)
    h = mix(lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(BASE))
    todo, k = np.flatnonzero(lengths <= LANE_BYTES), 0
    while len(todo):
        left = lengths[todo] - k
        h[todo] = mix(h[todo] * np.uint64(BASE) + masked(loads[starts[todo] + k], left))
        todo, k = todo[left > 8], k + 8
    for i in np.flatnonzero(lengths > LANE_BYTES):
        at = np.arange(0, lengths[i], 8)
        lanes = masked(loads[starts[i] + at], lengths[i] - at)
        h[i] += mix(mix(lanes) + at.astype(np.uint64) * np.uint64(BASE)).sum(dtype=np.uint64)
    return mix(h)


def lanes_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on; zeros stand behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def masked(lanes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Lanes of which only the first ``left`` bytes count."""
    return lanes & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - np.clip(left, 1, 8)).astype(np.uint64)))


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> bool:
    """Whether the bytes from ``a`` on equal those from ``b`` on, all of them."""
    loads = lanes_of(data)
    todo, k = np.flatnonzero((a != b) & (lengths <= LANE_BYTES)), 0
    while len(todo):
        left = lengths[todo] - k
        if (masked(loads[a[todo] + k], left) != masked(loads[b[todo] + k], left)).any():
            return False
        todo, k = todo[left > 8], k + 8
    long = np.flatnonzero((a != b) & (lengths > LANE_BYTES))
    return all(np.array_equal(data[a[i] : a[i] + lengths[i]], data[b[i] : b[i] + lengths[i]]) for i in long)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string column without making Python strings; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """The words of some texts that lie one behind the other in ``data``.

    ``starts`` and ``ends`` are byte positions, ``first[r]:first[r + 1]`` are
    the words of text r.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        self.offsets, self.data = offsets, data
        inside = ~IS_SEPARATOR[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | edge[1:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(offsets, bytes)`` of each text's kept words joined by one blank."""
        rows = self.rows()
        starts, ends = self.starts, self.ends
        if keep is not None:
            starts, ends, rows = starts[keep], ends[keep], rows[keep]
        followed = np.zeros(len(starts), bool)
        followed[:-1] = rows[1:] == rows[:-1]
        # a word that another one of its text follows has a separator behind it
        steps = np.zeros(len(self.data) + 1, np.int32)
        steps[starts] += 1
        steps[ends + followed] -= 1
        mask = np.cumsum(steps[:-1]) > 0
        out = self.data[mask]
        out[IS_SEPARATOR[out]] = 32
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[self.offsets], out
