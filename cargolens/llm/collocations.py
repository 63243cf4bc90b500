"""Phrase collocations by Toivonen's sampling.

A sample of the documents proposes phrases: those that are frequent in it, by a
lowered threshold, and whose parts one word shorter are proposed too. One pass
over all documents counts the proposed phrases and their negative border, which
are the phrases that are not proposed but all of whose parts are. It counts
under 64-bit hashes, without texts: a clash makes a count too high, never too
low, and next to all border phrases are seldom. The next pass counts what was
frequent by its text. If there was some of the border among it, the sample has
missed it; that pass then also counts the phrases that it admits, and further
passes follow until one finds nothing new. So every frequent phrase has been
counted exactly, and the result does not depend on the sample.

The proposals travel as bitmaps of a fixed size, one per length. Two phrases
of one bit only mean that one is counted in vain. Counts are made per slice of
text and put together per task before they are packed and dealt by ranges of
the hash, so a word that all texts repeat is one entry per task and slice. The
ranges grow in number with the text, not in size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.substring_dedup import deltas, pack, unpack
from cargolens.llm.textbytes import mix, same_bytes, slices, utf8, word_hashes
from cargolens.session import drop_staged, staged

#: Bits of a bitmap: 8 MB whatever the number of phrases.
BITMAP_BITS = 1 << 26

#: One of so many documents is in the sample, and the share of the expected count that proposes a phrase.
SAMPLE_OF, LOWERED = 4, 0.6

#: Bytes of text counted at a time; one longer text is a slice of its own.
COUNT_BYTES = 1 << 20

#: Counts that a task puts together before it passes them on, and bytes of text for each range of hashes.
GATHERED, RANGE_BYTES = 1 << 20, 32 << 20

#: Rows of a batch that are looked at together.
ROWS_AT_ONCE = 512

#: Groups that a language's best phrases are sought in before they meet.
SHARES = 32

#: Characters that separate words, and those that no phrase reaches across.
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
IS_BREAK = np.zeros(256, bool)
IS_BREAK[list(BREAKS)] = True
IS_OUTSIDE = IS_BREAK.copy()
IS_OUTSIDE[list(BLANKS)] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

LONGER = np.uint64(0xD6E8FEB86659FD93)


class Phrases:
    """The words of a slice of texts and its phrases; equal words of two languages are different.

    ``langs`` are numbers per text and ``lang_hashes`` their hashes. ``hashes(n)``
    is the hash of the ``n`` words from each word on, its two lowest bits being
    ``n``, where ``inside(n)`` says that these lie in one piece of text.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, langs: np.ndarray, lang_hashes: np.ndarray):
        self.data = data = LOWER[data]
        letter = ~IS_OUTSIDE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        opens, closes = letter.copy(), letter
        opens[1:] &= ~letter[:-1] | edge[1:-1]
        closes[:-1] &= ~letter[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        n = len(self.starts)
        text = np.searchsorted(offsets, self.starts, "right") - 1
        self.lang = langs[text] if n else np.zeros(0, np.int64)
        breaks = np.zeros(len(data) + 1, np.int32)
        np.cumsum(IS_BREAK[data], out=breaks[1:])
        followed = np.zeros(n, bool)
        if n > 1:
            followed[:-1] = (text[1:] == text[:-1]) & (breaks[self.starts[1:]] == breaks[self.ends[:-1]])
        own = word_hashes(data, self.starts, self.ends)
        if n:
            own = mix(own * LONGER + lang_hashes[self.lang])
        self._inside, self._hashes = [np.ones(n, bool), followed], [tagged(own, 1)]
        self._numbers = np.full(n, -1, np.int64)

    def inside(self, size: int) -> np.ndarray:
        while len(self._inside) < size:
            self._inside.append(self._inside[-1] & shifted(self._inside[1], len(self._inside) - 1))
        return self._inside[size - 1]

    def hashes(self, size: int) -> np.ndarray:
        while len(self._hashes) < size:
            n = len(self._hashes)
            last = np.zeros_like(self._hashes[0])
            last[: max(0, len(last) - n)] = self._hashes[0][n:]
            self._hashes.append(tagged(mix(self._hashes[-1] * LONGER + last), n + 1))
        return self._hashes[size - 1]

    def numbers(self, where: np.ndarray) -> np.ndarray:
        """Numbers of the words flagged by ``where``, one for each different word; kept for the next call.

        What has one hash is compared byte by byte.
        """
        if (self._numbers[where] < 0).any():
            at = np.flatnonzero(where | (self._numbers >= 0))
            first, _, number = counted(self._hashes[0][at])
            like = at[first][number]
            lengths = self.ends[at] - self.starts[at]
            same = (lengths == self.ends[like] - self.starts[like]) & (self.lang[at] == self.lang[like])
            if not (same.all() and same_bytes(self.data, self.starts[at], self.starts[like], lengths)):
                seen: dict = {}
                raw = self.data.tobytes()
                words = zip(self.lang[at].tolist(), self.starts[at].tolist(), self.ends[at].tolist(), strict=True)
                number = np.array([seen.setdefault((g, raw[a:b]), len(seen)) for g, a, b in words], np.int64)
            self._numbers[at] = number
        return self._numbers

    def texts(self, first: np.ndarray, size: int) -> pa.Array:
        """The ``size`` words from the given words on, joined by a blank; as bytes."""
        word = (first[:, None] + np.arange(size)).ravel()
        lengths = self.ends[word] - self.starts[word] + 1
        edges = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(edges[-1]) + np.repeat(self.starts[word] - edges[:-1], lengths)
        out = self.data[np.minimum(at, max(0, len(self.data) - 1))]
        out[edges[1:] - 1] = 32
        ends = edges[::size]
        # the blank behind the last word of each phrase goes
        keep = np.ones(len(out), bool)
        keep[ends[1:] - 1] = False
        offsets = ends - np.arange(len(ends))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out[keep])])


def tagged(hashes: np.ndarray, size: int) -> np.ndarray:
    return hashes & ~np.uint64(3) | np.uint64(size)


def firsts(sorted_values: np.ndarray) -> np.ndarray:
    out = np.ones(len(sorted_values), bool)
    out[1:] = sorted_values[1:] != sorted_values[:-1]
    return out


def shifted(flags: np.ndarray, by: int) -> np.ndarray:
    """What stands ``by`` places further on."""
    out = np.zeros(len(flags), bool)
    out[: max(0, len(flags) - by)] = flags[by:]
    return out


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first, count, number)``: place and count of each different key, and the number of each key among them."""
    order = np.argsort(keys, kind="stable")
    new = firsts(keys[order])
    cuts = np.flatnonzero(new)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[cuts], np.diff(np.append(cuts, len(keys))), number


def lang_hash(lang: str) -> int:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return int(word_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0])


def read_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Phrases]]:
    """``(languages, phrases)`` of slices of the columns ``lang, text``."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(at, ROWS_AT_ONCE)
            offsets, data = utf8(batch.column("text"))
            coded = batch.column("lang").dictionary_encode()
            hashes = np.array([lang_hash(x) for x in coded.dictionary.to_pylist()], np.uint64)
            langs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in slices(offsets, COUNT_BYTES):
                edges = offsets[lo : hi + 1]
                yield coded.dictionary, Phrases(edges - edges[0], data[edges[0] : edges[-1]], langs[lo:hi], hashes)


#: Bytes of a row of Spark's bitmap aggregate.
PART_BYTES = 4096


class Bitmaps:
    """Sets of phrase hashes by phrase length, BITMAP_BITS bits each."""

    def __init__(self, lengths: int):
        self.sets = np.zeros((lengths, BITMAP_BITS // 8), np.uint8)

    @staticmethod
    def of(counts: DataFrame, lengths: int) -> Bitmaps:
        """Of the column ``key``; what comes to the driver is as large as the bitmaps, however many rows there are."""
        low = number(F.substring("key", 5, 4))
        at = F.pmod(low, F.lit(BITMAP_BITS))
        part, bit = F.floor(at / (8 * PART_BYTES)).cast("int"), F.pmod(at, F.lit(8 * PART_BYTES))
        places = counts.select(F.pmod(low, F.lit(4)).cast("int").alias("size"), part.alias("part"), bit.alias("bit")).filter("size > 0")
        out = Bitmaps(lengths)
        for r in places.groupBy("size", "part").agg(F.bitmap_construct_agg("bit").alias("body")).collect():
            body = np.frombuffer(r.body, np.uint8)
            out.sets[r["size"] - 1, r.part * PART_BYTES : r.part * PART_BYTES + len(body)] = body
        return out

    def has(self, size: int, hashes: np.ndarray) -> np.ndarray:
        at = (hashes % np.uint64(BITMAP_BITS)).astype(np.int64)
        return (self.sets[size - 1][at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

    def admitted(self, p: Phrases, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(size, admitted, member)`` by length: where a phrase starts all of whose parts are in the sets, and whether it is."""
        admitted = p.inside(1)
        for size in range(1, longest + 1):
            member = admitted.copy()
            member[admitted] = self.has(size, p.hashes(size)[admitted])
            yield size, admitted, member
            admitted = member & shifted(member, 1) & p.inside(size + 1)

    def joined(self, other: Bitmaps) -> Bitmaps:
        out = Bitmaps(0)
        out.sets = self.sets | other.sets
        return out


def number(column: Column) -> Column:
    """Of four bytes, highest first."""
    return F.conv(F.hex(column), 16, 10).cast("long")


class Gathered:
    """Counts of many slices, by hash and by text; packed by range of the hash in ``rows()``."""

    def __init__(self, ranges: int):
        self.ranges = ranges
        self.hashed, self.named, self.size = [], [], 0

    def add(self, counts: tuple | pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if isinstance(counts, tuple):
            self.hashed.append(counts)
            self.size += len(counts[0])
        else:
            self.named.append(counts)
            self.size += counts.num_rows
        if self.size >= GATHERED:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``place, named, body``, and nothing is held any more."""
        out = []
        if self.hashed:
            hashes, counts = sums(self.hashed)
            for place, lo, hi in self._spans(hashes):
                out.append((place, False, pack(deltas(hashes[lo:hi]), counts[lo:hi])))
        if self.named:
            table = named_sums(self.named).sort_by([("hash", "ascending")])
            for place, lo, hi in self._spans(table.column("hash").to_numpy()):
                # in order of the text, which packs well; the hash can be had from it again
                out.append((place, True, packed_table(table.slice(lo, hi - lo).select(["key", "n"]).sort_by("key"))))
        self.hashed, self.named, self.size = [], [], 0
        for lo in range(0, len(out), 256):
            columns = zip(*out[lo : lo + 256], strict=True)
            kinds = (pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["place", "named", "body"])

    def _spans(self, sorted_hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        if not len(sorted_hashes):
            return
        place = ((sorted_hashes >> np.uint64(32)) * np.uint64(self.ranges)) >> np.uint64(32)
        cuts = np.flatnonzero(firsts(place))
        yield from zip(place[cuts].astype(int).tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(place)], strict=True)


def sums(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order and their counts over all parts."""
    hashes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    cuts = np.flatnonzero(firsts(hashes))
    return hashes[cuts], np.add.reduceat(counts[order].astype(np.int64), cuts) if len(cuts) else np.zeros(0, np.int64)


def named_sums(parts: list) -> pa.Table:
    by = [c for c in parts[0].schema.names if c != "n"]
    return pa.Table.from_batches(parts).group_by(by, use_threads=False).aggregate([("n", "sum")]).rename_columns([*by, "n"])


def packed_table(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def hashes_of(langs: list[str], phrases: list[str]) -> np.ndarray:
    """Hash of each phrase, 0 of an empty one."""
    coded = pa.array(langs).dictionary_encode()
    offsets, data = utf8(pa.array(phrases, pa.string()))
    hashes = np.array([lang_hash(x) for x in coded.dictionary.to_pylist()], np.uint64)
    p = Phrases(offsets, data, coded.indices.to_numpy().astype(np.int64), hashes)
    first = np.searchsorted(p.starts, offsets)
    size = np.diff(first)
    out = np.zeros(len(phrases), np.uint64)
    for n in range(1, size.max(initial=0) + 1):
        out[size == n] = p.hashes(n)[first[:-1][size == n]]
    return out


def ranges_of(texts: DataFrame) -> int:
    """Ranges of hashes, by the bytes of all texts and not fewer than the session's shuffle partitions."""
    length = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-length // RANGE_BYTES))


def counts_by_key(docs: DataFrame, rows_of, least: int, ranges: int) -> DataFrame:
    """``key, n`` of what occurs ``least`` times in all slices of ``docs``; ``rows_of(langs, phrases)`` gives the counts of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered(ranges)
        for langs, p in read_slices(batches):
            for counts in rows_of(langs, p):
                yield from gathered.add(counts)
        yield from gathered.rows()

    def put_together(table: pa.Table) -> pa.Table:
        named = table.column("named").to_pylist()
        bodies = table.column("body").to_pylist()
        parts = [unpack(b, "uint64", "int64") for b, n in zip(bodies, named, strict=True) if not n]
        tables = [pa.ipc.open_stream(b).read_all() for b, n in zip(bodies, named, strict=True) if n]
        out = []
        if parts:
            hashes, counts = sums([(np.cumsum(h, dtype=np.uint64), n) for h, n in parts])
            often = counts >= least
            out.append(pa.table({"key": hash_keys(hashes[often]), "n": counts[often]}))
        if tables:
            found = named_sums([b for t in tables for b in t.to_batches()])
            lengths = [int.from_bytes(k[:4], "big") + 4 for k in found.column("key").to_pylist()]
            total = pc.equal(pc.binary_length(found.column("key")), pa.array(lengths, pa.int32()))
            found = found.filter(pc.or_(pc.greater_equal(found.column("n"), least), total))
            keys = found.column("key").to_pylist()
            cuts = [int.from_bytes(k[:4], "big") + 4 for k in keys]
            hashes = hashes_of([k[4:c].decode() for k, c in zip(keys, cuts, strict=True)], [k[c:].decode() for k, c in zip(keys, cuts, strict=True)])
            keys = [h + k for h, k in zip(hash_keys(hashes).to_pylist(), keys, strict=True)]
            out.append(pa.table({"key": pa.array(keys, pa.binary()), "n": found.column("n")}))
        return pa.concat_tables(out)

    sent = docs.mapInArrow(run, "place int, named boolean, body binary")
    return sent.groupBy("place").applyInArrow(put_together, "key binary, n long")


def hash_keys(hashes: np.ndarray) -> pa.Array:
    """Eight bytes each, highest first."""
    raw = np.ascontiguousarray(hashes.astype(">u8"))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())


def border_counts(p: Phrases, size: int, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the phrases that start at ``where``."""
    return np.unique(p.hashes(size)[where], return_counts=True)


def named_rows(hashes: np.ndarray, langs: pa.Array, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    """``key, hash, n``; a key is the length of the language's name in four bytes, the name and the phrase."""
    length = pc.binary_length(langs.cast(pa.binary())).to_numpy(zero_copy_only=False).astype(">u4")
    length = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4), len(length), [None, pa.py_buffer(length)])
    parts = [x.cast(pa.large_binary()) for x in (length, langs, phrases)]
    joined = pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary()))
    return pa.RecordBatch.from_arrays([joined.cast(pa.binary()), pa.array(hashes), pa.array(counts)], ["key", "hash", "n"])


def exact_rows(p: Phrases, size: int, where: np.ndarray, langs: pa.Array) -> pa.RecordBatch:
    """Counts of the phrases that start at ``where``, by their text."""
    at = np.flatnonzero(where)
    words = where.copy()
    for j in range(1, size):
        words[at + j] = True
    number = p.numbers(words)
    many = number.max(initial=0) + 1
    first, count, key = counted(number[at])
    for j in range(1, size):
        first, count, key = counted(key * many + number[at + j])
    start = at[first]
    return named_rows(p.hashes(size)[start], langs.take(pa.array(p.lang[start])), p.texts(start, size), count)


def sample_counts(docs: DataFrame, sizes: range, least: int, ranges: int, proposed=None) -> DataFrame:
    """``key, n`` by hash of the phrases of these lengths that are frequent; with ``proposed`` of those whose parts are proposed."""

    def rows(langs: pa.Array, p: Phrases) -> Iterator[tuple]:
        where = {s: a for s, a, _ in proposed.value.admitted(p, sizes[-1])} if proposed else {s: p.inside(s) for s in sizes}
        for size in sizes:
            yield border_counts(p, size, where[size])

    return counts_by_key(docs, rows, least, ranges)


def hash_counts(docs: DataFrame, longest: int, least: int, ranges: int, proposed) -> DataFrame:
    """``key, n`` by hash of the frequent ones among the proposed phrases and their negative border.

    ``proposed`` is a broadcast bitmap. A key of hash 0 with a language counts that language's words.
    """

    def rows(langs: pa.Array, p: Phrases) -> Iterator[tuple | pa.RecordBatch]:
        none = pa.array([b""] * len(langs), pa.binary())
        yield named_rows(np.zeros(len(langs), np.uint64), langs, none, np.bincount(p.lang, minlength=len(langs)))
        for size, admitted, _ in proposed.value.admitted(p, longest):
            yield border_counts(p, size, admitted)

    return counts_by_key(docs, rows, least, ranges)


def text_counts(docs: DataFrame, longest: int, least: int, ranges: int, often, before, hashed: bool) -> DataFrame:
    """``key, n`` by text of the frequent ones among the phrases that ``often`` admits and ``before`` did not.

    With ``hashed`` those that both admit and ``often`` holds are counted as well.
    """

    def rows(langs: pa.Array, p: Phrases) -> Iterator[pa.RecordBatch]:
        pairs = zip(often.value.admitted(p, longest), before.value.admitted(p, longest), strict=True)
        for (size, admitted, member), (_, earlier, _) in pairs:
            wanted = (admitted & ~earlier) | member if hashed else admitted & ~earlier
            if wanted.any():
                yield exact_rows(p, size, wanted, langs)

    return counts_by_key(docs, rows, least, ranges)


def by_text(counts: DataFrame) -> DataFrame:
    """``lang, size, phrase, n`` of the keys with a text."""
    length = number(F.substring("key", 9, 4)).cast("int")
    named = counts.filter(F.octet_length("key") > 8)
    return named.select(
        F.substring("key", F.lit(13), length).cast("string").alias("lang"),
        F.pmod(number(F.substring("key", 5, 4)), F.lit(4)).cast("int").alias("size"),
        F.substring("key", 13 + length, F.octet_length("key")).cast("string").alias("phrase"),
        "n",
    )


def frequent_phrases(docs: DataFrame, least: int, longest: int, sample_of: int = SAMPLE_OF) -> tuple[DataFrame, int]:
    """``lang, size, phrase, n`` of all phrases up to ``longest`` words that occur ``least`` times; and the passes it took.

    Rows of size 0 hold the number of words of each language. Staged.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text", "doc_id")
    sample = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample_of)) == 0).select("lang", "text")
    texts = texts.select("lang", "text")
    enough = max(1, int(np.ceil(LOWERED * least / sample_of)))
    # words and pairs at once, then length by length what shorter proposals admit
    ranges = ranges_of(texts)
    proposed = Bitmaps.of(sample_counts(sample, range(1, min(2, longest) + 1), enough, ranges), longest)
    for size in range(3, longest + 1):
        shorter = share(proposed)
        more = sample_counts(sample, range(size, size + 1), enough, ranges, shorter)
        proposed = proposed.joined(Bitmaps.of(more, longest))
        shorter.unpersist()
    before = share(proposed)
    hashed = staged(hash_counts(texts, longest, least, ranges, before), "hashed")
    often = Bitmaps.of(hashed, longest)
    passes = [hashed.filter(F.octet_length("key") > 8)]
    while True:
        now = share(often)
        passes.append(staged(text_counts(texts, longest, least, ranges, now, before, len(passes) == 1), "phrases"))
        before.unpersist()
        before, known = now, often
        often = known.joined(Bitmaps.of(passes[-1], longest))
        # phrases of the longest length admit no others
        if (often.sets[:-1] == known.sets[:-1]).all():
            break
    before.unpersist()
    whole = passes[0]
    for more in passes[1:]:
        whole = whole.unionByName(more)
    out = staged(by_text(whole), "frequent")
    drop_staged(spark, hashed, *passes[1:])
    return out, len(passes)


def part(words: str, first: int, count: int) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(
    docs: DataFrame, least: int = 10, longest: int = 3, cover: int = 50, top: int = 2000, sample_of: int = SAMPLE_OF
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``longest`` words.

    ``docs`` has ``doc_id, text, lang``; other columns are not read. A-Z count
    as a-z. Phrases do not reach across ``.,;:!?`` and line ends; words are
    separated by these, blanks and tabs. ``a`` is how often the phrase occurs
    (``least`` times or more), overlaps included, ``n`` how many words the
    language has. A phrase is cut in two, which occur ``l`` and ``r`` times,
    where ``floor(1000000 a a / (l r))``, its score, is lowest; ties go to the
    shorter first part. Phrases are left out if a longer one around them, left
    out itself or not, occurs ``cover`` percent as often or more. Order: score,
    then ``a``, both descending, then bytes of the phrase.

    A null text is empty, a null language is ``und``. Repeated rows, of one id
    or of none, each count. Texts without words and an empty table give no rows.
    The result does not depend on the sample. Counts up to 10**15 are exact.
    """
    if longest != 2 and longest != 3:
        raise ValueError("longest must be 2 or 3 words")
    found, _ = frequent_phrases(docs, least, longest, sample_of)
    count = found.filter("size > 0").select("lang", "phrase", "n")
    phrases = found.filter("size > 1").select("lang", "size", F.col("phrase"), F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": part("words", F.lit(1), F.col("k")), "last": part("words", F.col("k") + 1, F.col("size") - F.col("k"))})
    cuts = cuts.join(count.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(count.select("lang", F.col("phrase").alias("last"), F.col("n").alias("r")), ["lang", "last"])
    wide = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumns({"_up": F.lit(1_000_000).cast("decimal(7,0)") * wide["a"] * wide["a"], "_down": wide["l"] * wide["r"]})
    cuts = cuts.withColumn("score", F.expr("_up div _down").cast("long"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    inner = phrases.filter("size > 2").select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"), "size")
    inner = inner.select("lang", "a", "m", "words", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    around = inner.groupBy("lang", part("words", F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("around"))
    left = scored.join(around, ["lang", "phrase"], "left")
    left = left.filter(F.coalesce(100 * F.col("around") < cover * F.col("a"), F.lit(True)))
    order = [F.desc("x.score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are first ranked in shares, so that no task orders all of them
    left = left.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= top)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = found.filter("size = 0").select("lang", "n")
    out = left.join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("x.l").alias("l"), F.col("x.r").alias("r"), "n", F.col("x.score").alias("score"))
