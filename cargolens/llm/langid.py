"""Language ID by a byte convolutional network.

Filters of several widths slide over the bytes of fixed-length windows; each
filter's maximum goes through a softmax layer. The network is trained in numpy
on windows of labelled documents. Every window of a whole text is classified,
and their probabilities are averaged by length.

A filter of width w is a table per offset, so a convolution is w lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from cargolens.llm.textbytes import slices, utf8

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")

#: Windows that are convolved at a time.
BATCH = 256

#: Labels that are learnt at most.
LANGUAGES = 512


@dataclass
class Network:
    """``filters[w]`` has shape (w, 256, n): offset, byte, filter."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    shift: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    window: int

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Maxima of all filters over the windows ``x`` (rows of bytes), and where they are."""
        out, places = [], {}
        for w, table in self.filters.items():
            n = x.shape[1] - w + 1
            total = table[0][x[:, :n]]
            for j in range(1, w):
                total += table[j][x[:, j : j + n]]
            places[w] = total.argmax(1)
            out.append(np.take_along_axis(total, places[w][:, None, :], 1)[:, 0])
        return np.concatenate(out, 1), places

    def maxima(self, x: np.ndarray) -> np.ndarray:
        """As ``pooled``, without the places."""
        out = []
        for w, table in self.filters.items():
            n = x.shape[1] - w + 1
            total = np.take(table[0], x[:, :n], axis=0)
            for j in range(1, w):
                total += np.take(table[j], x[:, j : j + n], axis=0)
            out.append(total.max(1))
        return np.concatenate(out, 1)

    def softmax(self, features: np.ndarray) -> np.ndarray:
        z = np.maximum(features + self.shift, 0) @ self.weights + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for windows of any number."""
        parts = [self.softmax(self.maxima(x[i : i + BATCH])) for i in range(0, len(x), BATCH)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    languages: list[str],
    widths: tuple[int, ...] = (2, 3, 4),
    n_filters: int = 8,
    epochs: int = 8,
    seed: int = 1,
) -> Network:
    """Fit a network to windows (rows of bytes) by Adam on the cross entropy; the same input gives the same network."""
    rng = np.random.default_rng(seed)
    total = n_filters * len(widths)
    net = Network(
        languages,
        {w: (rng.standard_normal((w, 256, n_filters)) / w).astype(np.float32) for w in widths},
        np.zeros(total, np.float32),
        (rng.standard_normal((total, len(languages))) / np.sqrt(total)).astype(np.float32),
        np.zeros(len(languages), np.float32),
        windows.shape[1],
    )
    values = [*net.filters.values(), net.shift, net.weights, net.bias]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for lo in range(0, len(order), 64):
            x, y = windows[order[lo : lo + 64]], labels[order[lo : lo + 64]]
            features, places = net.pooled(x)
            active = np.maximum(features + net.shift, 0)
            error = net.softmax(features)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.weights.T) * (active > 0)
            grads = []
            for i, w in enumerate(widths):
                grad = np.zeros_like(net.filters[w])
                mine = back[:, i * n_filters : (i + 1) * n_filters]
                for j in range(w):
                    byte = x[np.arange(len(y))[:, None], places[w] + j]
                    np.add.at(grad[j], (byte, np.arange(n_filters)[None, :]), mine)
                grads.append(grad)
            grads += [back.sum(0), active.T @ error, error.sum(0)]
            step += 1
            rate = 0.02 * (1 - epoch / (epochs + 1))
            for v, g, m, s in zip(values, grads, means, squares, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return net


def windows_of(raw: list[bytes], window: int) -> np.ndarray:
    """Rows of ``window`` bytes, zeros behind a shorter one."""
    out = np.zeros((len(raw), window), np.uint8)
    for row, b in zip(out, raw, strict=True):
        row[: min(len(b), window)] = np.frombuffer(b[:window], np.uint8)
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """True for a third of the documents; they are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def labelled_windows(docs: DataFrame, per_language: int, windows: int, window: int, languages: int = LANGUAGES) -> DataFrame:
    """``lang, bytes``: some windows from all over the texts of a bounded, fixed sample of documents.

    A document is in the sample of its language if its hash is the smallest of
    those with the same remainder, so at most ``per_language`` of each are. Of
    more than ``languages`` labels the most frequent are learnt, ties by name.
    """
    h = F.xxhash64("doc_id")
    allowed = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    common = allowed.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")
    allowed = allowed.join(F.broadcast(common), "lang")
    ids = allowed.groupBy("lang", F.pmod(h, F.lit(per_language)).alias("slot")).agg(F.min(F.struct(h, "doc_id")).alias("x"))
    # at most per_language * languages rows
    ids = F.broadcast(ids.select("lang", F.col("x.doc_id").alias("doc_id")))
    chosen = allowed.select("doc_id", "lang", "text").join(ids, ["doc_id", "lang"]).filter(F.col("text").rlike(r"\p{L}"))
    last = F.greatest(F.length("text") - window, F.lit(0)) + 1
    starts = [F.pmod(F.xxhash64("doc_id", F.lit(i)), last) + 1 for i in range(windows)]
    piece = F.explode(F.array(*[F.substring(F.col("text"), s.cast("int"), F.lit(window)) for s in starts]))
    return chosen.select("lang", "doc_id", piece.alias("piece")).distinct()


def learn(
    docs: DataFrame, per_language: int = 200, windows: int = 4, window: int = 256, max_rows: int = 40_000, seed: int = 1
) -> Network | None:
    """A network from ``doc_id, text, lang`` of at most ``per_language`` documents of each language.

    Learns from documents that have an id and a language and are not held out:
    ``windows`` pieces of each, ``max_rows`` pieces altogether. Half of them are
    cut short, so that short texts are known, too. None if there is no such document.
    """
    sample = labelled_windows(docs, per_language, windows, window).orderBy(F.xxhash64("piece", "doc_id"), "lang", "piece")
    rows = sample.limit(max_rows).collect()
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    raw = [r.piece.encode() for r in rows]
    raw = [b if i % 2 else b[: int(rng.integers(8, window))] for i, b in enumerate(raw)]
    languages = sorted({r.lang for r in rows})
    labels = np.array([languages.index(r.lang) for r in rows])
    return train(windows_of(raw, window), labels, languages, seed=seed)


def lettered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """True for the texts that have a letter."""
    texts = (data[a : a + n].tobytes().decode() for a, n in zip(start, length, strict=True))
    return np.array([LETTER.search(t) is not None for t in texts], bool)


@F.arrow_udf(BooleanType())
def has_letter(text: pa.Array) -> pa.Array:
    """True for a text with a letter; ``identify`` knows no language of the others, and null has none."""
    offsets, data = utf8(text)
    return pa.array(lettered(data, offsets[:-1], np.diff(offsets)))


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """All columns of ``docs`` (``text``) and a struct ``language`` of ``pred, score``.

    ``pred`` is a learnt language, or ``und`` with score 0 if the text is null,
    has no letter, or nothing could be learnt. ``score`` is the mean
    probability of ``pred`` over all windows of the whole text, by length.
    """
    if "language" in docs.columns:
        raise ValueError("there is a column language already")
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def classify(text: pa.Array) -> pa.Array:
        net = shared.value
        offsets, data = utf8(text)
        pred, score = [], []
        for lo, hi in slices(offsets, 1 << 20):
            start, length = offsets[lo:hi], np.diff(offsets[lo : hi + 1])
            known = lettered(data, start, length)
            if net is None:
                known[:] = False
            rows = np.flatnonzero(known)
            many = -(-length[rows] // (net.window if net else 1))
            first = np.cumsum(many) - many
            row = np.repeat(np.arange(len(rows)), many)
            at = start[rows][row] + (np.arange(many.sum()) - first[row]) * (net.window if net else 1)
            ends = (start + length)[rows][row]
            best, p = np.full(hi - lo, UNKNOWN, object), np.zeros(hi - lo)
            if len(rows):
                total = np.zeros((len(rows), len(net.languages)))
                for i in range(0, len(at), BATCH):
                    place = at[i : i + BATCH, None] + np.arange(net.window)
                    inside = place < ends[i : i + BATCH, None]
                    x = np.where(inside, data[np.minimum(place, len(data) - 1)], 0)
                    np.add.at(total, row[i : i + BATCH], net.predict(x) * inside.sum(1)[:, None])
                total /= length[rows][:, None]
                best[rows] = np.array(net.languages, object)[total.argmax(1)]
                p[rows] = np.minimum(total.max(1), 1.0)
            pred.extend(best)
            score.append(p)
        out = [pa.array(pred, pa.string()), pa.array(np.concatenate(score) if score else [], pa.float64())]
        return pa.StructArray.from_arrays(out, ["pred", "score"])

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            yield classify(text)

    udf = F.arrow_udf(run, "struct<pred: string, score: double>", F.ArrowUDFType.SCALAR_ITER)
    return docs.withColumn("language", udf("text"))
