"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams of 3, 4, 6 and 8 bytes of its
lower-cased words, each word between spaces. On the labelled sample, the ratio
of a feature is the log of its smoothed share in toxic texts over that in
others. A text's vector is how often each feature occurs, times its ratio,
scaled to one length for all texts; the classifier is logistic regression on it
with L2 penalty. Training takes a bounded sample of labelled rows (`sample` of
each class, those with the smallest hash of doc_id, at every input size);
scoring covers every whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import vec
from lakeloom.llm.common import id_crc, map_arrow, only, release

ORDERS = (3, 4, 6, 8)
PIECE = 1 << 18
LENGTH = 10.0


@dataclass
class NBModel:
    place: np.ndarray  # of each bucket, its feature or -1
    ratio: np.ndarray  # of each feature, the log-count ratio
    weights: np.ndarray  # of each feature, the regression weight times the ratio
    bias: float
    bits: int


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def spaced(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with one space before and after each text and every white space as a space."""
    n, texts = len(data), len(offs) - 1
    out = np.full(n + 2 * texts, 32, np.uint8)
    body = vec.LOWER[data]
    body[vec.SPACE[data]] = 32
    out[np.arange(n) + 2 * np.repeat(np.arange(texts), np.diff(offs)) + 1] = body
    return out, offs + 2 * np.arange(texts + 1)


def grams(body: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each order, the hash bucket of the n-gram at every place."""
    long = body.astype(np.uint64)
    packed, out = long.copy(), []
    for n in range(2, max(ORDERS) + 1):
        packed = (packed[: len(long) - n + 1] << np.uint64(8)) | long[n - 1 :] if len(long) >= n else packed[:0]
        if n in ORDERS:
            h = (packed ^ np.uint64(n * 0x9FB21C651E98DF25 % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
            out.append(((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int32))
    return out


def gram_buckets(data: np.ndarray, offs: np.ndarray, bits: int, pick: Callable[[np.ndarray], np.ndarray] = np.asarray) -> Iterator[np.ndarray]:
    """For each text, what `pick` takes of the hash buckets of its n-grams (an empty text has none). A long text is read in pieces, each picked from by itself."""
    data, offs = spaced(data, offs)
    if len(offs) == 2 and len(data) > 2 * PIECE:
        yield np.concatenate([pick(np.concatenate([h[:PIECE] for h in grams(data[a : a + PIECE + max(ORDERS) - 1], bits)])) for a in range(0, len(data), PIECE)])
        return
    per_order = grams(data, bits)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        yield pick(np.concatenate([h[a : max(a, b - n + 1)] for n, h in zip(ORDERS, per_order, strict=True)])) if b - a > 2 else np.zeros(0, np.int32)


def features(column: pa.Array, model: NBModel) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text, its distinct features and their values: counts times ratios, scaled to LENGTH."""

    def pick(buckets: np.ndarray) -> np.ndarray:
        own = model.place[buckets]
        return own[own >= 0]

    for _, _, data, offs in vec.slabs(column, PIECE):
        for own in gram_buckets(data, offs, model.bits, pick):
            own.sort()
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
            own, n = own[first], np.diff(np.append(first, len(own)))
            value = n * model.ratio[own]
            yield own, value * (LENGTH / max(float(np.linalg.norm(value)), 1e-9))


def fit(texts: list[str | None], labels: list[int], bits: int = 21, l2: float = 1e-3, rounds: int = 80, seen_in: int = 3, least_ratio: float = 0.7, lean: float = 3.0) -> NBModel:
    """Trains on the driver, from a bounded sample. Without both classes, every text is as likely toxic as the sample's are (not, without rows).

    Features of fewer than `seen_in` texts, or with a log-count ratio within `least_ratio` of 0, are left out. The toxic class weighs
    `lean` times the other. Accelerated gradient steps on the whole sample.
    """
    y = np.asarray(labels, np.float64)
    size = 1 << bits
    if not len(y) or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.0
        return NBModel(np.full(size, -1, np.int32), np.zeros(0), np.zeros(0), 40.0 if p >= 0.5 else -40.0, bits)
    column = pa.array(texts, pa.string())
    p, q, k = np.full(size, 1.0), np.full(size, 1.0), 0
    for _, _, data, offs in vec.slabs(column, PIECE):
        for b in gram_buckets(data, offs, bits, np.unique):
            (p if y[k] else q)[np.unique(b)] += 1
            k += 1
    ratio = np.log(p / (1 + y.sum())) - np.log(q / (1 + (1 - y).sum()))
    keep = np.flatnonzero((p + q - 2 >= seen_in) & (np.abs(ratio) > least_ratio))
    place = np.full(size, -1, np.int32)
    place[keep] = np.arange(len(keep))
    model = NBModel(place, ratio[keep], np.zeros(0), 0.0, bits)
    rows = [(c, v.astype(np.float32)) for c, v in features(column, model)]
    length = np.array([len(c) for c, _ in rows])
    cols, vals, ends = np.concatenate([c for c, _ in rows]), np.concatenate([v for _, v in rows]), np.concatenate([[0], np.cumsum(length)])
    of_row = np.repeat(np.arange(len(y), dtype=np.int32), length)
    weight = np.where(y == 1, lean / y.mean(), 1 / (1 - y.mean())) / (1 + lean) / len(y)
    del rows

    def forward(w: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(w[cols] * vals)])
        return total[ends[1:]] - total[ends[:-1]]

    def backward(g: np.ndarray) -> np.ndarray:
        return np.bincount(cols, g[of_row] * vals, len(keep)).astype(np.float64)

    v, largest = np.ones(len(keep)), 0.0
    for _ in range(8):  # the largest curvature, by power iteration
        v = backward(weight * forward(v))
        largest = float(np.linalg.norm(v))
        v /= max(largest, 1e-12)
    step = 1 / (largest / 4 + l2)
    w, z, b, zb, t = np.zeros(len(keep)), np.zeros(len(keep)), 0.0, 0.0, 1.0
    for _ in range(rounds):
        g = weight * (probability(forward(z) + zb) - y)
        w1, b1 = z - step * (backward(g) + l2 * z), zb - 2 * g.sum()
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = w1 + (t - 1) / t1 * (w1 - w), b1 + (t - 1) / t1 * (b1 - b)
        w, b, t = w1, b1, t1
    return NBModel(place, ratio[keep], w, float(b), bits)


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, label: str, exclude_remainder: int | None, sample: int) -> tuple[list[str | None], list[int]]:
    """At most `sample` labelled texts of each class, by the smallest hash of doc_id. Labels join by doc_id; a doc_id with several labels counts as toxic if any is, one with several texts as the least of them."""
    marks = only(labels, doc_id="doc_id", label=label).where("doc_id is not null and label in (0, 1)")
    if exclude_remainder is not None:
        marks = marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != exclude_remainder)
    marks = marks.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    chosen = None
    for c in (0, 1):
        part = marks.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionAll(part)
    known = docs.sparkSession.createDataFrame([(r.doc_id, r.label) for r in chosen.collect()], "doc_id bigint, label int")
    got = only(docs, doc_id="doc_id", text=text).join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("doc_id").collect()  # at most 2 * sample rows
    return [r.text for r in got], [r.label for r in got]


def margins(column: pa.Array, model: NBModel) -> np.ndarray:
    """The linear score of every text."""
    return np.array([float(model.weights[own] @ value) for own, value in features(column, model)] if len(model.weights) else [0.0] * len(column)) + model.bias


def score(docs: DataFrame, model: NBModel, text: str = "text") -> DataFrame:
    """doc_id, held_out (crc32(doc_id as text) mod 5 is 0), score and predicted of every row. Null and empty texts score by the bias alone; equal texts score alike, and repeated rows stay. An empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            p = probability(margins(batch.column(1), m))
            held = [id_crc(x) % 5 == 0 for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.bool_()), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return map_arrow(only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id bigint, held_out boolean, score double, predicted int")


def kept(docs: DataFrame, model: NBModel, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that the model does not call toxic (score below 0.5); repeated rows go or stay together."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            clean = probability(margins(batch.column(place), m)) < 0.5
            yield batch.filter(pa.array(clean, pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", exclude_remainder: int | None = 0, sample: int = 1500) -> DataFrame:
    """Trains on the labelled rows outside the held-out fold and scores every document."""
    model = fit(*labelled_sample(docs, labels, text, label, exclude_remainder, sample))
    release()
    return score(docs, model, text)
