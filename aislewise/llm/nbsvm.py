"""Operator 10: document quality by naive Bayes support vectors.

Features are n-grams (1 to 3) of word shapes and single words, as hashed indicators. A word's shape keeps its
punctuation and reduces letters to ``A`` or ``a`` and digits to ``0``, runs to one. Of all labelled training rows, Spark
counts in how many texts of each class a feature stands; the log ratio of the two smoothed rates scales the indicator.
A linear hinge-loss model is then fitted by dual coordinate descent on at most ``SAMPLE`` rows of each class, those
with the smallest hash of their id. Its margins become probabilities by a logistic curve fitted on margins from models
that did not see the row.

Counts cover all training rows; the sample bounds only the fit of the linear model, on the driver. Shuffles carry a row
per (feature, task) for the counts, and features of rows that may be labelled, not texts, for the join with labels.
Features of other rows are never stored: a second scan scores every text as it reads it.

Defined results: labels that are null, or differ between rows of one id, are not used. A row is held out if crc32 of
its id as text leaves 2 mod 4; a null id is neither held out nor labelled. Null and empty texts have no features and
get the model's constant. If one class has no training rows, every score is the share of class 1 (0.5 without any).
Every row gives one row, repeated rows included.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from copy import copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import raw_bytes, slices, written
from aislewise.llm.minhash import bit_of, bitmap

BITS = 18
SIZE = 1 << BITS
SAMPLE = 6_000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.7
HELD_OUT = 2

SHAPES = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
REMEMBERED = 50_000


def hashes(words: list[bytes], known: dict[bytes, int], seed: int) -> np.ndarray:
    if len(known) > REMEMBERED:
        known.clear()
    for w in {x for x in words if x not in known}:
        known[w] = xxhash.xxh3_64_intdigest(w, seed)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shape(text: bytes) -> bytes:
    """The text with letters and digits reduced to their kind, and runs of one byte to one."""
    kinds = np.frombuffer(text.translate(SHAPES), dtype=np.uint8)
    return kinds[np.concatenate([[True], kinds[1:] != kinds[:-1]])].tobytes() if len(kinds) else b""


def ngrams(h: np.ndarray, longest: int) -> list[np.ndarray]:
    out = [h]
    for n in range(2, longest + 1):
        h = (out[-1][:-1] if len(out[-1]) else out[-1]) * np.uint64(0x9E3779B97F4A7C15) + out[0][n - 1 :]
        out.append(h ^ (h >> np.uint64(31)))
    return out


def features(text: bytes, known: tuple[dict, dict]) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    shapes = hashes(shape(text).split(), known[0], 1)
    words = hashes(text.translate(LOWER).split(), known[1], 2)
    return np.unique(np.concatenate([*ngrams(shapes, 3), words]) >> np.uint64(64 - BITS)).astype("<u4")


def pack(numbers: np.ndarray) -> bytes:
    """Sorted numbers as their differences, byte plane by byte plane: the high planes are mostly zero and compress."""
    steps = np.diff(numbers.astype("<u4"), prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(packed: bytes | None) -> np.ndarray:
    planes = np.frombuffer(packed or b"", dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def possibly_labelled(docs: DataFrame, ids: DataFrame, measure: Callable[[], Callable[[bytes], bytes]], into: str) -> DataFrame:
    """(doc_id, ``into``) of the rows of ``docs`` whose id is in ``ids``, and of a few more.

    A bitmap of fixed size tells which texts to read; the join with the labels, which follows, is exact. ``measure``
    makes, once a task, the function from a text to what is kept of it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select(bit_of(F.col("doc_id")).alias("bit"))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = shared.value, measure()
        for batch in batches:
            bit = batch.column(2).to_numpy()
            wanted = pa.array(((held[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool))
            for part in slices(batch.filter(wanted)):
                packed = pa.array(list(map(kept, raw_bytes(part.column(1)))), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), packed], ["doc_id", into])

    schema = docs.select("doc_id").schema.add(into, "binary")
    return docs.select("doc_id", "text", bit_of(F.col("doc_id")).alias("bit")).mapInArrow(work, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def agreed_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of the labels that may be learned from."""
    agreed = labels.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("y2")).where("y = y2 AND y IN (0, 1)")
    agreed = agreed.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return agreed.select("doc_id", F.col("y").cast("int").alias("y"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, features, y) of the rows that may be learned from."""

    def measure() -> Callable[[bytes], bytes]:
        known: tuple[dict, dict] = ({}, {})
        return lambda text: pack(features(text, known))

    agreed = agreed_labels(labels, label)
    return possibly_labelled(docs, agreed, measure, "features").join(agreed, "doc_id")


def class_counts(rows: DataFrame) -> np.ndarray:
    """How many rows of class 0 and 1 hold each feature; the last column counts the rows. At most SIZE rows come back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIZE + 1), dtype=np.int64)
        for part in (part for batch in batches for part in slices(batch)):
            for packed, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counts[y, unpack(packed)] += 1
                counts[y, SIZE] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(c[at]) for c in counts)], ["feature", "zero", "one"])

    parts = rows.select("features", "y").mapInArrow(work, "feature long, zero long, one long")
    total = parts.groupBy("feature").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toArrow()
    out = np.zeros((2, SIZE + 1))
    for y, column in enumerate(("zero", "one")):
        out[y, total["feature"].to_numpy()] = total[column].to_numpy()
    return out


def sampled(rows: DataFrame, y: int) -> DataFrame:
    """The ``SAMPLE`` rows of one class with the smallest hashes of their ids, in order.

    The last hash is found first, without features: otherwise every task would send so many rows to the driver.
    """
    own = rows.where(F.col("y") == y).withColumn("hash", F.xxhash64("doc_id"))
    last = own.select("hash").orderBy("hash").limit(SAMPLE).agg(F.max("hash")).first()[0]
    return own.where(F.col("hash") <= F.lit(last)).orderBy("hash", "doc_id", "features").limit(SAMPLE).select("features")


class Sample(Sequence):
    """Rows as (feature numbers, values). The numbers lie in one array; values, twice as large, are made when a row is read."""

    def __init__(self, packed: list[bytes], ratios: np.ndarray):
        self.ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
        self.numbers = np.empty(self.ends[-1], dtype=np.uint32)
        for i, p in enumerate(packed):
            self.numbers[self.ends[i] : self.ends[i + 1]] = unpack(p)
        self.ratios, self.chosen = ratios, np.arange(len(packed))

    def of(self, chosen: np.ndarray) -> Sample:
        """The rows with these numbers; nothing is copied."""
        out = copy(self)
        out.chosen = self.chosen[chosen]
        return out

    def __len__(self) -> int:
        return len(self.chosen)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.chosen[i]
        return scaled(self.numbers[self.ends[k] : self.ends[k + 1]], self.ratios)


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """Log of the ratio of the smoothed rates in class 1 and class 0; features without a row get 0."""
    zero, one = ((c[:SIZE] + SMOOTHING) / (c[SIZE] + 2 * SMOOTHING) for c in counts)
    return np.where(counts[:, :SIZE].any(axis=0), np.log(one / zero), 0.0)


def scaled(at: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a row, of length 1 so that long texts don't outweigh short ones."""
    value = ratios[at]
    norm = np.sqrt((value**2).sum())
    return at, value / norm if norm else value


def fit_hinge(rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights, the last one constant, of the hinge loss by dual coordinate descent: each step solves for one row's
    multiplier, kept between 0 and its cost, and moves the weights along the row."""
    w = np.zeros(SIZE + 1)
    alpha = np.zeros(len(rows))
    square = np.array([1.0 + (v**2).sum() for _, v in rows])
    draw = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in draw.permutation(len(rows)):
            at, value = rows[i]
            gradient = y[i] * (w[at] @ value + w[SIZE]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * value
                w[SIZE] += step
                alpha[i] = new
    return w


def fit_curve(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to class 1, by Newton steps on smoothed targets."""
    one, zero = weight[y > 0].sum(), weight[y < 0].sum()
    target = np.where(y > 0, (one + 1) / (one + 2), 1 / (zero + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    beta = np.array([1.0, np.log((one + 1) / (zero + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


@dataclass(frozen=True)
class Model:
    """Weight of each feature with its ratio applied, ratios, constant, and the curve. Its size is fixed by ``BITS``."""

    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def score(self, numbers: np.ndarray) -> float:
        at, value = scaled(numbers, self.ratios)
        margin = self.weights[at] @ value + self.weights[SIZE]
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40))))


def fit(docs: DataFrame, labels: DataFrame, label: str) -> Model:
    """Fits on the labelled rows of ``docs`` that are not held out."""
    rows = written(training_rows(docs, labels, label))
    counts = class_counts(rows)
    zero, one = counts[:, SIZE]
    if not zero or not one:
        share = (one + 1e-9) / (zero + one + 2e-9)
        return Model(np.zeros(SIZE), np.zeros(SIZE + 1), 0.0, float(np.log(share / (1 - share))))
    ratios = log_count_ratios(counts)
    classes = [[r.features for r in sampled(rows, y).collect()] for y in (0, 1)]
    y = np.repeat([-1.0, 1.0], [len(c) for c in classes])
    x = Sample(classes.pop(0) + classes.pop(), ratios)
    # Each sampled row stands for as many rows of its class as all its class has to the sample.
    weight = np.where(y > 0, one / (y > 0).sum(), zero / (y < 0).sum())
    cost = COST * np.where(y > 0, 0.5 * len(y) / (y > 0).sum(), 0.5 * len(y) / (y < 0).sum())
    fold = np.arange(len(y)) % 3
    margins = np.zeros(len(y))
    for k in range(3):
        seen = np.flatnonzero(fold != k)
        w = fit_hinge(x.of(seen), y[seen], cost[seen])
        margins[fold == k] = [w[at] @ value + w[SIZE] for at, value in x.of(np.flatnonzero(fold == k))]
    return Model(ratios, fit_hinge(x, y, cost), *fit_curve(margins, y, weight))


def scored(docs: DataFrame, model: Model, keep: bool = False) -> DataFrame:
    """(doc_id, score) of every row; with ``keep`` instead the rows of class 1, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast((model.ratios, model.weights, model.slope, model.offset))
    at = docs.columns.index("text") if keep else 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = Model(*shared.value), ({}, {})
        for part in (part for batch in batches for part in slices(batch)):
            scores = np.array([held.score(features(t, known)) for t in raw_bytes(part.column(at))], dtype=float)
            if keep:
                yield part.filter(pa.array(scores >= THRESHOLD))
            else:
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    if keep:
        return docs.mapInArrow(work, docs.schema)
    return docs.select("doc_id", "text").mapInArrow(work, docs.select("doc_id").schema.add("score", "double"))


def report(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    return scored(docs, fit(docs, labels, label)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the model fitted on them predicts to be of class 1, all columns as they are."""
    return scored(docs, fit(docs, labels, label), keep=True)
