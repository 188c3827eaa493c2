"""Operator 2: toxicity by a classifier chain.

Categories are predicted one after another. A link of the chain is a linear model over the words of a text and the
probabilities that the earlier links gave it; in training those come from models that did not see the row (out of fold), so a
later link learns how far it may trust them. The last link is the overall label.

Categories are label columns if there are any. Where only the overall label exists, they are learned from its rows: the toxic
sample rows are grouped by the telling words that occur in them together (k-means on the directions of their vectors), and each
group is a category.

Features are words and word beginnings, hashed to ``BITS`` bits. Spark counts over all labelled training rows in how many
texts of each class a feature stands; its weight in a row's vector is the number of standard errors that its log odds ratio is
from zero, and vectors have length 1. No feature is left out. The linear models (hinge loss, dual coordinate descent) and the
logistic curves that make probabilities of their margins are fitted on the driver on a sample of each class: the rows with the smallest
hash of id and features, at most ``SAMPLE`` of them and ``SAMPLE_BYTES`` of features, weighted to stand for all rows. Scoring reads every text
once. Of all texts, only those whose id may be labelled (a bitmap of fixed size says) give their words to the training.

Defined results: a label that is null, not 0 or 1, or differs between rows of one id, is not used. Rows whose crc32 of
the id as text leaves 2 mod 4 are held out of the training. Null and empty texts get the models' constants. A category
without training rows of both classes has a constant probability. Each row gives one row, repeated rows included.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import raw_bytes, slices, written
from aislewise.llm.fmindex import split_words
from aislewise.llm.nbsvm import fit_curve, held_out, pack, possibly_labelled, unpack

BITS = 18  # of a feature's number
SIZE = 1 << BITS
STEMS = (4, 5, 6, 7, 8)  # bytes of a word's beginning that count as features of their own, as endings vary
SAMPLE = 4_000
SAMPLE_BYTES = 24 << 20  # of a class, 4 a feature
FOLDS = 3
KINDS = 2
TELLING = 3.0  # standard errors of a feature that groups rows
COST = 1.0
EPOCHS = 10
REMEMBERED = 100_000
THRESHOLD = 0.5

Row = tuple[np.ndarray, np.ndarray]  # feature numbers and values
number, SHIFT = xxhash.xxh32_intdigest, 32 - BITS
FORMATS = [f"<{n}I" for n in range(len(STEMS) + 2)]


def word_numbers(word: bytes) -> bytes:
    """The numbers of a word and of its beginnings."""
    found = [number(word) >> SHIFT, *(number(b"^" + word[:n]) >> SHIFT for n in STEMS if len(word) >= n)]
    return struct.pack(FORMATS[len(found)], *found)


def numbers(text: bytes, known: dict[bytes, bytes]) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    if len(known) > REMEMBERED:
        known.clear()
    words = set(split_words(text))
    for w in words:
        if w not in known:
            known[w] = word_numbers(w)
    return np.unique(np.frombuffer(b"".join(map(known.__getitem__, words)), dtype="<u4"))


def labelled(docs: DataFrame, labels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(doc_id, features, y0, y1, ...) of the rows that may be learned from."""
    agreed = labels.groupBy("doc_id").agg(
        *(F.min(c).cast("int").alias(f"y{k}") for k, c in enumerate(columns)),
        *(F.max(c).cast("int").alias(f"h{k}") for k, c in enumerate(columns)),
    )
    for k in range(len(columns)):
        agreed = agreed.where(f"y{k} = h{k} AND y{k} IN (0, 1)")
    agreed = agreed.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    agreed = agreed.select("doc_id", *(f"y{k}" for k in range(len(columns))))

    def measure() -> Callable[[bytes], bytes]:
        known: dict[bytes, bytes] = {}
        return lambda text: pack(numbers(text, known))

    return possibly_labelled(docs, agreed, measure, "features").join(agreed, "doc_id")


def class_counts(rows: DataFrame, y: str) -> np.ndarray:
    """How many rows of class 0 and 1 hold each feature; the last column counts the rows. At most SIZE + 1 rows come back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIZE + 1), dtype=np.int32)
        for part in (part for batch in batches for part in slices(batch)):
            for packed, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counts[label, unpack(packed)] += 1
                counts[label, SIZE] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c[at]) for c in counts)], ["feature", "zero", "one"])

    parts = rows.select("features", y).mapInArrow(work, "feature int, zero int, one int")
    total = parts.groupBy("feature").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toPandas()
    out = np.zeros((2, SIZE + 1))
    out[:, total["feature"].to_numpy(dtype=int)] = total[["zero", "one"]].to_numpy(dtype=float).T
    return out


def standard_errors(counts: np.ndarray) -> np.ndarray:
    """Of each feature, its log odds ratio in standard errors; 0 where no row holds it."""
    zero, one = counts[:, :SIZE]
    a, b, c, d = one + 0.5, counts[1, SIZE] - one + 0.5, zero + 0.5, counts[0, SIZE] - zero + 0.5
    z = np.log(a * d / (b * c)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return np.where(zero + one > 0, z, 0.0)


def scaled(at: np.ndarray, scale: np.ndarray) -> Row:
    value = scale[at]
    norm = np.sqrt((value.astype(float) ** 2).sum())
    return at, value / np.float32(norm) if norm else value


def sampled(rows: DataFrame, y: str, label: int) -> list:
    """The sample of one class: rows in the order of a hash of id and features, until either bound is met.

    The bounds are found from hashes and sizes alone, so that only the sample itself is sent. Rows of one hash are equal.
    """
    own = rows.where(F.col(y) == label).withColumn("hash", F.xxhash64("doc_id", "features"))
    sizes = own.select("hash", F.octet_length("features").alias("n")).orderBy("hash").limit(SAMPLE).collect()
    if not sizes:
        return []
    fits = int((np.cumsum([0, *(r.n for r in sizes[:-1])]) < SAMPLE_BYTES).sum())
    last = sizes[fits - 1]["hash"]
    before = own.where(F.col("hash") < last).collect()
    at_last = own.where(F.col("hash") == last).limit(fits - len(before)).collect()
    return sorted(before + at_last, key=lambda r: r["hash"])


def grouped(rows: list[Row], scale: np.ndarray, kinds: int) -> np.ndarray:
    """A group from 0 for each row, by the features of at least ``TELLING`` standard errors that occur in rows together.

    k-means on the rows' directions. The first centre is the row that tells most, each further one the row farthest from the
    centres so far. Rows that tell nothing are of group 0.
    """
    told = []
    for at, value in rows:
        strong = scale[at] >= TELLING
        told.append((at[strong], scale[at[strong]].astype(float)))
    norms = np.array([np.sqrt((v**2).sum()) for _, v in told])
    told = [(at, v / n if n else v) for (at, v), n in zip(told, norms)]
    usable = np.flatnonzero(norms > 0)
    group = np.zeros(len(rows), dtype=np.int64)
    if not len(usable):
        return group
    centres = np.zeros((kinds, SIZE))
    first = usable[norms[usable].argmax()]
    centres[0, told[first][0]] = told[first][1]
    for k in range(1, kinds):
        nearest = np.array([max(centres[j, told[i][0]] @ told[i][1] for j in range(k)) for i in usable])
        far = usable[nearest.argmin()]
        centres[k, told[far][0]] = told[far][1]
    for _ in range(20):
        near = np.array([centres[:, told[i][0]] @ told[i][1] for i in usable])
        new = near.argmax(axis=1)
        if (group[usable] == new).all() and _:
            break
        group[usable] = new
        centres[:] = 0
        for i, k in zip(usable.tolist(), new.tolist()):
            centres[k, told[i][0]] += told[i][1]
        norm = np.sqrt((centres**2).sum(axis=1, keepdims=True))
        np.divide(centres, norm, out=centres, where=norm > 0)
    return group


@dataclass(frozen=True)
class Link:
    """Weights of features, of the earlier links' probabilities, the constant, and the curve from margins to probabilities."""

    weights: np.ndarray
    earlier: np.ndarray
    constant: float
    slope: float
    offset: float

    def margin(self, row: Row, before: np.ndarray) -> float:
        at, value = row
        return float(self.weights[at] @ value + self.earlier @ centred(before) + self.constant)

    def probability(self, row: Row, before: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(row, before) + self.offset, -40, 40))))


def centred(before: np.ndarray) -> np.ndarray:
    """Earlier probabilities as features between -1 and 1."""
    return 2 * np.asarray(before, dtype=float) - 1


def fit_hinge(rows: list[Row], before: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of the features, then of the earlier links, then the constant, by dual coordinate descent: each step solves for
    one row's multiplier, kept between 0 and its cost, and moves the weights along the row."""
    m = before.shape[1]
    w, alpha = np.zeros(SIZE + m + 1), np.zeros(len(rows))
    dense = np.column_stack([centred(before), np.ones(len(rows))])
    square = np.array([(v**2).sum() for _, v in rows]) + (dense**2).sum(axis=1) if rows else np.zeros(0)
    draw = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in draw.permutation(len(rows)):
            at, value = rows[i]
            gradient = y[i] * (w[at] @ value + w[SIZE:] @ dense[i]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * value
                w[SIZE:] += step * dense[i]
                alpha[i] = new
    return w


def fit_link(rows: list[Row], before: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[Link, np.ndarray]:
    """The link fitted on all rows, and the probabilities that links fitted on the other folds give each row. ``y`` is 0 or 1."""
    m = before.shape[1]
    if not len(y) or y.min() == y.max():
        share = (float(y.mean()) if len(y) else 0.0) * (1 - 2e-6) + 1e-6
        link = Link(np.zeros(SIZE, dtype=np.float32), np.zeros(m), 0.0, 0.0, float(np.log(share / (1 - share))))
        return link, np.full(len(y), share)
    sign = np.where(y > 0, 1.0, -1.0)
    cost = COST * 0.5 * len(y) / np.where(y > 0, (y > 0).sum(), (y == 0).sum())
    fold = np.arange(len(y)) % FOLDS
    margins = np.zeros(len(y))
    for k in range(FOLDS):
        seen, unseen = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        w = fit_hinge([rows[i] for i in seen], before[seen], sign[seen], cost[seen])
        link = Link(w[:SIZE], w[SIZE : SIZE + m], float(w[-1]), 1.0, 0.0)
        margins[unseen] = [link.margin(rows[i], before[i]) for i in unseen]
    slope, offset = fit_curve(margins, sign, weight)
    w = fit_hinge(rows, before, sign, cost)
    link = Link(w[:SIZE].astype(np.float32), w[SIZE : SIZE + m], float(w[-1]), slope, offset)
    return link, 1 / (1 + np.exp(-np.clip(slope * margins + offset, -40, 40)))


@dataclass(frozen=True)
class Chain:
    """The scale of features and the links in order. Its size is fixed by ``BITS`` and the number of links."""

    names: tuple[str, ...]
    scale: np.ndarray
    links: tuple[Link, ...]

    def probabilities(self, numbers: np.ndarray) -> list[float]:
        row, out = scaled(numbers, self.scale), []
        for link in self.links:
            out.append(link.probability(row, np.array(out)))
        return out


def fit(docs: DataFrame, labels: DataFrame, label: str, categories: Sequence[str] = (), kinds: int = KINDS) -> Chain:
    """The chain, fitted on the labelled rows of ``docs`` that are not held out; ``categories`` are label columns, and without
    them ``kinds`` groups of toxic rows are."""
    columns = [*categories, label]
    names = [*(categories or (f"kind_{k + 1}" for k in range(kinds))), label]
    last = f"y{len(columns) - 1}"
    rows = written(labelled(docs, labels, columns))
    counts = class_counts(rows, last)
    scale = standard_errors(counts).astype(np.float32)
    sample = [r for k in (0, 1) for r in sampled(rows, last, k)]
    x = [scaled(unpack(r.features).astype(np.int32), scale) for r in sample]
    y = np.array([[r[f"y{k}"] for k in range(len(columns))] for r in sample], dtype=float).reshape(len(sample), len(columns))
    toxic = y[:, -1]
    if not categories:
        group = np.full(len(sample), -1)
        at = np.flatnonzero(toxic > 0)
        group[at] = grouped([x[i] for i in at], scale, kinds)
        y = np.column_stack([*((group == k).astype(float) for k in range(kinds)), toxic])
    # Each sampled row stands for as many rows of its class as all its class has to the sample.
    weight = np.where(toxic > 0, counts[1, SIZE] / max(1, (toxic > 0).sum()), counts[0, SIZE] / max(1, (toxic == 0).sum()))
    links, before = [], np.zeros((len(sample), 0))
    for j in range(y.shape[1]):
        link, unseen = fit_link(x, before, y[:, j], weight)
        links.append(link)
        before = np.column_stack([before, unseen])
    return Chain(tuple(names), scale, tuple(links))


def report(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", categories: Sequence[str] = (), threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, held_out, a probability ``p_<name>`` per category and for the label, and ``toxic``: whether the label's reaches
    ``threshold``."""
    chain = fit(docs, labels, label, categories)
    parts = (chain.names, chain.scale, [(x.weights, x.earlier, x.constant, x.slope, x.offset) for x in chain.links])
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    names = [f"p_{name}" for name in chain.names]
    schema = docs.select("doc_id").schema
    for name in names:
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, scale, links = shared.value
        held, known = Chain(own, scale, tuple(Link(*x) for x in links)), {}
        for part in (part for batch in batches for part in slices(batch)):
            ps = [held.probabilities(numbers(t, known)) for t in raw_bytes(part.column(1))]
            columns = np.array(ps, dtype=float).reshape(len(ps), len(names)).T
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns)], schema.names)

    scores = docs.select("doc_id", "text").mapInArrow(run, schema)
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), *names, (F.col(names[-1]) >= threshold).alias("toxic")
    )
