import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from aislewise.llm import nbsvm
from aislewise.llm.queries import QUERIES
from tests.llm.plain import curve, hinge

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, score double"


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def made(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 8)))
    docs, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        docs.append((i, " ".join(word() + ("" if good or rng.random() < 0.3 else "%%") for _ in range(rng.randrange(8, 60)))))
        labels.append((i, int(good), 0.5))
    return docs, labels


def frames(spark, docs, labels):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, y int, features string")
    return df, spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    docs, labels = made(400)
    truth = dict((d, q) for d, q, _ in labels)
    rows = nbsvm.report(*frames(spark, docs, labels)).collect()
    assert len(rows) == 400 and all(r.held_out == held_out(r.doc_id) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_query_on_the_test_tables(spark):
    """Rows are those of the table, and labels of held-out rows are met."""
    rows = QUERIES["op10_nbsvm"](spark, SF).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]) > 0.9


def test_scores_equal_a_plain_version(spark):
    docs, labels = made(150, seed=4)
    df, lab = frames(spark, docs, labels)
    got = {r.doc_id: r.score for r in nbsvm.report(df, lab).collect()}
    truth = {d: q for d, q, _ in labels}
    held = {d: {int(x) for x in nbsvm.features(t.encode(), ({}, {}))} for d, t in docs}
    train = [d for d in held if not held_out(d)]
    n = Counter(truth[d] for d in train)
    counts = {y: Counter(x for d in train if truth[d] == y for x in held[d]) for y in (0, 1)}

    def ratio(x):
        zero, one = ((counts[y][x] + 1) / (n[y] + 2) for y in (0, 1))
        return math.log(one / zero) if counts[0][x] or counts[1][x] else 0.0

    def vector(d):
        v = {x: ratio(x) for x in held[d]}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {k: x / norm for k, x in v.items()} if norm else v

    hashes = {r.doc_id: r.h for r in df.selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    sample = [d for y in (0, 1) for d in sorted((d for d in train if truth[d] == y), key=lambda d: hashes[d])]
    rows, y = [vector(d) for d in sample], np.array([1 if truth[d] else -1 for d in sample])
    cost = nbsvm.COST * 0.5 * len(y) / np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    fold, margins = np.arange(len(y)) % 3, np.zeros(len(y))
    for k in range(3):
        seen = np.flatnonzero(fold != k)
        w = hinge([rows[i] for i in seen], y[seen], cost[seen], nbsvm.EPOCHS)
        for i in np.flatnonzero(fold == k):
            margins[i] = sum(w.get(x, 0.0) * v for x, v in rows[i].items()) + w["constant"]
    slope, offset = curve(margins, y, np.ones(len(y)))
    w = hinge(rows, y, cost, nbsvm.EPOCHS)
    for d, _ in docs:
        m = sum(w.get(x, 0.0) * v for x, v in vector(d).items()) + w["constant"]
        assert abs(got[d] - 1 / (1 + math.exp(-(slope * m + offset)))) < 1e-4, d


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = made(120)
    turned = [(d, 1 - q if held_out(d) else q, s) for d, q, s in labels]
    score = lambda ls: {r.doc_id: r.score for r in nbsvm.report(*frames(spark, docs, ls)).collect()}
    assert score(labels) == score(turned)


def test_cases(spark):
    docs, labels = made(60)
    docs += [(100, None), (101, ""), (None, "a b"), (102, "x" * 200_000), (5, "again"), (5, "again")]
    labels += [(None, 1, 0.0), (7, None, 0.0), (8, 1, 0.0), (8, 0, 0.0), (999, 0, 0.0), (9, 5, 0.0)]
    rows = nbsvm.report(*frames(spark, docs, labels)).collect()
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.score, r.held_out))
    assert by[100][0][0] == by[101][0][0] and by[None][0][1] is False and len(by[5]) == 3


def test_training_rows(spark):
    _, labels = made(10)
    table = spark.createDataFrame([(i, "a") for i in range(10)], "doc_id long, text string")
    extra = [(3, 1 - dict((d, q) for d, q, _ in labels)[3], 0.0), (None, 1, 0.0)]
    rows = nbsvm.training_rows(table, spark.createDataFrame(labels + extra, LABELS), "quality").collect()
    assert sorted(r.doc_id for r in rows) == [i for i in range(10) if i != 3 and not held_out(i)]


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(i, 1, 0.0) for i in range(9)], 1.0)])
def test_one_class_or_none(spark, labels, score):
    docs, _ = made(10)
    rows = nbsvm.report(*frames(spark, docs, labels)).collect()
    assert {round(r.score, 6) for r in rows} == {score}


def test_empty_table(spark):
    docs, labels = frames(spark, *made(5))
    assert nbsvm.report(docs.limit(0), labels).count() == 0


def test_counts_and_ratios(spark):
    packed = lambda *f: nbsvm.pack(np.array(f))
    rows = spark.createDataFrame([(packed(1, 2), 1), (packed(2), 1), (packed(3), 0)], "features binary, y int")
    counts = nbsvm.class_counts(rows.repartition(3))
    assert counts[:, [1, 2, 3, nbsvm.SIZE]].tolist() == [[0, 0, 1, 1], [1, 2, 0, 2]]
    ratios = nbsvm.log_count_ratios(counts)
    assert np.allclose(ratios[[0, 2, 3]], [0, np.log((3 / 4) / (1 / 3)), np.log((1 / 4) / (2 / 3))])


def test_packing():
    for numbers in ([], [0], [5, 6, 300, 70_000, 2**26 - 1]):
        assert nbsvm.unpack(nbsvm.pack(np.array(numbers, dtype="<u4"))).tolist() == numbers
    assert nbsvm.unpack(None).tolist() == []


def test_hinge_fit_is_optimal():
    """At the optimum, multipliers follow the margins: outside the margin 0, inside their cost."""
    rng = np.random.default_rng(3)
    x = [(np.array([0, 1], dtype="<u4"), rng.normal(size=2)) for _ in range(60)]
    y = np.array([1.0 if v[0] + 0.3 * v[1] > 0 else -1.0 for _, v in x])
    cost = np.full(60, 0.5)
    w = nbsvm.fit_hinge(x * 1, y, cost)
    loss = lambda w: 0.5 * (w**2).sum() + (cost * np.maximum(0, 1 - y * [w[a] @ v + w[-1] for a, v in x])).sum()
    for _ in range(200):
        other = w.copy()
        other[[0, 1, -1]] += rng.normal(scale=0.05, size=3)
        assert loss(w) <= loss(other) + 1e-2


def test_keep(spark):
    docs, labels = made(200)
    df, lab = frames(spark, docs, labels)
    kept = {r.doc_id for r in nbsvm.keep(df, lab).collect()}
    assert nbsvm.keep(df, lab).columns == df.columns
    good = {d for d, q, _ in labels if q}
    assert len(kept & good) > 0.97 * len(good) and len(kept - good) < 0.05 * len(good)


def test_only_the_sample_is_sent_and_held(spark, monkeypatch):
    """The driver gets no more rows than the sample, and holds 4 bytes a feature; values are made as rows are read."""
    monkeypatch.setattr(nbsvm, "SAMPLE", 20)
    numbers = [np.unique(np.random.default_rng(i).integers(0, nbsvm.SIZE, 40)) for i in range(300)]
    table = [(i % 200, nbsvm.pack(f), i % 2) for i, f in enumerate(numbers)]
    rows = spark.createDataFrame(table, "doc_id long, features binary, y int").repartition(7)
    first = spark.createDataFrame(table, "doc_id long, features binary, y int").where("y = 1")
    wanted = [r.features for r in first.orderBy(*map(nbsvm.F.expr, ("xxhash64(doc_id)", "doc_id", "features"))).limit(20).collect()]
    taken = nbsvm.sampled(rows, 1)
    assert [bytes(r.features) for r in taken.collect()] == wanted
    plan = taken._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "<=" in plan
    ratios = np.random.default_rng(0).normal(size=nbsvm.SIZE)
    held = nbsvm.Sample(wanted, ratios)
    assert held.numbers.nbytes == sum(map(len, wanted))
    for i, (at, value) in enumerate(held.of(np.arange(5, 20))):
        numbers, values = nbsvm.scaled(nbsvm.unpack(wanted[i + 5]), ratios)
        assert (at == numbers).all() and (value == values).all()
