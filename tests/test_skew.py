"""One key holds a third of the rows: results stay whole and exact."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from aislewise.operators import dedup, ledger, quality, search


@pytest.fixture(scope="module")
def hot(spark):
    rnd = random.Random(11)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 400)}", rnd.randint(0, 50), rnd.randint(0, 9)) for i in range(6000)]
    return rows, spark.createDataFrame(rows, "k string, at int, v int").repartition(6)


def test_latest_per_key(hot):
    rows, df = hot
    want = {}
    for k, at, v in rows:
        want[k] = max(want.get(k, (-1, -1)), (at, v))
    got = {r.k: (r["at"], r.v) for r in dedup.latest_per_key(df, ["k"], ["at"]).collect()}
    assert got == want


def test_top_per_key_cuts_before_the_shuffle(hot):
    rows, df = hot
    top = dedup.top_per_key(df, ["k"], [F.desc("at"), F.desc("v")], 3)
    by_key = collections.defaultdict(list)
    for k, at, v in rows:
        by_key[k].append((at, v))
    got = collections.defaultdict(list)
    for r in top.collect():
        got[r.k].append((r["at"], r.v))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(sorted(v)[-3:]) for k, v in by_key.items()}
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_profile_uniqueness_and_references(spark, hot):
    rows, df = hot
    counts = collections.Counter(k for k, _, _ in rows)
    p = {r.column_name: r for r in quality.profile(df, ["k"]).collect()}["k"]
    assert (p.n_rows, p.n_distinct, p.top_count) == (6000, len(counts), counts["hot"])
    assert quality.unique_ratio(df, ["k"]).first().value == pytest.approx(len(counts) / 6000)
    other = spark.createDataFrame([("hot",), ("k1",)], "u string")
    want = (counts["hot"] + counts["k1"]) / 6000
    assert quality.referenced_ratio(df, "k", other, "u").first().value == pytest.approx(want)


def test_units_of_a_hot_store(spark):
    rows = [("2026-01-01", "S1" if i % 3 == 0 else f"S{i % 50}", "A", 1 if i % 7 else -1) for i in range(5000)]
    lines = spark.createDataFrame(rows, "business_date string, store_id string, item_id string, quantity int")
    want = collections.Counter()
    for _, s, _, q in rows:
        want[s] += q
    got = {r.store_id: r.daily_units for r in ledger.sku_day_units(lines).collect()}
    assert got == {s: float(max(q, 0)) for s, q in want.items()}


def test_a_code_found_everywhere_is_one_row(spark):
    chunks = spark.range(3000).select(
        (F.lit(3000) - F.col("id")).alias("doc"), F.lit(0).cast("long").alias("chunk_index"),
        F.when(F.col("id") % 3 == 0, "see ERR-PAY-1").otherwise("nothing").alias("chunk_content"),
    )
    q = spark.createDataFrame([(1, "ERR-PAY-1"), (2, "err-pay-1 please")], "query_id int, query string")
    got = {(r.query_id, r.doc) for r in search.text_matches(q, chunks, "doc").collect()}
    assert got == {(1, 3), (2, 3)}


def test_equal_vectors_tie_by_key(spark):
    corpus = spark.range(2000).select("id", F.array(F.lit(0.6), F.lit(0.8)).alias("embedding")).repartition(5)
    q = spark.createDataFrame([(1, [0.6, 0.8])], "query_id int, embedding array<double>")
    got = search.vector_search(corpus, q, ["id"], 3).orderBy("rank").collect()
    assert [(r.id, r.distance) for r in got] == [(0, 0.0), (1, 0.0), (2, 0.0)]
