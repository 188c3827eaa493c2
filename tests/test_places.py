"""Places of whole ordered lists."""

from pyspark.sql import functions as F

from aislewise.operators.places import places
from workload import load_all
from workload.registry import QUERIES

load_all()


def test_places_over_many_ranges(spark):
    rows = spark.range(0, 5_000, 1, 7).select(F.pmod(F.col("id") * 37, F.lit(5_000)).alias("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = places(rows.orderBy(F.desc("id")), "id")
        assert {(r.id, r.place) for r in got.collect()} == {(4_999 - k, k + 1) for k in range(5_000)}
        assert "Window" not in got._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert places(rows.limit(0).orderBy("id"), "id").count() == 0


def test_every_row_of_the_recall_list_has_a_place(spark):
    sf = "/root/testdata/sf0.01"
    n = QUERIES["recall_vip"](spark, sf).count()
    assert n > 100 and sorted(r.place for r in QUERIES["vip_places"](spark, sf).collect()) == list(range(1, n + 1))


def test_whole_ledger_is_ranked_newest_day_first(spark):
    got = QUERIES["ledger_places"](spark, "/root/testdata/sf0.001")
    days = [r.business_date for r in got.orderBy("place").collect()]
    assert len(set(days)) > 1 and days == sorted(days, reverse=True)
    assert "Window" not in QUERIES["ordered_ledger"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
