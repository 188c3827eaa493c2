import math
import random

import pytest
from pyspark.sql import functions as F

from aislewise.operators import changes, selection, sql_functions
from aislewise.sources import key_ranges


@pytest.fixture(scope="module")
def ranged(spark, tmp_path_factory):
    """One prefix holds a third of the rows, and one key very many versions."""
    path = str(tmp_path_factory.mktemp("keys"))
    keys = [f"A#{k:05d}" for k in range(1000)] + [f"B_x#{k:05d}" for k in range(1000)] + ["C#same"] * 500 + [f"D{k % 50}#{k}" for k in range(500)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame(list(zip(keys, range(len(keys)))), "row_key string, v int")
    key_ranges.write_key_ranges(df, path, files=12)
    return path, sorted(keys)


@pytest.mark.parametrize("prefix", ["A#00500", "B_x#", "C#same", "D7#", "nothing", ""])
def test_prefix_rows_equal_a_scan(spark, ranged, prefix):
    path, keys = ranged
    got = [r.row_key for r in key_ranges.prefix_rows(spark, path, prefix).collect()]
    assert got == [k for k in keys if k.startswith(prefix)]
    assert [r.row_key for r in key_ranges.prefix_rows(spark, path, prefix, 5).collect()] == got[:5]


def test_a_prefix_opens_few_files_and_a_hot_one_several(spark, ranged):
    path, _ = ranged
    assert len(key_ranges.files_with(spark, path, "A#00500")) <= 2
    assert key_ranges.files_with(spark, path, "zzz") == []
    assert len(key_ranges.files_with(spark, path, "B_x#")) >= 3 and len(key_ranges.files_with(spark, path, "C#same")) >= 2
    assert len(key_ranges.files_with(spark, path, "")) >= 10


def test_changes_and_replay(spark):
    kinds = "k int, a string, b double"
    v1 = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "z", None), (4, "", 4.0)], kinds)
    v2 = spark.createDataFrame([(1, "x", 1.0), (2, "", 2.0), (4, "", 5.0), (5, None, None)], kinds)
    feed = changes.changes(v1, v2, ["k"], 2)
    got = {r.k: (r.change, r.before and tuple(r.before), r.after and tuple(r.after)) for r in feed.collect()}
    assert got == {
        2: ("update", (None, 2.0), ("", 2.0)), 3: ("delete", ("z", None), None), 4: ("update", ("", 4.0), ("", 5.0)),
        5: ("insert", None, (None, None)),
    }
    assert sorted(map(str, changes.apply(v1, feed, ["k"]).collect())) == sorted(map(str, v2.collect()))
    back = changes.changes(v2, v1, ["k"], 3)
    both = feed.unionByName(back)
    assert sorted(map(str, changes.apply(v1, both, ["k"]).collect())) == sorted(map(str, v1.collect()))
    assert changes.changes(v1, v1, ["k"], 1).count() == 0


@pytest.mark.parametrize("kind", ["spread", "few", "heavy"])
def test_quantiles_are_exact(spark, kind):
    draw = random.Random(8)
    values = {
        "spread": [draw.lognormvariate(0, 5) for _ in range(3000)],
        "few": [float(draw.randrange(3)) for _ in range(3000)],
        "heavy": [7.0] * 2000 + [draw.random() for _ in range(1000)],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "x double").repartition(4)
    at = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    ordered = sorted(values)
    want = [ordered[max(1, math.ceil(q * len(ordered))) - 1] for q in at]
    assert selection.quantiles(df, "x", at, at_once=50) == want
    assert selection.quantiles(df.limit(0), "x", [0.5]) == [None]


def test_table_functions(spark):
    sql_functions.publish_text_functions(spark)
    spark.createDataFrame([(1, "x" * 900), (2, "short"), (3, None)], "id long, text string").createOrReplaceTempView("texts")
    got = spark.sql("SELECT * FROM text_chunks(TABLE(texts))").collect()
    assert sorted((r.id, r.chunk_index, len(r.chunk_content)) for r in got) == [(1, 0, 500), (1, 1, 500), (1, 2, 100)]
    spark.range(30).select(
        (F.col("id") % 3).cast("string").alias("part"), F.col("id").alias("key"), (F.col("id") % 5).cast("double").alias("score")
    ).createOrReplaceTempView("scores")
    best = spark.sql("SELECT * FROM best_rows(TABLE(scores) PARTITION BY (part), 2)").collect()
    assert sorted((r.part, r.key, r.score, r.place) for r in best) == [
        ("0", 9, 4.0, 1), ("0", 24, 4.0, 2), ("1", 4, 4.0, 1), ("1", 19, 4.0, 2), ("2", 14, 4.0, 1), ("2", 29, 4.0, 2),
    ]
