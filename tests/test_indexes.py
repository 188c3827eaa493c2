import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislewise.operators import postings, search, sketches, vector_index


@pytest.fixture(scope="module")
def clustered(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + 0.25 * draw.normal(size=16)]) for i in range(600)]
    rows += [(600, None), (601, [0.0] * 16)]
    return spark.createDataFrame(rows, "id long, embedding array<double>").repartition(4).cache()


@pytest.fixture(scope="module")
def index(clustered, tmp_path_factory):
    return vector_index.build(clustered, str(tmp_path_factory.mktemp("ivf")), ["id"], cells=12)


def asked(clustered):
    return clustered.where("id % 20 = 0").withColumnRenamed("id", "query_id")


def test_probing_all_cells_is_exact(clustered, index):
    exact = search.vector_search(clustered.where("id < 600"), asked(clustered), ["id"], 5)
    found = vector_index.search(index, asked(clustered), 5, probes=12)
    key = ["query_id", "id", "rank", "distance", "similarity_score"]
    assert sorted(map(tuple, found.select(key).collect())) == sorted(map(tuple, exact.select(key).collect()))


def test_few_probes_find_nearly_all(spark, clustered, index):
    exact = search.vector_search(clustered.where("id < 600"), asked(clustered), ["id"], 5)
    found = vector_index.search(index, asked(clustered), 5, probes=2, broadcast_bytes=2000)
    n, hits = vector_index.recall(found, exact, ["id"]).agg(F.sum("wanted"), F.sum("hits")).first()
    assert hits >= 0.95 * n


def test_only_probed_cells_are_opened(spark, index):
    opened = index.rows(spark).where(F.col("cell").isin([1, 2])).select("id")
    plan = opened._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [cell" in plan.toString()
    opened.collect()
    scan = opened._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    folders = sum(1 for r in index.rows(spark).select("cell").distinct().collect())
    assert scan.metrics().apply("numPartitions").value() == 2 < folders


def test_every_vector_is_in_one_cell(spark, clustered, index):
    assert index.rows(spark).count() == 600 and index.rows(spark).select("id").distinct().count() == 600
    assert vector_index.search(index, asked(clustered).limit(0), 5).count() == 0


TEXTS = ["the red fox ran", "a red red fox ERR-PAY-1 ran the red fox", "fox red the", "", None, "Red-Hot err-pay-1 words"]


@pytest.fixture(scope="module")
def posted(spark, tmp_path_factory):
    chunks = spark.createDataFrame([(k // 2, k % 2, t) for k, t in enumerate(TEXTS)], "doc long, chunk_index int, chunk_content string")
    return postings.build(chunks, "doc", str(tmp_path_factory.mktemp("postings")))


@pytest.mark.parametrize(
    "words,want",
    [(["red", "fox"], {(0, 0), (0, 1)}), (["red", "red", "fox"], {(0, 1)}), (["the"], {(0, 0), (0, 1), (1, 0)}), (["fox", "blue"], set()), ([], set())],
)
def test_phrases(spark, posted, words, want):
    q = spark.createDataFrame([("q", words)], "query_id string, words array<string>")
    assert {(r.doc, r.chunk_index) for r in postings.match_phrases(q, posted).collect()} == want


def test_random_phrases_equal_a_scan(spark, tmp_path):
    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.randint(0, 12))) for _ in range(60)]
    chunks = spark.createDataFrame([(k, 0, t) for k, t in enumerate(texts)], "doc long, chunk_index int, chunk_content string")
    index = postings.build(chunks, "doc", str(tmp_path / "p"))
    queries = [[draw.choice("abcde") for _ in range(draw.randint(1, 4))] for _ in range(40)]
    q = spark.createDataFrame(list(enumerate(queries)), "query_id int, words array<string>")
    got = {(r.query_id, r.doc) for r in postings.match_phrases(q, index).collect()}
    assert got == {(i, k) for i, w in enumerate(queries) for k, t in enumerate(texts) if f" {' '.join(w)} " in f" {t} "}


def test_lookup_reads_no_text(spark, posted):
    q = spark.createDataFrame([("q", "red fox"), ("c", "what is ERR-PAY-1?")], "query_id string, query string")
    found = postings.match_text(q, posted)
    assert {(r.query_id, r.doc, r.chunk_index) for r in found.collect()} == {("q", 0, 0), ("c", 0, 1)}
    assert "chunk_content" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_of_days_merge(spark, tmp_path):
    df = spark.range(20_000).select(
        (F.col("id") % 7).alias("day"), (F.col("id") * 37 % 5000).alias("n"), F.concat(F.lit("v"), F.col("id") % 300).alias("s"),
        F.when(F.col("id") % 10 != 0, F.col("id") / 3.0).alias("x"),
    )
    path, names = str(tmp_path / "sk"), ["n", "s", "x"]
    for part in (df.where("day < 6"), df.where("day = 6"), df.where("day = 6")):  # a day that is written again
        sketches.store_days(sketches.day_sketches(part, F.col("day"), names), path)
    profiled = sketches.profile(sketches.stored(spark, path))
    got = {r.column_name: r for r in profiled.collect()}
    assert (got["x"].n_rows, got["x"].n_nulls, got["x"].null_ratio, got["n"].low, got["n"].high) == (20_000, 2_000, 0.1, 0.0, 4999.0)
    assert got["s"].quantiles is None and abs(got["s"].approx_distinct - 300) <= 15
    checks = sketches.within_error(df, profiled).collect()
    assert len(checks) == 3 and all(r.distinct_ok and r.quantiles_ok for r in checks)
    once = sketches.profile(sketches.day_sketches(df, F.lit(0), names)).collect()
    assert {r.column_name: r.n_rows for r in once} == {c: 20_000 for c in names}
    some = sketches.stored(spark, path, F.lit(5))
    assert sketches.profile(some).first().n_rows == df.where("day >= 5").count()


def test_texts_are_dealt_to_a_given_number_of_tasks(spark, tmp_path):
    """Adaptive execution would join partitions by the texts' size, and words of chunks are many times larger."""
    from workload import views

    spark.createDataFrame([(n, "some words") for n in range(20)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    texts = views.texts(spark, str(tmp_path), "documents", "doc_id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert texts.rdd.getNumPartitions() == parts and texts.count() == 20


def test_phrases_join_postings_of_their_words_only(spark):
    chunks = spark.createDataFrame([(1, 0, "red apple pie and tea"), (2, 0, "green apple pie")], "doc_id long, chunk_index long, chunk_content string")
    index = postings.build(chunks, "doc_id")
    asked = spark.createDataFrame([(7, ["apple", "pie"]), (8, ["pie", "and", "tea"])], "query_id long, words array<string>")
    found = postings.match_phrases(asked, index)
    assert sorted(map(tuple, found.collect())) == [(7, 1, 0), (7, 2, 0), (8, 1, 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2, "both lookups in the postings read the asked words only"


def test_postings_of_one_place_are_one_row(spark, tmp_path):
    rows = [(1, 0, "b a b ERR-NET-1"), (1, 0, "a c err-net-1"), (1, 1, "a"), (None, 0, "a"), (2, 0, None), (3, 0, "")]
    chunks = spark.createDataFrame(rows, "doc long, chunk_index int, chunk_content string")
    index = postings.build(chunks, "doc", str(tmp_path / "p"))
    got = {(r.kind, r.token, r.doc, r.chunk_index): sorted(r.positions) for r in index.entries(spark).collect()}
    assert got == {
        ("word", "a", 1, 0): [0, 1], ("word", "b", 1, 0): [0, 2], ("word", "c", 1, 0): [1], ("word", "a", 1, 1): [0],
        ("word", "a", None, 0): [0], ("word", "err", 1, 0): [2, 3], ("word", "net", 1, 0): [3, 4], ("word", "1", 1, 0): [4, 5],
        ("code", "err-net-1", 1, 0): [],
    }
    held = {(r.kind, r.token): (r.chunks, r.first.doc, r.first.at) for r in index.dictionary(spark).collect()}
    assert held[("word", "a")] == (3, None, 0) and held[("code", "err-net-1")] == (1, 1, 0)
    folders = {(r.kind, r.folder, r.token) for r in index.entries(spark).select("kind", "folder", postings.folder_of(F.col("token")).alias("f"), "token").where("f = folder").collect()}
    assert len(folders) == len({k[:2] for k in got})


def joins(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_few_questions_do_not_shuffle_the_postings(spark, posted):
    """Their size is known when the lookup is planned, whatever they were computed from."""
    q = spark.createDataFrame([("c", "what is ERR-PAY-1?"), ("q", "red fox")], "query_id string, query string")
    found = postings.match_text(q.join(q.select("query_id").distinct(), "query_id"), posted)
    assert "SortMergeJoin" not in joins(found) and "BroadcastHashJoin" in joins(found)
    assert {(r.query_id, r.doc, r.chunk_index) for r in found.collect()} == {("q", 0, 0), ("c", 0, 1)}


def test_few_matches_do_not_shuffle_the_texts(spark, monkeypatch):
    chunks = spark.createDataFrame([(k // 2, k % 2, t) for k, t in enumerate(TEXTS)], "doc long, chunk_index long, chunk_content string")
    matches = spark.createDataFrame([("c", 0, 1), ("d", 1, 0), ("d", 0, 0)], "query_id string, doc long, chunk_index long")
    few = search.stitch(matches, chunks, "doc", ["query_id", "doc", "chunk_index"])
    assert "SortMergeJoin" not in joins(few) and "LeftSemi" in joins(few)
    assert "LeftSemi" in joins(search.of_matches(chunks, matches, "doc")) and search.of_matches(chunks, matches, "doc").count() == 4
    monkeypatch.setattr(search, "FEW_MATCHES", 2)
    many = search.stitch(matches, chunks, "doc", ["query_id", "doc", "chunk_index"])
    assert "LeftSemi" not in joins(many) and sorted(many.collect()) == sorted(few.collect()) and few.count() == 3
