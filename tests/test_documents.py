import pytest
from pyspark.sql import functions as F

from aislewise.functions import numbers
from aislewise.operators import documents as D
from aislewise.operators import search as S

CERTIFICATE = """# Warranty certificate
Product ID: prod_155
Product Name: Buds 3
Brand: Acme
Category: Audio
Retail Price USD: $299.99
Warranty Duration: 24 months
Warranty Start: date of purchase
## Section 1: Coverage
Parts and labour.
Second line.
## Section 2: Exclusions
Water damage.
## Section 3: Guarantee
Sealed.
## Support
Call us.
Support URL: https://help.example
Support Email: care@mail.example
"""


def test_chunks_equal_cutting_by_position(spark):
    texts = ["", "x" * 30, "y" * 31, "é" * 400, "z" * 401 + "😀" * 500, "a" * 850 + " " * 400 + "b" * 40, "line\n" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    by_position = (
        df.select("id", F.posexplode(F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(400))), "text")
        .select("id", F.col("pos").cast("long").alias("chunk_index"), F.substring(F.col("text"), F.col("col"), F.lit(500)).alias("chunk_content"))
        .filter(F.length(F.trim("chunk_content")) > 30)
    )
    a, b = D.chunks(df, "text", ["id"]).collect(), by_position.collect()
    assert {tuple(r) for r in a if r.id != 6} == {tuple(r) for r in b if r.id != 6}
    assert {r.id for r in a} == {2, 3, 4, 5, 6}
    assert sorted(r.chunk_index for r in a if r.id == 5) == [0, 1, 2, 3]


def test_chunk_gap(spark):
    text = "a" * 400 + " " * 900 + "b" * 100
    df = spark.createDataFrame([(1, text)], "id int, text string")
    assert sorted(r.chunk_index for r in D.chunks(df, "text", ["id"]).collect()) == [0, 3]


def test_extraction_and_assembly(spark):
    df = spark.createDataFrame([("u1", CERTIFICATE), ("u2", "nothing here")], "source_pdf_uri string, text string")
    out = D.extract_fields(df, "text", D.CERTIFICATE_FIELDS, ["source_pdf_uri"])
    got = {r.source_pdf_uri: r for r in out.collect()}
    r = got["u1"]
    assert (r.product_id, r.retail_price_usd, r.warranty_duration_months) == ("prod_155", 299.99, 24)
    assert r.coverage_scope_details == "Parts and labour.\nSecond line."
    assert r.exclusions_and_limitations == "Water damage."
    assert got["u2"].product_id is None and got["u2"].retail_price_usd is None
    text = out.filter("product_id IS NOT NULL").select(D.certificate_text().alias("t")).first().t
    assert "PRODUCT ID: prod_155\nPRODUCT NAME: Buds 3\n" in text and "WARRANTY DURATION: 24 Months\n" in text
    assert "### SECTION 2: EXCLUSIONS & OPERATING LIMITATIONS\nWater damage." in text
    empty = out.filter("product_id IS NULL").select(D.certificate_text().alias("t")).first().t
    assert "PRODUCT ID: \n" in empty
    required = ["product_name", "retail_price_usd"]
    summary = D.extraction_summary(out.withColumn("content", D.certificate_text()), "content", required)
    assert summary.first().n_missing_product_name == 1
    assert D.extraction_gate(summary, required).first().passed is False


def test_extractor_plug_point(spark):
    df = spark.createDataFrame([("u1",)], "uri string")
    fields = (D.Field("a", "bigint", ""), D.Field("b", "string", ""))
    model = lambda d: d.withColumn("extracted", F.lit('{"a": 7, "b": "x"}'))
    assert tuple(D.extract_with(df, model, fields, ["uri"]).first()) == ("u1", 7, "x")


def test_manual_fields(spark):
    text = "Document Title: T3000 Guide\nPart Number: 44-1\n## Diagnostics and error codes\nERR-PAY-4001: restart\n"
    df = spark.createDataFrame([(text,)], "text string")
    r = D.extract_fields(df, "text", D.MANUAL_FIELDS).first()
    assert (r.document_title, r.document_part_no, r.diagnostics_and_error_codes) == ("T3000 Guide", "44-1", "ERR-PAY-4001: restart")


def test_classify_and_policy(spark):
    df = spark.createDataFrame(
        [(1, "A laptop with a keyboard"), (2, "phone and laptop"), (3, "nothing"), (4, "phone phone laptop laptop laptop")],
        "id int, text string",
    )
    got = {r.id: r.category for r in D.classify(df, "text", D.PRODUCT_CATEGORIES).collect()}
    assert got == {1: "Laptops & Computing", 2: "Smartphones & Tablets", 3: "UNCLASSIFIED", 4: "Laptops & Computing"}
    flags = df.select(D.policy_test(F.col("text"), ["laptop"], ["phone"]).alias("p")).collect()
    assert [r.p for r in flags] == [True, False, False, False]


def test_file_corpus(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    got = D.file_corpus(spark, str(tmp_path)).collect()
    assert [(r.document_filename, r.n_bytes) for r in got] == [("a", 5)]
    assert bytes(D.file_corpus(spark, str(tmp_path), content=True).first().content) == b"12345"


def test_concepts_need_certification(spark):
    concepts = spark.createDataFrame(
        [("k1", "ERR-PAY-4001, ERR-SYNC-900", True), ("k2", "ERR-PAY-4001", False)],
        "concept_id string, related_error_codes string, certified boolean",
    )
    codes = spark.createDataFrame([("err-pay-4001",), ("ERR-PAY-4001",)], "code string")
    assert [(r.concept_id, r.related_code) for r in D.concept_lookup(concepts, codes).collect()] == [("k1", "ERR-PAY-4001")]


VECTORS = [(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, [2.0, 0.0]), (6, None)]


def test_vector_search_is_exact_in_one_block_or_many(spark):
    corpus = spark.createDataFrame(VECTORS, "id int, embedding array<double>").repartition(3)
    asked = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0]), ("z", [0.0, 0.0])], "query_id string, embedding array<double>")
    one = {(r.query_id, r["rank"]): (r.id, r.distance) for r in S.vector_search(corpus, asked, ["id"], 2).collect()}
    many = {(r.query_id, r["rank"]): (r.id, r.distance) for r in S.vector_search(corpus, asked, ["id"], 2, broadcast_bytes=16).collect()}
    assert one == many == {("a", 1): (1, 0.0), ("a", 2): (5, 0.0), ("b", 1): (3, 0.0), ("b", 2): (2, 0.4)}


def test_vector_search_matches_column_arithmetic(spark):
    import random

    rnd = random.Random(3)
    corpus = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(200)], "id int, embedding array<double>").repartition(4)
    asked = spark.createDataFrame([(q, [rnd.gauss(0, 1) for _ in range(8)]) for q in range(5)], "query_id int, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.id for r in S.vector_search(corpus, asked, ["id"], 3).collect()}
    pairs = corpus.join(asked.withColumnRenamed("embedding", "v"))
    scored = pairs.select("query_id", "id", numbers.cosine_similarity(F.col("embedding"), F.col("v")).alias("s")).collect()
    for q in range(5):
        best = sorted((r for r in scored if r.query_id == q), key=lambda r: -r.s)[:3]
        assert [got[(q, n + 1)] for n in range(3)] == [r.id for r in best]


def test_embedding_is_unit_length_and_stable(spark):
    df = spark.createDataFrame([("alpha beta beta",), ("",), (None,)], "t string")
    v = [r.embedding for r in S.embed(df, F.col("t")).collect()]
    assert sum(x * x for x in v[0]) == pytest.approx(1.0) and len(v[0]) == S.DIMENSIONS
    assert max(v[1]) == 0.0 and v[2] is None


def test_new_embeddings_only_for_new_rows(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, t string")
    done = spark.createDataFrame([(1,)], "id int")
    got = {r.id: r.embedding for r in S.new_embeddings(src, done, "id", F.col("t")).collect()}
    assert set(got) == {2, 3} and got[2].status == "" and got[3].result is None and got[3].status


def chunk_rows(spark):
    return spark.createDataFrame(
        [
            ("d1", 0, "intro words only"),
            ("d1", 1, "Clear ERR-PAY-4001 by restart"),
            ("d1", 2, "then wait"),
            ("d1", 4, "after a gap"),
            ("d2", 0, "also err-pay-4001 here"),
            ("d2", 1, "the red lever opens, slowly"),
        ],
        "doc string, chunk_index long, chunk_content string",
    )


def test_text_matches_take_the_first_place(spark):
    q = spark.createDataFrame(
        [(1, "what is ERR-PAY-4001?"), (2, "Red LEVER opens"), (3, "lever red"), (4, "X-99"), (5, "?!")], "query_id int, query string"
    )
    got = {r.query_id: (r.doc, r.chunk_index) for r in S.text_matches(q, chunk_rows(spark), "doc").collect()}
    assert got == {1: ("d1", 1), 2: ("d2", 1)}


def test_stitch_keeps_order_and_gaps(spark):
    m = spark.createDataFrame([("q", "d1", 1), ("r", "d1", 4)], "query_id string, doc string, chunk_index long")
    got = {r.query_id: r.stitched_content for r in S.stitch(m, chunk_rows(spark), "doc", ["query_id"]).collect()}
    assert got == {"q": "intro words only\nClear ERR-PAY-4001 by restart\nthen wait", "r": "after a gap"}


def test_stitch_can_trim_the_overlap(spark):
    text = "".join(chr(97 + i % 26) for i in range(1300))
    table = D.chunks(spark.createDataFrame([("d", text)], "doc string, text string"), "text", ["doc"])
    m = spark.createDataFrame([("q", "d", 1)], "query_id string, doc string, chunk_index long")
    whole = S.stitch(m, table, "doc", ["query_id"], separator="", trim_overlap=100).first().stitched_content
    assert whole == text
    assert len(S.stitch(m, table, "doc", ["query_id"]).first().stitched_content) == 500 + 500 + 500 + 2


def test_gate_is_inclusive(spark):
    scores = spark.createDataFrame([(0.69994,), (0.69996,), (0.70,)], "s double").select(F.round("s", 4).alias("s"))
    assert [r.ok for r in scores.select((F.col("s") >= S.SIMILARITY_THRESHOLD).alias("ok")).collect()] == [False, True, True]


def test_retrieve_statuses(spark):
    table = S.embed(chunk_rows(spark), F.col("chunk_content"))
    q = spark.createDataFrame(
        [(1, "Clear ERR-PAY-4001 by restart"), (2, "please explain the code ERR-PAY-4001 to the new colleague today"), (3, "unrelated gardening topic")],
        "query_id int, query string",
    )
    got = {r.query_id: r for r in S.retrieve(q, table, "doc").collect()}
    assert (got[1].status, got[1].similarity_score) == (S.VECTOR_MATCH, 1.0)
    assert (got[2].status, got[2].similarity_score, got[2].doc) == (S.TEXT_MATCH, 0.85, "d1")
    assert (got[3].status, got[3].stitched_content) == (S.NO_MATCH, None)


def test_values_are_cleaned_by_field_only(spark):
    text = """Product Name: Game Pass 3 Months
Brand: $Money
Retail Price USD: $1,299.00
Warranty Duration: 24 Months
# Section 10 extra
ten
# Section 1: Coverage
one"""
    odd = "Retail Price USD: about 5\nWarranty Duration: 1,5 months"
    df = spark.createDataFrame([(1, text), (2, odd), (3, None)], "id int, text string")
    a, b, c = D.extract_fields(df, "text", D.CERTIFICATE_FIELDS, ["id"], rejects="rejected").orderBy("id").collect()
    assert (a.product_name, a.brand, a.retail_price_usd, a.warranty_duration_months) == ("Game Pass 3 Months", "$Money", 1299.0, 24)
    assert a.coverage_scope_details == "one" and a.rejected == [] and c.rejected == []
    assert b.retail_price_usd is None and sorted(b.rejected) == ["retail_price_usd=about 5", "warranty_duration_months=1,5"]


def test_vectors_of_another_width_are_not_dropped(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0])], "id int, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    with pytest.raises(Exception, match="1 of . corpus vectors are not 2 wide"):
        S.vector_search(corpus, asked, ["id"])
    with pytest.raises(ValueError, match="between 2 and 3 wide"):
        S.vector_search(corpus, asked.unionByName(spark.createDataFrame([(2, [1.0] * 3)], asked.schema)), ["id"])


def test_a_task_gives_out_its_best_rows_once(spark, monkeypatch):
    """However small the slices, at most top_k rows leave a task for each query, and they are the right ones."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    vectors, asked = rng.integers(-2, 3, (400, 4)).astype(float), rng.normal(size=(50, 4))
    monkeypatch.setattr(S, "PRODUCT_CELLS", 350)
    batches = [
        pa.RecordBatch.from_pydict({"id": list(range(i, i + 100)), "embedding": vectors[i : i + 100].tolist()})
        for i in range(0, 400, 100)
    ]
    out = list(S._scorer(pa.array(range(50)), S._unit_rows(asked), ["id"], "embedding", 3)(iter(batches)))
    rows = [r for b in out for r in zip(*(b.column(c).to_pylist() for c in ("query_id", "distance", "id")))]
    distance = np.round(1 - S._unit_rows(asked) @ S._unit_rows(vectors).T, S.RANK_DIGITS)
    want = [(q, d, i) for q in range(50) for d, i in sorted((d, i) for i, d in enumerate(distance[q]) if np.isfinite(d))[:3]]
    assert len(rows) == 150 and sorted(rows) == want


def test_a_search_task_holds_few_cells_at_once():
    """Memory of a task that ranks one full batch: bounded by the cells of a product, whatever the batch."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    draw = np.random.default_rng(2)
    rows, width = 6_000, 16
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(draw.random(rows * width)))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), vectors], ["k", "v"])
    matrix = S._unit_rows(draw.random((1_000, width)))
    run = S._scorer(pa.array(np.arange(1_000)), matrix, ["k"], "v", 3)
    tracemalloc.start()
    found = pa.Table.from_batches(list(run(iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 3_000 and peak < 60 << 20
    exact = np.round(1.0 - matrix @ S._unit_rows(np.array(vectors.to_pylist())).T, S.RANK_DIGITS)
    best = {q: sorted(zip(d.tolist(), range(rows)))[:3] for q, d in enumerate(exact)}
    got = {}
    for r in found.to_pylist():
        got.setdefault(r["query_id"], []).append((r["distance"], r["k"]))
    assert {q: [k for _, k in sorted(x)] for q, x in got.items()} == {q: [k for _, k in x] for q, x in best.items()}
