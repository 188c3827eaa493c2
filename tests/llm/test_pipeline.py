import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_fmindex, test_minhash, test_secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after every stage, written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, folder = [docs.collect()], tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs.collect())
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "decontamination", "secrets", "bpe"]
    assert all(set(rows[0].asDict()) == set(stages[0][0].asDict()) for rows in stages[:-1])


def test_quality_keeps_rows_as_they_are(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after.items() <= before.items() and len(after) > 0.6 * len(before)


def test_one_document_of_each_group_stays(stages):
    docs = [(r.doc_id, r.text) for r in stages[1]]
    assert texts(stages[2]) == {d: texts(stages[1])[d] for d, _, _, kept in test_minhash.brute(docs) if kept}


def test_no_benchmark_phrase_is_left(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = texts(stages[2]), texts(stages[3])
    dirty = {r[0] for r in test_fmindex.brute(before.items(), items) if r[5]}
    assert dirty and not any(r[5] for r in test_fmindex.brute(after.items(), items))
    assert {d: t for d, t in before.items() if d not in dirty} == {d: t for d, t in after.items() if d not in dirty}
    assert all(r.n_chars == len(r.text or "") for r in stages[3] if r.doc_id in dirty)


def test_no_secret_is_left(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    assert not any(r[1] + r[2] + r[3] for r in test_secrets.brute(after.items()))
    dirty = {r[0] for r in test_secrets.brute(before.items()) if r[1] + r[2] + r[3]}
    assert all("[secret]" in after[d] for d in dirty)
    assert all(after[d] == before[d] for d in before if "[secret]" not in after[d])


def test_ids_are_those_of_the_library(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert texts(stages[4]) == texts(stages[5])
    for r in stages[5]:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)


def test_run(spark, stages):
    got = {r.doc_id: (r.text, bytes(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {r.doc_id: (r.text, bytes(r.ids)) for r in stages[-1]}


def test_entry_lists_the_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_tables_and_odd_rows(spark, k):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, docs.limit(0), SF).count() == 0
    assert stage(spark, docs, SF).count() == {0: 4, 1: 3, 2: 4, 3: 4, 4: 4}[k]


@pytest.mark.parametrize("k", range(5))
def test_stages_keep_columns_of_any_name(spark, k):
    """Columns that are called like those the operators work with keep their values and types."""
    own = ["N_Words", "hit_spans", "hit_items", "__row", "__digest", "text_key", "spans", "__hit_spans", "ids", "N_tokens"]
    docs = spark.createDataFrame(
        [(i, f"word{i} token=abcdefgh{i}", "en", "s", 3, *(f"{c} {i}" for c in own)) for i in range(3)],
        "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in own),
    )
    out = corpus_pipeline.STAGES[k][1](spark, docs, SF)
    assert out.schema.names == docs.schema.names + (["_ids", "_n_tokens"] if k == 4 else [])
    rows = out.collect()
    assert all(r[c] == f"{c} {r.doc_id}" for r in rows for c in own) and (k == 0 or len(rows) == 3)


def test_examples_are_told_by_the_documents_that_came_in(spark, tmp_path):
    """A value in fifty near-equal documents of ten owners is an example, though one of them is left."""
    example, own = "q9Zr4Kx8Wm2Vt6Yb1Nc5", "h7Jd3Ls9Pf1Gk5Tr8Xw2"
    data = [(k, f"set {example} here {k}", "en", f"owner{k % 10}", 3) for k in range(50)] + [(99, f"set {own} here", "en", "me", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/documents.parquet")
    left = spark.createDataFrame([data[0], data[-1]], schema)
    after = {r.doc_id: r.text for r in corpus_pipeline.redact(spark, left, str(tmp_path)).collect()}
    assert after == {0: data[0][1], 99: "set [secret] here"}
