import hashlib
import random
import re

import numpy as np
import pytest

from aislewise.llm import fmindex
from aislewise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            p = words(item)
            n = min(10, len(p))
            windows = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    names.add("" if name is None else str(name))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def got(df):
    columns = "doc_id n_words n_hit n_items items_sha256 contaminated".split()
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def random_case(seed):
    rng = random.Random(seed)
    alphabet = [f"W{i}" for i in range(3 if seed % 2 else 12)] + ["é"]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choices(alphabet, k=n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(6)]
    docs = [(i, text(rng.randrange(60)) + " zz " + rng.choice(items)[1] + " " + text(5)) for i in range(40)]
    return docs, items


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(spark, seed):
    docs, items = random_case(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(fmindex.report(df, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert got(QUERIES["op3_fmindex"](spark, SF)) == want and any(r[5] for r in want)


def test_blocks_and_shards_give_the_same(spark, monkeypatch):
    docs, items = random_case(2)
    monkeypatch.setattr(fmindex, "BLOCK_BYTES", 40)
    monkeypatch.setattr(fmindex, "SHARD_WORDS", 50)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(fmindex.report(df, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_cases(spark):
    phrase = "a b c d e f g h i j"
    docs = [(1, None), (2, ""), (3, "!!"), (4, phrase), (4, phrase), (None, f"x {phrase} k"), (5, "É one"), (6, "é ONE"), (7, "q " * 50_000 + phrase)]
    items = [(1, phrase + " k"), (None, phrase), (2, None), (3, "..."), (4, "É one"), (4, "q q"), (10, phrase), (10, phrase)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, n_words int, hit_items int")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, item int")
    assert got(fmindex.report(df, bench)) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert fmindex.report(docs.limit(0), bench).count() == 0
    assert fmindex.report(docs, bench.limit(0)).first().n_items == 0


def test_cut(spark):
    item = "One, two three. Four five six seven eight nine ten"
    docs = [(1, f"keep é, {item}! rest"), (2, item), (3, "clean text"), (4, None), (5, "")]
    found = fmindex.find(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(1, item)], "item_id long, text string"),
    )
    assert {r.doc_id: r.text for r in fmindex.cut(found).collect()} == {
        1: "keep é, ! rest",
        3: "clean text",
        4: None,
        5: "",
    }


def test_index_parts():
    rng = np.random.default_rng(7)
    text = rng.integers(0, 4, 400)
    text[-1] = 0
    vector = fmindex.BitVector(text > 1)
    at = np.arange(401)
    assert (vector.rank(at) == np.concatenate([[0], np.cumsum(text > 1)])).all()
    matrix = fmindex.WaveletMatrix(text, 2)
    for c in range(4):
        assert (matrix.rank(np.full(401, c), at) == np.concatenate([[0], np.cumsum(text == c)])).all()
    assert (matrix.access(np.arange(400))[0] == text).all()
    index = fmindex.FMIndex(text, 3)
    low, high = index.search(np.array([[1, 2, 3]]), np.array([3]))
    want = [i for i in range(398) if text[i : i + 3].tolist() == [1, 2, 3]]
    assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_many_blocks_are_one_stage(spark, monkeypatch):
    """Fifty blocks, items repeated a thousand times among them, and one Python stage."""
    monkeypatch.setattr(fmindex, "BLOCK_BYTES", 60)
    items = [(f"i{k}", f"w{k} x{k} y{k}") for k in range(120)] + [("same", "again and again")] * 1000
    docs = [(k, f"a w{k} x{k} y{k} b again and again c") for k in range(130)]
    bench = spark.createDataFrame(items, "item_id string, text string").repartition(3)
    found = fmindex.find(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    got = {r.doc_id: (r[fmindex.ITEMS], [tuple(x) for x in r[fmindex.SPANS]]) for r in found.collect()}
    for k in range(130):
        spans = [(1, 4), (5, 8)] if k < 120 else [(5, 8)]
        assert got[k] == (sorted(["same"] + [f"i{k}"] * (k < 120)), spans), k
