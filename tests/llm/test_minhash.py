import random
import re

import pytest

from aislewise.llm import minhash
from aislewise.llm.components import components
from aislewise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs):
    """Contract rows by comparing every pair of distinct texts."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        n = min(5, len(words))
        sets.append(frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(docs):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op6_minhash"](spark, SF)) == brute(docs)


def test_chains_of_near_copies(spark):
    """Copies whose edits add up: ends of a chain are unlike each other and still in one group."""
    rng = random.Random(3)
    docs = []
    for g in range(6):
        base = words(rng, 120)
        for i in range(25):
            if i % 3 == 0 and g % 2:
                base = base[:]
                base[rng.randrange(len(base))] = f"x{rng.randrange(10**6)}"
            copy = base[:]
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"y{rng.randrange(10**6)}"
            docs.append((rng.randrange(10**9), " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(minhash.near_duplicates(df)) == brute(docs)


def test_common_passage_does_not_join_documents(spark):
    rng = random.Random(4)
    common = words(rng, 40)
    docs = [(i, " ".join(common + words(rng, rng.randrange(5, 60)))) for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(minhash.near_duplicates(df)) == brute(docs)


def test_cases(spark):
    rng = random.Random(5)
    long = " ".join(words(rng, 60_000))
    docs = [
        (1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a  B"), (6, "a"), (None, "a b"), (None, "lonely"), (7, long),
        (8, long + " more"), (9, "é É"), (10, "é é"), (11, "x y"), (11, "x y"), (12, None), (12, None),
        (13, "one two three four five"), (14, "one two three four six"), (-5, "ONE two three four five"),
    ]
    df = spark.createDataFrame([(*d, 1, "z", 2) for d in docs], "doc_id long, text string, no int, class string, n int")
    assert got(minhash.near_duplicates(df)) == brute(docs)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)] + [(99, 98)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges + [(b, a) for a, b in edges[:3]], "a long, b long")
    least = {}
    for a, b in edges:
        m = min(least.get(a, a), least.get(b, b))
        old = {least.get(a, a), least.get(b, b)}
        least |= {a: m, b: m} | {k: m for k, v in least.items() if v in old}
    rows = components(df).collect()
    assert len(rows) == len(least) and {r.node: r.component for r in rows} == least


def test_signature_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 4000).astype(np.uint64)
    f = minhash.hash_functions(512)
    a, b = minhash.signature(np.unique(x[:3000]), f), minhash.signature(np.unique(x[1000:]), f)
    assert abs((a == b).mean() - 0.5) < 0.08


def test_closing_links_join_what_pivots_left(spark):
    """Members of one bucket in several components: links come back for those that are alike, and for no others."""
    import numpy as np

    sets = {0: range(0, 100), 1: range(5, 105), 2: range(500, 600), 3: range(503, 600), 4: range(900, 1000), 5: range(2, 101)}
    rows = spark.createDataFrame([(7, k, k) for k in sets] + [(8, 0, 0), (8, 4, 4)], "bucket long, no long, c long")
    draw = np.random.default_rng(9).integers(0, 2**63, 1000).astype(np.uint64)
    sets = {k: np.sort(draw[list(v)]) for k, v in sets.items()}
    functions = minhash.hash_functions(128)
    items = [(k, len(v), minhash.signature(v, functions).tobytes(), v.tobytes()) for k, v in sets.items()]
    table = spark.createDataFrame(items, "no long, n long, signature binary, items binary")
    for chunk in (500, 2):
        minhash_chunk, minhash.CHUNK = minhash.CHUNK, chunk
        try:
            links = minhash.closing_links(rows, table)
            found = {r.node: r.component for r in components(links).collect()}
        finally:
            minhash.CHUNK = minhash_chunk
        assert found == {0: 0, 1: 0, 5: 0, 2: 2, 3: 2}


def test_representatives_of_repeated_and_null_ids(spark):
    a, b, c = ([f"{x}{i}" for i in range(200)] for x in "abc")
    near = lambda words: " ".join([*words[:-1], "other"])
    a, b2, b, c2, c = " ".join(a), near(b), " ".join(b), near(c), " ".join(c)
    docs = [(1, a), (1, b), (2, b2), (None, c), (None, c2), (None, None), (None, ""), (None, " "), (None, ""), (3, None), (3, None)]
    got = [tuple(r) for r in minhash.representatives(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert {(1, a), (1, b)} <= set(got) and (2, b2) not in got
    assert sum(t in (c, c2) for _, t in got) == 1
    assert sorted((r for r in got if not r[1] or r[1] == " "), key=str) == [(3, None), (None, " "), (None, ""), (None, None)] and len(got) == 7


def test_representatives(spark):
    docs = [(1, "a b c", "x"), (1, "a b c", "x"), (2, "A b c", "y"), (3, None, "z"), (3, None, "z"), (4, "", None), (None, "n", "n"), (None, "n", "n"), (None, "a b c", "q")]
    out = minhash.representatives(spark.createDataFrame(docs, "doc_id long, text string, class string"))
    assert out.columns == ["doc_id", "text", "class"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "a b c", "x"), (3, None, "z"), (4, "", None), (None, "n", "n")], key=str)
