import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aislewise.llm import runs
from aislewise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_force(words):
    """(start, length, period) of every run, period after period."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            smaller = any(all(words[s + k] == words[s + k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


word = st.sampled_from([b"a", b"b", b"c"])
stretch = st.builds(lambda w, k, x: (w * 40)[:k] + x, st.lists(word, min_size=1, max_size=6), st.integers(0, 30), st.lists(word, max_size=3))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(stretch, max_size=4).map(lambda x: sum(x, [])), max_size=3))
def test_runs_equal_brute_force(texts):
    assert [[tuple(r) for r in own.tolist()] for own in runs.runs_in(texts)] == [brute_force(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=40))
def test_extensions_equal_comparing(symbols):
    text = [*symbols, 0]
    tree = runs.Extensions(text, 4, 1)
    n = len(text)
    assert sorted(range(n), key=lambda i: text[i:]) == np.argsort(tree.rank).tolist()
    pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
    common = tree.common(*(np.array(x) for x in zip(*pairs)))
    for (i, j), k in zip(pairs, common.tolist()):
        assert text[i : i + k] == text[j : j + k] and (max(i, j) + k == n or text[i + k] != text[j + k])


def expected(doc_id, text):
    words = runs.repeated_tail(doc_id, (text or "").encode().split())
    found = brute_force(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (
        doc_id,
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def sortable(rows):
    return sorted(map(str, rows))


def test_rewritten_tail():
    doc_id = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 10 == 0)
    words = [b"%d" % k for k in range(50)]
    g = zlib.crc32(str(doc_id).encode()) // 10
    a, got = g % 50, runs.repeated_tail(doc_id, words)
    p = 1 + (50 - a) // (3 + g % 8)
    assert got == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
    assert runs.repeated_tail(doc_id, []) == [] and runs.repeated_tail(None, words) == words


LONG = "w " * 30_000
TEXTS = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "x y " * 4, "a\x0bb " * 9 + "c", "é ü é ü é ü é ü z", "a b c d e " * 200, LONG]


def test_rows(spark):
    data = [(k, t, k) for k, t in enumerate(TEXTS)] + [(None, "b a " * 8, 0), (3, "u v w " * 7, 1), (3, "u v w " * 7, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, runs long")
    want = [long_text() if t == LONG else expected(d, t) for d, t, _ in data]
    assert sortable(tuple(r) for r in runs.report(docs).collect()) == sortable(want)


def long_text():
    """One word, 30,000 times: one run, whatever the rewriting."""
    doc_id = TEXTS.index(LONG)
    line = hashlib.sha256(b"0,30000,1\n").hexdigest()
    return (doc_id, 1, 0, 30_000, 1, 30_000_000, line, hashlib.sha256(b"w").hexdigest())


def test_spans_and_text_are_returned(spark):
    docs = spark.createDataFrame([(1, "so " + "la la la la la la " + "end")], "doc_id long, text string")
    row = runs.find(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 6, 1)] and bytes(row.collapsed) == b"so la end"


def test_empty_table(spark):
    assert runs.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name", ["op13_runs"])
def test_query_equals_brute_force(spark, name):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    # Brute force takes a word pair a step: whole tables, but the longest texts are left to the other tests.
    short = {d for d, t in docs if len((t or "").split()) <= 400}
    got = [tuple(r) for r in QUERIES[name](spark, SF).collect()]
    assert len(got) == len(docs)
    assert sortable(r for r in got if r[0] in short) == sortable(expected(d, t) for d, t in docs if d in short)
