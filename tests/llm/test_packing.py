import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aislewise.llm import bpe, packing
from aislewise.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def best_fit(lengths, capacity):
    """Room left in each sequence, one piece after another."""
    left = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(left) if room >= length]
        if fits:
            left[min(fits, key=left.__getitem__)] -= length
        else:
            left.append(capacity - length)
    return sorted(left)


def room_of(placed, capacity):
    """Checks that (sequence, offset, length) tile their sequences, and returns the room left in each."""
    by_sequence = defaultdict(list)
    for sequence, offset, length in placed:
        by_sequence[sequence].append((offset, length))
    left = []
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        left.append(capacity - at)
    return sorted(left)


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 40), st.lists(st.integers(1, 40), max_size=60))
def test_plan_is_best_fit_decreasing(capacity, lengths):
    lengths = [min(x, capacity) for x in lengths]
    placed, met = [], Counter()
    ranges = packing.plan(dict(Counter(lengths)), capacity)
    for length in lengths:
        own = [r for r in ranges if r.length == length and r.rank <= met[length]][-1]
        inside = met[length] - own.rank
        placed.append((own.sequence + inside // own.each, own.offset + inside % own.each * length, length))
        met[length] += 1
    assert room_of(placed, capacity) == best_fit(lengths, capacity)
    assert {s for s, _, _ in placed} == set(range(len({s for s, _, _ in placed})))


def test_plan_does_not_grow_with_the_corpus():
    few = packing.plan({x: 1 + x % 7 for x in range(1, 2049)})
    many = packing.plan({x: 10**9 + x % 7 for x in range(1, 2049)})
    assert len(few) < 10_000 and len(many) < 10_000


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t àéaB1²'sl!.<|>漢😀\r\x85\x1c\x1f ́Ⅷ"), max_size=25))
def test_any_text_equals_the_library(text):
    own = test_any_text_equals_the_library
    if not hasattr(own, "encode"):
        own.encode, own.library = packing.encoder(bpe.load_vocabulary(PATH)), Tokenizer.from_file(PATH)
    ids = np.frombuffer(own.encode([text.encode()])[0], "<u4").tolist()
    assert ids == own.library.encode(text, add_special_tokens=False).ids


def test_vocabulary_that_merges_otherwise_is_encoded_by_its_pairs():
    # 'abc' is joined from 'ab' and 'c', but 'bc' comes first: its own bytes become 'a', 'bc'.
    v = {
        "bytes": {0: b"a", 1: b"b", 2: b"c", 3: b"bc", 4: b"ab", 5: b"abc"},
        "single": np.arange(-97, 159, dtype=np.int32),
        "merges": {(1, 2): 0, (0, 1): 1, (4, 2): 2},
        "made": np.array([3, 4, 5], dtype=np.int32),
        "special": {},
    }
    pairs = sorted(v["merges"])
    v |= {
        "keys": np.array([a << 32 | b for a, b in pairs], dtype=np.int64),
        "ranks": np.array([v["merges"][p] for p in pairs], dtype=np.int32),
    }
    assert not packing.merges_by_token(v)
    v["merges"] = {(1, 2): 0, (0, 1): 1, (0, 3): 2}
    pairs = sorted(v["merges"])
    v |= {
        "keys": np.array([a << 32 | b for a, b in pairs], dtype=np.int64),
        "ranks": np.array([v["merges"][p] for p in pairs], dtype=np.int32),
    }
    assert packing.merges_by_token(v)


def pieces_of(library, text, capacity):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def check(got, docs, library, capacity):
    want = [
        (d, k, a, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d, text in docs
        for k, a, ids in pieces_of(library, text, capacity)
    ]
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted(want, key=str)
    left = room_of([(r["sequence_id"], r["offset"], r["length"]) for r in got], capacity)
    assert left == best_fit([w[3] for w in want], capacity)


def test_rows_and_sequences(spark, rows, library):
    data = [(k, "word " * (k % 9), k) for k in range(60)]
    data += [(None, "one", 1), (2, None, 2), (2, None, 2), (3, "", 3), (4, "x" * 4000, 4), (5, "a b c " * 500, 5)]
    data += [(6, "same text", 6)] * 40
    docs = spark.createDataFrame(data, "doc_id long, text string, piece int").repartition(5)
    packed = packing.pack(docs, PATH, 16, keep_ids=True).cache()
    got = rows(packed)
    check(got, [(d, t) for d, t, _ in data], library, 16)
    joined = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(packed).collect()}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert joined[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == ids
    assert sum(map(len, joined.values())) == sum(r["length"] for r in got)


def test_empty_table(spark):
    empty = packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_query_equals_brute_force(spark, rows, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows(QUERIES["op11_packing"](spark, SF)), docs, library, 2048)
