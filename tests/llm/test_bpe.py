import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aislewise.llm import bpe
from aislewise.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encode():
    return bpe.encoder(bpe.load_vocabulary(PATH))


HARD = [
    "",
    " ",
    "  a",
    "a  ",
    "\n\n b\n",
    "it's 'll we'LL",
    "à la  x    y  ",
    "x<|endoftext|>  <|endoftext|>y",
    "漢字 かな 😀 1²3",
    "\x1c\x85   z",
    "a" * 3000,
    "ab" * 500 + " " * 900 + "=-" * 300,
]


@pytest.mark.parametrize("text", HARD)
def test_ids_equal_the_library(library, encode, text):
    ids = np.frombuffer(encode([text.encode()])[0], "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t àéaB1²'sl!.<|>漢😀\r\x85"), max_size=25))
def test_any_text_equals_the_library(text):
    test_any_text_equals_the_library.encode = getattr(
        test_any_text_equals_the_library, "encode", None
    ) or bpe.encoder(bpe.load_vocabulary(PATH))
    test_any_text_equals_the_library.library = getattr(
        test_any_text_equals_the_library, "library", None
    ) or Tokenizer.from_file(PATH)
    ids = np.frombuffer(test_any_text_equals_the_library.encode([text.encode()])[0], "<u4").tolist()
    assert ids == test_any_text_equals_the_library.library.encode(text, add_special_tokens=False).ids


def test_cuts_are_certain():
    v = bpe.load_vocabulary(PATH)
    assert not v["inside"][ord("a"), ord(" ")] and v["inside"][ord(" "), ord("a")]
    assert v["joined_to_blanks"] == b"\xa0"


def want(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return {
        "doc_id": doc_id,
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        "decoded_sha256": hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
    }


def test_rows(spark, rows, library):
    data = [(1, t, "x") for t in HARD] + [(None, "one", None), (2, None, "y"), (2, None, "y")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string")
    got = rows(bpe.digests(docs, PATH))
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(got, key=key) == sorted((want(library, d, t) for d, t, _ in data), key=key)


def test_columns_with_clashing_names_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6)], "doc_id long, text string, ids int, decoded int")
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"] and out.first().decoded == "a b"


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query_equals_the_library(spark, rows, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = rows(QUERIES["op8_bpe"](spark, SF))
    assert sorted(got, key=lambda r: r["doc_id"]) == [want(library, d, docs[d]) for d in sorted(docs)]
