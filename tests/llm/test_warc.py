import base64
import gzip
import hashlib
import io

import pytest

from aislewise.llm import warc
from aislewise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def brute(pages):
    payloads = [(r[0], (r[2] or "").encode()) for r in pages]
    largest = {}
    for i, p in payloads:
        if i is not None:
            largest[p] = max(i, largest.get(p, i))
    out = []
    for i, p in payloads:
        top = largest.get(p)
        same = i == top
        sha = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), sha, "response" if same else "revisit", None if same else top))
    return sorted(out, key=str)


def got(df):
    names = "page_id payload_bytes payload_digest record_type refers_to".split()
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(QUERIES["op7_warc"](spark, SF)) == brute(pages)


PAGES = [
    (1, "http://a/é b\n", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://c", "x" * 3_000_000), (4, "u", None), (5, "u", ""),
    (-6, "u", "<p>é</p>"), (None, "u", ""), (None, "n", "only"), (None, "n", "only"), (7, "u", "same"), (7, "u", "same"),
    (8, "u", "\r\n\r\nWARC/1.1\r\n"), (9, "u", "same"),
]


def test_cases(spark):
    pages = spark.createDataFrame([(*p, 1, "z") for p in PAGES], SCHEMA + ", size int, sha1 string")
    assert got(warc.round_trip(pages)) == brute(PAGES)


def test_archives(spark, tmp_path, monkeypatch):
    """Several archives a task; each is valid gzip, and payloads and urls come back."""
    folder = f"file://{tmp_path}/w"
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    archives = warc.write(spark.createDataFrame(PAGES, SCHEMA).coalesce(2), folder).collect()
    assert len(archives) > 3 and sum(a.records for a in archives) == len(PAGES)
    text = b"".join(gzip.open(a.path).read() for a in archives)
    assert text.count(b"WARC-Type: response") + text.count(b"WARC-Type: revisit") == len(PAGES)
    rows = warc.read(spark.createDataFrame(archives), folder, payloads=True).collect()
    whole = {(r[0], (r[2] or "").encode()) for r in PAGES}
    assert {(r.page_id, r.payload) for r in rows if r.payload is not None} <= whole
    assert next(r.url for r in rows if r.page_id == 1) == "http://a/é%20b%0A"
    assert next(r.url for r in rows if r.page_id == 2) is None


def test_shortest(spark, tmp_path):
    rows = warc.read(warc.write(spark.createDataFrame(PAGES, SCHEMA), f"file://{tmp_path}/w", 5), f"file://{tmp_path}/w").collect()
    assert {r.page_id for r in rows if r.record_type == "revisit"} == {1, -6}


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_members_are_framed_in_any_block_size(block):
    records = [warc.record(i, "u", p, None) for i, p in enumerate([b"", b"a" * 1000, b"b\r\n\r\n"])]
    stream = io.BytesIO(b"".join(map(warc.member, records)))
    parsed = [warc.check(*warc.parse(pieces)) for _, pieces in warc.members(stream, block)]
    assert parsed == [(0, b""), (1000, b"a" * 1000), (5, b"b\r\n\r\n")]


@pytest.mark.parametrize(
    "broken",
    [
        warc.member(warc.record(1, "u", b"abc", None))[:-9],
        warc.member(warc.record(1, "u", b"abc", None)[:-1]),
        warc.member(warc.record(1, "u", b"abc", None).replace(b"abc", b"abd")),
        warc.member(b"no record"),
    ],
)
def test_broken_records_raise(broken):
    with pytest.raises(ValueError):
        [warc.check(*warc.parse(pieces)) for _, pieces in warc.members(io.BytesIO(broken))]


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
