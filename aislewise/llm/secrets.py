"""Operator 4: secrets in texts, and who owns them across the whole corpus.

Each text is scanned for three base kinds (assignments, access keys, long hex) and for further candidates: runs of 20 or
more token characters that hold both letters and digits. Of every candidate only a 128-bit hash of its value leaves the
scan. Hashes are counted over all rows by distinct repositories and owners. A value that ``EXAMPLE_OWNERS`` owners or
``EXAMPLE_REPOSITORIES`` repositories hold is a widely copied example, so one owner's thousand copies are no secret. Any
other value, two owners' among them, is owner-specific; if it also looks live (enough entropy, no placeholder word), it is
a live credential. The further candidates found live are added as spans of kind ``owned``; base spans always stay.

Counting goes in three steps, each summed up map-side: distinct (hash, owner, repository), repositories per (hash,
owner), owners per hash. So neither a hash nor an owner that a third of the rows share is gathered in one task. Texts are
never shuffled by ``scan``; ``redact`` joins spans to texts by id and text digest.

Spans are code points, end exclusive. Defined results: a null text is empty. Each row gives one row; repeated rows have
equal results. A null owner is one owner, a null repository one repository. Overlapping spans of several kinds all
count; a further candidate that overlaps a base span of its text is not added, as that span covers it already. Columns
other than those named are not read by ``scan``; ``redact`` returns the columns of ``docs``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import by_batch, raw_bytes, set_aside, written

KINDS = ("assign", "access", "hex", "owned")
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 10  # of all owners together
LIVE_ENTROPY = 3.0  # bits a character
PLACEHOLDERS = ("example", "sample", "dummy", "placeholder", "changeme", "xxxx", "0000", "1234", "abcd")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]+")
SHORTEST = {"assign": 8, "access": 16, "hex": 32, "owned": 20}

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def marks(characters: bytes) -> bytes:
    """A table that turns the characters into x and all other bytes into a blank."""
    return bytes(120 if b in characters else 32 for b in range(256))


HEX_MARKS = marks(b"0123456789abcdef")
TOKEN_MARKS = marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def looks_live(value: str) -> bool:
    """Letters and digits, enough entropy, and no placeholder word."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return entropy >= LIVE_ENTROPY and not any(p in value.lower() for p in PLACEHOLDERS)


def candidates(text: bytes) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of a text. Cheap byte tests, each implied by a match, spare most texts the patterns."""
    found: list[tuple[int, int, int, str]] = []
    has_hex = b"x" * SHORTEST["hex"] in text.translate(HEX_MARKS)
    has_token = b"x" * SHORTEST["owned"] in text.translate(TOKEN_MARKS)
    has_word = any(w in text.translate(LOWER) for w in WORDS)
    has_access = b"AKIA" in text
    if not (has_hex or has_token or has_word or has_access):
        return found
    chars = text.decode()
    if has_word:
        found += [(0, *m.span(), m[2]) for m in ASSIGN.finditer(chars) if len(m[2]) >= SHORTEST["assign"]]
    if has_access:
        found += [(1, *m.span(), m[0]) for m in ACCESS.finditer(chars) if len(m[0]) >= SHORTEST["access"]]
    if has_hex:
        found += [(2, *m.span(), m[0]) for m in HEX.finditer(chars) if len(m[0]) >= SHORTEST["hex"]]
    if has_token:
        base = sorted((s, e) for _, s, e, _ in found)
        at, reach = 0, 0
        for m in TOKEN.finditer(chars):
            if m.end() - m.start() < SHORTEST["owned"]:
                continue
            while at < len(base) and base[at][0] < m.end():
                reach = max(reach, base[at][1])
                at += 1
            if reach <= m.start() and looks_live(m[0]):
                found.append((3, *m.span(), m[0]))
    return found


FOUND = "found array<struct<kind:int,start:int,end:int,value:binary,live:boolean>>"


def scan_texts(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """doc_id, text_key, owner, repository and ``found`` of every row."""
    named = docs.select(
        "doc_id",
        "text",
        F.md5(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            [
                {
                    "kind": kind,
                    "start": start,
                    "end": end,
                    "value": hashlib.blake2b(value.encode(), digest_size=16).digest(),
                    "live": looks_live(value),
                }
                for kind, start, end, value in candidates(text)
            ]
            for text in raw_bytes(batch.column(1))
        ]
        item = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary()), ("live", pa.bool_())]
        found = pa.array(rows, pa.list_(pa.struct(item)))
        names = [n for n in batch.schema.names if n != "text"]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), found], [*names, "found"])

    kept = named.drop("text")
    return by_batch(named, work, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", " + FOUND)


def ownership(candidates: DataFrame) -> DataFrame:
    """value, owners and repositories of every candidate hash, over all rows."""
    uses = candidates.select("value", "owner", "repository").distinct()
    per_owner = uses.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repositories").cast("long").alias("repositories")
    )


def joined(spans: Column) -> Column:
    """kind:start:end of sorted (start, kind, end) spans, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", corpus: DataFrame | None = None) -> DataFrame:
    """doc_id, text_key, ``base`` and ``spans`` (sorted arrays of start, kind, end), ``uses`` (owners and repositories of
    the value of each span, in the order of ``spans``), n_live and n_example of each row.

    ``docs`` has doc_id, text and the columns that name the owner and the repository of a row. ``corpus`` has them too: the
    rows in which hashes are counted, where they are not those of ``docs`` (its copies removed, say).
    """
    texts = written(scan_texts(docs, owner, repository))
    rows = texts.where("size(found) > 0").select("*", F.explode("found").alias("c")).select(
        "doc_id", "text_key", "owner", "repository", "c.*"
    )
    example = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    live = F.col("live") & ~example
    counted = rows
    if corpus is not None:
        counted = scan_texts(corpus, owner, repository).select("owner", "repository", F.explode("found.value").alias("value"))
    judged = rows.join(ownership(counted), "value").where((F.col("kind") < 3) | live)
    span = F.struct("start", "kind", "end", live.alias("live"), example.alias("example"), "owners", "repositories")
    of_text = judged.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(span)).alias("s"))
    same = F.expr("t.doc_id <=> o.doc_id AND t.text_key = o.text_key")
    plain = lambda s: F.struct(s["start"], s["kind"], s["end"])
    s = F.coalesce("s", F.array().cast(of_text.schema["s"].dataType))
    return (
        texts.alias("t")
        .join(of_text.alias("o"), same, "left")
        .select("t.doc_id", "t.text_key", s.alias("s"))
        .select(
            "doc_id",
            "text_key",
            F.transform(F.filter("s", lambda x: x["kind"] < 3), plain).alias("base"),
            F.transform("s", plain).alias("spans"),
            F.transform("s", lambda x: F.struct(x["owners"], x["repositories"])).alias("uses"),
            F.size(F.filter("s", lambda x: x["live"])).cast("long").alias("n_live"),
            F.size(F.filter("s", lambda x: x["example"])).cast("long").alias("n_example"),
        )
    )


def report(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Counts per kind, the digest of the base spans, all spans and owners:repositories of each, one row per document."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scan(docs, owner, repository).select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("uses", lambda u: F.concat_ws(":", u["owners"], u["repositories"])), ",").alias("uses"),
        "n_live",
        "n_example",
    )


def redact(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id", mask: str = "[secret]", corpus: DataFrame | None = None
) -> DataFrame:
    """``docs`` with every span, and spans that overlap it, replaced by ``mask``. Hashes are counted in ``corpus``, if given,
    which holds all rows of ``docs``, whatever was cut from their texts."""
    spans = scan(docs, owner, repository, corpus=corpus).where("size(spans) > 0").select("doc_id", "text_key", "spans").distinct()
    plain, back = set_aside(docs, "text_key", "spans")
    keyed = plain.withColumn("text_key", F.md5(F.coalesce("text", F.lit(""))))
    same = F.expr("d.doc_id <=> s.doc_id AND d.text_key = s.text_key")
    found = keyed.alias("d").join(spans.alias("s"), same, "left").select("d.*", "s.spans")
    names, at = plain.columns, plain.columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            if spans:
                done, parts = 0, []
                for s in sorted(spans, key=lambda s: s["start"]):
                    if s["start"] >= done:
                        parts += [texts[i][done : s["start"]], mask]
                    done = max(done, s["end"])
                texts[i] = "".join([*parts, texts[i][done:]])
        columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(names))]
        return pa.RecordBatch.from_arrays(columns, names)

    return by_batch(found.select(*names, "spans"), work, plain.schema).select(*back)
