"""Operator 8: byte-pair encoding and decoding by forced-boundary splitting.

A byte pair that stands inside no vocabulary token can never be merged over, so it marks a certain cut. Texts are
cut twice by that rule. Hardly any token holds a non-blank byte followed by a blank, so a text falls into fragments
of blanks and the word after them, but for the few bytes that some token does join to a blank; each distinct
fragment is encoded once and remembered. Inside a fragment, the pieces that the pre-tokenizer makes are cut at every other certain pair before merging. The
ids of the parts, put after one another, are the ids of the text.

Why the first cut is exact: the pre-tokenizer's pattern joins a blank only to what follows it, and looks ahead from
blanks only. A run that mixes ASCII blanks with other Unicode blanks may be one piece, but the cut inside it lies at
a byte pair that no token holds.

Defined results: a null or empty text has no ids and decodes to the empty text; every row gives one row, repeated
rows included; other columns are not read. Strings of special tokens inside a text become their ids. Bytes that are
not UTF-8 (possible only for ids from elsewhere) decode to U+FFFD; an id outside the vocabulary raises.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.llm.common import by_batch, raw_bytes

BLANKS = b" \t\n\r\x0b\x0c"
# The published split pattern of byte-level BPE; it has to match the vocabulary's, so it is a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 250_000  # fragments a worker keeps; only speed depends on it
LONG = 64  # bytes from which merging uses a heap


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files, and the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def load_vocabulary(path: str) -> dict:
    """Plain tables of a byte-level BPE file: tokens' bytes, merge ranks, special tokens and certain cuts."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    letters, model = byte_letters(), spec["model"]
    tokens: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items()}
    ids = {t: i for i, t in tokens.items()}
    merges: dict[tuple[int, int], int] = {}
    made: list[int] = []
    for pair in model["merges"]:
        a, b = (bytes(letters[c] for c in side) for side in (pair.split(" ") if isinstance(pair, str) else pair))
        merges[ids[a], ids[b]] = len(made)
        made.append(ids[a + b])
    inside = np.zeros((256, 256), dtype=bool)
    for t in tokens.values():
        b = np.frombuffer(t, dtype=np.uint8)
        inside[b[:-1], b[1:]] = True
    by_key = sorted(merges)
    special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
    joined = [b for b in range(256) if b not in BLANKS and inside[b, list(BLANKS)].any()]
    return {
        "bytes": tokens | {i: t.encode() for t, i in special.items()},
        "single": np.array([ids[bytes([b])] for b in range(256)], dtype=np.int32),
        "merges": merges,
        "made": np.array(made, dtype=np.int32),
        "keys": np.array([a << 32 | b for a, b in by_key], dtype=np.int64),
        "ranks": np.array([merges[pair] for pair in by_key], dtype=np.int32),
        "inside": inside,
        "special": special,
        "joined_to_blanks": bytes(joined),
        "blank_in_special": any(c in t.encode() for t in special for c in BLANKS),
        "known": {},
    }


def merge_all(text: np.ndarray, starts: np.ndarray, vocabulary: dict) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many parts, one after another, and where each part's ids begin (and the last ends).

    Parts of one length are merged together, a row of a table each: every round merges each row's lowest-ranked
    pair, leftmost first, and looks up only the two pairs that it changed.
    """
    keys, ranks, made = vocabulary["keys"], vocabulary["ranks"], vocabulary["made"]
    none, single = len(made), vocabulary["single"]

    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted) & (a >= 0) & (b >= 0), ranks[at], none)

    lengths = np.diff(starts, append=len(text))
    counts = np.zeros(len(starts), dtype=np.int64)
    ended: list[tuple[np.ndarray, np.ndarray]] = []  # part numbers, and their ids in the same order
    for part in np.flatnonzero(lengths > LONG).tolist():
        ids = merge_long(text[starts[part] : starts[part] + lengths[part]], vocabulary)
        counts[part] = len(ids)
        ended.append((np.array([part]), ids))
    for length in np.unique(lengths[lengths <= LONG]).tolist():
        rows = np.flatnonzero(lengths == length)
        # A column of -1 at the end stands for 'no token' and is shifted in as rows get shorter.
        ids = np.full((len(rows), length + 1), -1, dtype=np.int32)
        ids[:, :length] = single[text[starts[rows][:, None] + np.arange(length)]]
        order = rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), length)
        column = np.arange(length + 1)
        while len(rows):
            at = order.argmin(axis=1)
            least = order[np.arange(len(rows)), at]
            if (done := least == none).any():
                whole = ids[done]
                counts[rows[done]] = (whole >= 0).sum(axis=1)
                ended.append((rows[done], whole[whole >= 0]))
                rows, ids, order, at, least = (x[~done] for x in (rows, ids, order, at, least))
            line = np.arange(len(rows))
            shift = column[None, :] > at[:, None]
            ids[:, :-1] = np.where(shift[:, :-1], ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ids[line, at] = made[least]
            order[:, :-1] = np.where(shift[:, :-2], order[:, 1:], order[:, :-1])
            order[:, -1] = none
            order[line, at] = rank(ids[line, at], ids[line, at + 1])
            left = np.flatnonzero(at > 0)
            order[left, at[left] - 1] = rank(ids[left, at[left] - 1], ids[left, at[left]])
    begins = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(begins[-1], dtype="<u4")
    for parts, ids in ended:
        n = counts[parts]
        out[np.repeat(begins[parts] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return out, begins


def merge_long(part: np.ndarray, vocabulary: dict) -> np.ndarray:
    """The same for one long part: a heap of pairs and linked neighbours keep the work near linear."""
    found, made = vocabulary["merges"].get, vocabulary["made"].tolist()
    ids = vocabulary["single"][part].tolist()
    n = len(ids)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := found((ids[i], ids[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue  # one of the two has been merged since
        ids[i], ids[j], after[i] = made[r], -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
            if (s := found((ids[i], ids[after[j]]))) is not None:
                heapq.heappush(heap, (s, i, ids[i], ids[after[j]]))
        if (h := before[i]) >= 0 and (s := found((ids[h], ids[i]))) is not None:
            heapq.heappush(heap, (s, h, ids[h], ids[i]))
    return np.array([x for x in ids if x >= 0], dtype=np.int32)


def encoder(vocabulary: dict) -> Callable[[list[bytes]], list[bytes]]:
    """From the UTF-8 bytes of texts to their ids as little-endian unsigned 32-bit integers."""
    special, known, inside = vocabulary["special"], vocabulary["known"], vocabulary["inside"]
    pieces = regex.compile(PATTERN).findall
    marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
    marked = tuple(x.encode() for x in special)
    blank, joined = re.escape(BLANKS), re.escape(vocabulary["joined_to_blanks"])
    word = b"[^" + blank + b"]+"
    if joined:
        word += b"(?:(?<=[" + joined + b"])[" + blank + b"]+" + word + b")*"
    fragments = re.compile(b"[" + blank + b"]*" + word + b"|[" + blank + b"]+").findall
    if vocabulary["blank_in_special"]:
        fragments = lambda text: [text] if text else []
    one_piece = re.compile(rb" ?[A-Za-z]+").fullmatch

    def learn(new: list[bytes]) -> None:
        """Remembers the ids of fragments without special tokens."""
        lengths, first = [], [0]  # of pieces; the number of the first piece of each fragment
        for x in new:
            if one_piece(x):
                lengths.append(len(x))
            else:
                lengths += [len(piece.encode()) for piece in pieces(x.decode())]
            first.append(len(lengths))
        text = np.frombuffer(b"".join(new), np.uint8)
        cut = np.ones(len(text), dtype=bool)
        cut[1:] = ~inside[text[:-1], text[1:]]
        begins = np.concatenate([[0], np.cumsum(lengths)])
        cut[begins[:-1]] = True
        ids, at = merge_all(text, np.flatnonzero(cut), vocabulary)
        # The part that begins where a fragment begins, and so the fragment's place among the ids.
        part = np.concatenate([np.cumsum(cut) - 1, [len(at) - 1]])[begins[np.array(first)]]
        packed, ends = ids.tobytes(), (4 * at[part]).tolist()
        known.update(zip(new, [packed[a:b] for a, b in zip(ends, ends[1:])]))

    def learn_marked(fragment: bytes) -> None:
        """The same for a fragment that holds special tokens: their ids stand between those of the other pieces."""
        text, at, ids = fragment.decode(), 0, b""
        for found in [*marks.finditer(text), None]:
            if between := text[at : found.start() if found else len(text)].encode():
                learn([between])
                ids += known[between]
            if found:
                ids, at = ids + struct.pack("<I", special[found.group()]), found.end()
        known[fragment] = ids

    def encode(texts: list[bytes]) -> list[bytes]:
        if len(known) >= REMEMBERED:
            known.clear()
        cut = [fragments(x) for x in texts]
        new = {x for row in cut for x in row if x not in known}
        with_marks = {x for m in marked for x in new if m in x}
        if new > with_marks:
            learn(list(new - with_marks))
        for x in with_marks:
            learn_marked(x)
        out = [b"".join(map(known.__getitem__, row)) for row in cut]
        for x in new:
            if len(x) > 256:
                known.pop(x, None)
        return out

    return encode


def slices(texts: list[bytes], size: int = 1_000_000) -> Iterator[list[bytes]]:
    """Runs of texts of about ``size`` bytes, so that the fragments in memory at once are bounded."""
    run, held = [], 0
    for x in texts:
        run.append(x)
        held += len(x)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def share(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary for all workers. Its size is that of the vocabulary file (a few MB), whatever the corpus."""
    return spark.sparkContext.broadcast(load_vocabulary(path))


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with column ``into``: the ids of ``text``, 4 bytes each, little-endian."""
    shared = share(docs.sparkSession, path)
    base = docs.drop(into)
    at = base.columns.index(text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        run = encoder(shared.value)
        ids = pa.array([x for texts in slices(raw_bytes(batch.column(at))) for x in run(texts)], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, into])

    return by_batch(base, work, base.withColumn(into, F.lit(b"")).schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with column ``into``: the text of its ids, special tokens included; null ids give the empty text."""
    shared = share(encoded.sparkSession, path)
    base = encoded.drop(into)
    at = base.columns.index(ids)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        token = shared.value["bytes"].__getitem__
        texts = (
            b"".join(map(token, np.frombuffer(x or b"", dtype="<u4").tolist())).decode("utf-8", "replace")
            for x in batch.column(at).to_pylist()
        )
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return by_batch(base, work, base.withColumn(into, F.lit("")).schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and digests of ids and decoded text, one row per document."""
    out = decode(encode(docs.select("doc_id", "text"), path).drop("text"), path)
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
