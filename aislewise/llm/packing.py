"""Operator 11: best-fit packing of documents into sequences of a fixed number of tokens.

A document is its token ids and an end id. Documents longer than a sequence are cut into pieces of a whole sequence; the
first piece takes the rest. Best-fit decreasing then takes the pieces from long to short, and puts each into the open
sequence with the least room that still holds it, found in a segment tree over remaining capacities.

Pieces of one length are interchangeable, and so are sequences with equal room. So the tree counts the open sequences
of each capacity, and one descent places all pieces of a length that best fit would put, one after another, into the
sequences of one capacity: each of them takes as many as it can hold before the next one is touched, since it is then the
tightest. The result is that of a descent per piece. The plan is made from the number of pieces of each length, at most
one row a length, whatever the corpus, and lists ranges of equal sequences; each piece finds its place there by its rank
among the pieces of its length. Ranks are a task's own running numbers plus the counts of the tasks before it. Texts and
ids are never shuffled, and no window runs over pieces.

Ids are those of the tokenizers library. The byte-pair merges run in a compiled encoder that merges by the rank of the
joined token, which gives the same ids if every token of the vocabulary is found again when its own bytes are encoded:
two neighbours that join to a token but by another pair would leave that token's own bytes unjoined. That is checked
when the vocabulary is loaded; a vocabulary that fails is encoded by operator 8.

Defined results: a null or empty text is one piece, the end id alone; repeated rows are packed as often as they occur;
null ids are kept; other columns are not read. Which of several equal-length pieces goes where is not defined, and
sequence numbers are dense from 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislewise.llm import bpe
from aislewise.llm.common import raw_bytes, slices, written

CAPACITY = 2048
END = 0


# --- tokens ---------------------------------------------------------------------------------------------------------


def merges_by_token(vocabulary: dict) -> bool:
    """Whether each token's own bytes are merged to that token alone."""
    tokens = [x for i, x in vocabulary["bytes"].items() if x.decode("utf-8", "replace") not in vocabulary["special"]]
    starts = np.cumsum([0, *map(len, tokens[:-1])])
    _, begins = bpe.merge_all(np.frombuffer(b"".join(tokens), np.uint8), starts, vocabulary)
    return bool((np.diff(begins) == 1).all())


def encoder(vocabulary: dict) -> Callable[[list[bytes]], list[bytes]]:
    """From the UTF-8 bytes of texts to their ids as little-endian unsigned 32-bit integers."""
    if "compiled" not in vocabulary:
        vocabulary["compiled"] = compiled(vocabulary) if merges_by_token(vocabulary) else bpe.encoder(vocabulary)
    return vocabulary["compiled"]


def compiled(vocabulary: dict) -> Callable[[list[bytes]], list[bytes]]:
    merged = vocabulary["made"].tolist()
    ranks = {bytes([b]): b for b in range(256)} | {vocabulary["bytes"][t]: 256 + k for k, t in enumerate(merged)}
    special = {text: len(ranks) + k for k, text in enumerate(vocabulary["special"])}
    ids = np.array([*vocabulary["single"].tolist(), *merged, *vocabulary["special"].values()], dtype="<u4")
    core = tiktoken.Encoding("bytes", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(texts: list[bytes]) -> list[bytes]:
        return [ids[core.encode_to_numpy(x.decode(), allowed_special="all")].tobytes() if x else b"" for x in texts]

    return encode


# --- the plan -------------------------------------------------------------------------------------------------------


class Room:
    """Open sequences by remaining capacity: ranges of equal ones, and a segment tree of their number."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.width)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.ranges[room].append((first, count))
            self.count(room, count)

    def count(self, room: int, change: int) -> None:
        at = room + self.width
        while at:
            self.tree[at] += change
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The least capacity of at least ``length`` that some open sequence has."""
        at = length + self.width
        while not self.tree[at]:
            while at & 1:
                at >>= 1
            if not at:
                return None
            at += 1  # the subtree to the right
        while at < self.width:
            at = 2 * at + (not self.tree[2 * at])
        return at - self.width

    def take(self, room: int) -> tuple[int, int]:
        first, count = self.ranges[room].pop()
        self.count(room, -count)
        return first, count


@dataclass(frozen=True)
class Range:
    """Pieces of ``length`` with ranks from ``rank``: ``each`` in a sequence, from ``sequence`` and place ``offset`` on."""

    length: int
    rank: int
    sequence: int
    offset: int
    each: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Range]:
    """Best-fit decreasing for ``counts`` pieces of each length, in order of length and rank."""
    room, opened, out = Room(capacity), 0, []
    for length in sorted(counts, reverse=True):
        placed, total = 0, counts[length]
        while placed < total:
            left = room.tightest(length)
            first, count = (opened, -(-(total - placed) // (capacity // length))) if left is None else room.take(left)
            if left is None:
                left, opened = capacity, opened + count
            each = left // length
            out.append(Range(length, placed, first, capacity - left, each))
            full, rest = divmod(total - placed, each)
            if full >= count:
                full, rest = count, 0
            room.add(left - each * length, first, full)
            if rest:
                room.add(left - rest * length, first + full, 1)
            room.add(left, first + full + bool(rest), count - full - bool(rest))
            placed += full * each + rest
    return sorted(out, key=lambda r: (r.length, r.rank))


# --- on Spark -------------------------------------------------------------------------------------------------------


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth), and the ``ids`` if asked for: ``nth`` numbers the pieces of one
    length in the task that made them."""
    shared = bpe.share(docs.sparkSession, path)
    schema = docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long")
    schema = schema.add("ids_crc32", "long").add("task", "integer").add("nth", "long")
    if keep_ids:
        schema = schema.add("ids", "binary")
    tail = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(shared.value), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                rows, begins, made = [], [], []
                for at, ids in enumerate(encode(raw_bytes(part.column(1)))):
                    ids += tail
                    whole = range(len(ids) % (4 * capacity), len(ids), 4 * capacity)
                    cuts = [*([0] if whole.start or not whole else []), *whole, len(ids)]
                    made += [ids[a:b] for a, b in zip(cuts, cuts[1:])]
                    begins += cuts[:-1]
                    rows += [(at, k) for k in range(len(cuts) - 1)]
                row, piece = np.array(rows, dtype=np.int64).reshape(-1, 2).T
                length = np.array(list(map(len, made)), dtype=np.int64) // 4
                nth = met[length] + running(length)
                met += np.bincount(length, minlength=capacity + 1)
                columns = [
                    part.column(0).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(np.array(begins, dtype=np.int64) // 4),
                    pa.array(length),
                    pa.array(list(map(zlib.crc32, made)), pa.int64()),
                    pa.array(np.full(len(row), task), pa.int32()),
                    pa.array(nth),
                ]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(made, pa.binary())] * keep_ids)], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def running(values: np.ndarray) -> np.ndarray:
    """How often each value occurs before its place."""
    order = np.argsort(values, kind="stable")
    first = np.searchsorted(values[order], values[order])
    out = np.empty(len(values), dtype=np.int64)
    out[order] = np.arange(len(values)) - first
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ``ids`` if asked for."""
    spark = docs.sparkSession
    made = written(pieces(docs, path, capacity, end, keep_ids))
    counts = written(made.groupBy("length", "task").agg(F.count("*").alias("n")))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # At most ``capacity`` rows, whatever the corpus.
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges = plan(totals, capacity)
    shared = spark.sparkContext.broadcast(
        ([(r.length, r.rank) for r in ranges], np.array([[r.sequence, r.offset, r.each] for r in ranges]).reshape(-1, 3))
    )
    kept = made.columns
    ranked = made.join(before, ["length", "task"]).select(*kept, (F.col("before") + F.col("nth")).alias("rank"))
    at_length, at_rank = ranked.columns.index("length"), ranked.columns.index("rank")
    columns = [c for c in kept if c not in ("task", "nth")]
    schema = made.select(*columns).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, places = shared.value
        lengths = np.array([x for x, _ in starts], dtype=np.int64)
        ranks = np.array([x for _, x in starts], dtype=np.int64)
        bounds = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            length, rank = batch.column(at_length).to_numpy(), batch.column(at_rank).to_numpy()
            at = np.empty(len(rank), dtype=np.int64)
            for size in np.unique(length).tolist():
                own = length == size
                at[own] = bounds[size] + np.searchsorted(ranks[bounds[size] : bounds[size + 1]], rank[own], "right") - 1
            inside, each = rank - ranks[at], places[at, 2]
            sequence = pa.array(places[at, 0] + inside // each)
            offset = pa.array(places[at, 1] + inside % each * length)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), sequence, offset], schema.names)

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with their ids: each sequence's ids in order, 4 bytes each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
