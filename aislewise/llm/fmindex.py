"""Operator 3: benchmark decontamination by an FM-index per training shard.

A shard is a run of documents of one task, up to ``SHARD_WORDS`` words. Its words become symbols: each word that the
benchmark uses is one, every other word can be in no phrase and ends a run. Runs shorter than the shortest phrase hold
none; the rest, each closed by a separator, is the text of the index: suffix array, Burrows-Wheeler transform, and a
wavelet matrix whose bit vectors answer rank queries. All phrases are searched backwards at once, a symbol at a step.
Rows that match are located by walking back to a sampled suffix position, and the spans are merged per document.

Phrases: 10 consecutive words of an item; an item of fewer words, but not none, is one phrase.

Distinct items are broadcast in blocks of about half of ``BLOCK_BYTES`` of benchmark text. A task reads its rows once, in one
stage without a shuffle, and searches each shard for one block after another; what it holds grows with the benchmark, not with
the documents.

Defined results: A-Z is lower-cased; words are runs of digits, letters and everything above ASCII. Null texts have no
words. Each row gives one row, repeated rows included. Items with equal ids count once, whatever their texts; an item
without an id counts under the empty string. Columns other than those named are passed on by ``find`` and ``cut``; the
columns that ``find`` adds replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import raw_bytes, slices, written

WINDOW = 10
SHARD_WORDS = 2_000_000
BLOCK_BYTES = 4_000_000
SAMPLE = 16  # every so many positions of the index text, the suffix position is kept
SPANS, ITEMS, COUNT = "hit_spans", "hit_items", "n_words"

WORD_BYTES = [b for b in range(256) if b >= 128 or chr(b).isalnum()]
# Word bytes as they are, A-Z in lower case, everything else a blank.
TABLE = bytes((b + 32 if 65 <= b <= 90 else b) if b in set(WORD_BYTES) else 32 for b in range(256))
WORD = re.compile(rb"[^ ]+")


def split_words(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class BitVector:
    """Bits with the number of ones before every 64-bit word: rank in constant time."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """One bit vector per bit of the symbols, highest first; each level puts zeros before ones, in order."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in range(bits - 1, -1, -1):
            one = ((symbols >> shift) & 1).astype(bool)
            self.levels.append((shift, BitVector(one), int((~one).sum())))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        first = np.zeros(len(at), dtype=np.int64)
        for shift, vector, zeros in self.levels:
            one = ((symbols >> shift) & 1).astype(bool)
            ones, ones_first = vector.rank(at), vector.rank(first)
            at = np.where(one, zeros + ones, at - ones)
            first = np.where(one, zeros + ones_first, first - ones_first)
        return at - first

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it stands before it."""
        symbols, first = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        for shift, vector, zeros in self.levels:
            one = vector.get(at)
            ones, ones_first = vector.rank(at), vector.rank(first)
            symbols |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
            first = np.where(one, zeros + ones_first, first - ones_first)
        return symbols, at - first


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; symbol 0 is a separator, and each separator differs from all others."""
    n = len(text)
    rank = text.astype(np.int64) + (text == 0).sum()
    rank[text == 0] = np.arange((text == 0).sum())
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        ranked = rank[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        if new[order[-1]] == n - 1:
            return order
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = new[step:] + 1
        rank = new * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step *= 2


class FMIndex:
    """Index of a text of symbols 1 and up, in runs that are each closed by a 0."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        transform = text[order - 1]  # the first suffix follows the last separator
        self.rows = len(text)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.wavelet = WaveletMatrix(transform, max(1, int(symbols).bit_length()))
        # Run starts are sampled too, so a walk never crosses a separator.
        kept = (order % SAMPLE == 0) | (transform == 0)
        self.sampled, self.positions = BitVector(kept), order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that begin with each phrase; phrases are right-aligned rows."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.rows, dtype=np.int64)
        width = phrases.shape[1]
        for k in range(width):
            live = np.flatnonzero((lengths > k) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, width - 1 - k]
            low[live] = self.starts[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.starts[symbol] + self.wavelet.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back until a sampled one."""
        rows, out, steps = rows.copy(), np.empty(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            here = self.sampled.get(rows[open_])
            done = open_[here]
            out[done] = self.positions[self.sampled.rank(rows[done])] + steps[done]
            open_ = open_[~here]
            symbol, before = self.wavelet.access(rows[open_])
            rows[open_] = self.starts[symbol] + before
            steps[open_] += 1
        return out


def phrase_block(items: list[tuple[str, bytes]]) -> dict:
    """Plain tables of the phrases of some items: words' symbols, phrases as rows, and the items of each."""
    symbols: dict[bytes, int] = {}
    phrases: dict[tuple[int, ...], set[str]] = {}
    for name, text in items:
        word = [symbols.setdefault(w, len(symbols) + 1) for w in split_words(text)]
        n = min(WINDOW, len(word))
        for i in range(len(word) - n + 1 if n else 0):
            phrases.setdefault(tuple(word[i : i + n]), set()).add(name)
    table = np.zeros((len(phrases), WINDOW), dtype=np.int64)
    for row, phrase in zip(table, phrases):
        row[WINDOW - len(phrase) :] = phrase
    return {
        "symbols": symbols,
        "phrases": table,
        "lengths": np.array([len(p) for p in phrases], dtype=np.int64),
        "items": [sorted(names) for names in phrases.values()],
    }


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with overlapping and adjacent ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def search_shard(symbols: list[np.ndarray], block: dict) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """Spans (words, end exclusive) and items found in each document that holds a phrase."""
    lengths = np.array([len(s) for s in symbols])
    begins = np.concatenate([[0], np.cumsum(lengths)])
    whole = np.concatenate([*symbols, np.zeros(1, dtype=np.int64)])
    # Runs of benchmark words inside one document that can hold the shortest phrase.
    edge = np.zeros(len(whole) + 1, dtype=bool)
    edge[begins] = edge[-1] = True
    inner = whole > 0
    edge[1:-1] |= inner[1:] != inner[:-1]
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    keep = inner[start] & (end - start >= block["lengths"].min())
    start, end = start[keep], end[keep]
    if not len(start):
        return {}
    size = end - start + 1  # with its separator
    origin = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    text = whole[origin]
    text[np.cumsum(size) - 1] = 0
    index = FMIndex(text, len(block["symbols"]))
    low, high = index.search(block["phrases"], block["lengths"])
    hit = np.flatnonzero(high > low)
    n = high[hit] - low[hit]
    rows = np.repeat(low[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    phrase = np.repeat(hit, n)
    position = origin[index.locate(rows)]
    doc = np.searchsorted(begins, position, side="right") - 1
    found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    for d, p, s in zip(doc.tolist(), phrase.tolist(), (position - begins[doc]).tolist()):
        spans, items = found.setdefault(d, ([], set()))
        spans.append((s, s + int(block["lengths"][p])))
        items.update(block["items"][p])
    return found


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def phrase_blocks(benchmark: DataFrame) -> list[Broadcast]:
    """The distinct items' phrases, in broadcast blocks."""
    spark = benchmark.sparkSession
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    named = named.where("text IS NOT NULL").distinct()
    # A checked size: blocks by hash that are half full on average.
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = 1 + 2 * total // BLOCK_BYTES
    named = written(named.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)).cast("int")))
    blocks = []
    for k in range(count):
        rows = named.where(F.col("block") == k).collect()
        blocks.append(spark.sparkContext.broadcast(phrase_block([(r.item, r.text.encode()) for r in rows])))
    return blocks


def with_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that a search fills."""
    return docs.drop(SPANS, ITEMS, COUNT).withColumns(
        {
            SPANS: F.array().cast("array<struct<start:long,end:long>>"),
            ITEMS: F.array().cast("array<string>"),
            COUNT: F.lit(0).cast("long"),
        }
    )


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the merged spans of words that stand in a phrase, the items found, and the number of words."""
    out = with_columns(docs)
    return out.mapInArrow(search(out.columns, phrase_blocks(benchmark)), out.schema)


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the phrases, as ``cut`` leaves them after ``find``: both in one Python worker."""
    out = with_columns(docs)
    find_in, cut_from = search(out.columns, phrase_blocks(benchmark)), cutter(out.columns)
    return out.mapInArrow(lambda batches: cut_from(find_in(batches)), out.schema).drop(SPANS, ITEMS, COUNT)


def search(names: list[str], blocks: list[Broadcast]) -> Run:
    """All blocks of phrases in one pass over the documents: a shard's texts are indexed for one block after another."""
    at = names.index("text")
    kinds = [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string()), pa.int64()]

    def symbols_of(batch: pa.RecordBatch, block: dict) -> list[np.ndarray]:
        get = block["symbols"].get
        words = map(split_words, raw_bytes(batch.column(at)))
        return [np.fromiter([get(w, 0) for w in own], dtype=np.int64, count=len(own)) for own in words]

    def finish(batches: list[pa.RecordBatch], symbols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hits: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        counts = list(map(len, symbols))
        for k, shared in enumerate(blocks):
            block = shared.value
            if not block["items"]:
                continue
            if k:
                symbols = [x for batch in batches for x in symbols_of(batch, block)]
            for doc, (spans, items) in search_shard(symbols, block).items():
                old = hits.setdefault(doc, ([], set()))
                old[0].extend(spans)
                old[1].update(items)
        base = 0
        for batch in batches:
            own = [hits.get(base + i, ((), ())) for i in range(batch.num_rows)]
            spans = [[{"start": a, "end": b} for a, b in merge_spans(list(x))] if x else [] for x, _ in own]
            items = [sorted(x) for _, x in own]
            columns = (spans, items, counts[base : base + batch.num_rows])
            base += batch.num_rows
            new = dict(zip((SPANS, ITEMS, COUNT), map(pa.array, columns, kinds)))
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(names)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, symbols, size = [], [], 0
        for part in (part for batch in batches for part in slices(batch)):
            new = symbols_of(part, blocks[0].value)
            symbols += new
            size += sum(map(len, new))
            held.append(part)
            if size >= SHARD_WORDS:
                yield from finish(held, symbols)
                held, symbols, size = [], [], 0
        if held:
            yield from finish(held, symbols)

    return run


def cut(found: DataFrame) -> DataFrame:
    """The rows of ``find`` with the text of each span removed: from its first word's first byte to its last word's
    last byte. Rows without words that are left go; rows without hits stay as they are."""
    return found.mapInArrow(cutter(found.columns), found.schema)


def cutter(names: list[str]) -> Run:
    text_at, spans_at, count_at = names.index("text"), names.index(SPANS), names.index(COUNT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch)):
            texts, keep = [], []
            hits = batch.column(spans_at).to_pylist()
            for text, spans, count in zip(raw_bytes(batch.column(text_at)), hits, batch.column(count_at).to_pylist()):
                keep.append(not spans or sum(s["end"] - s["start"] for s in spans) < count)
                if spans:
                    at = [m.span() for m in WORD.finditer(text.translate(TABLE))]
                    done, parts = 0, []
                    for s in spans:
                        parts.append(text[done : at[s["start"]][0]])
                        done = at[s["end"] - 1][1]
                    text = b"".join([*parts, text[done:]])
                texts.append(text.decode())
            nulls = batch.column(text_at).is_null().to_pylist()
            new = pa.array([None if null else t for t, null in zip(texts, nulls)], batch.column(text_at).type)
            columns = [new if i == text_at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    return work


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts per document: its words, those hit, and the items of which a phrase occurs."""
    found = find(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate(SPANS, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        COUNT,
        n_hit.alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ITEMS), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
