"""Operator 13: periodic runs of words, by longest common extensions in suffix trees.

A run is a longest stretch of words that repeats with a smallest period: words a period apart are equal, and no
neighbouring word goes on. Of each run, the words after its first period can be dropped.

Ukkonen's algorithm builds the suffix trees of the text and of its reversal. A walk round each tree writes down the branching
node between two leaves; the least depth between the places of two leaves is that of their lowest common ancestor, so a
table of minima gives the longest common extension of two positions to the right (first tree) or left (second tree) in
constant time. The longest Lyndon word that starts at a position ends where the next smaller suffix begins, by the order of
the leaves. Every run holds such a word, of one period, for the order of words or its inverse; so each position gives one
candidate period an order, and extending it both ways gives the run, exactly.

Only stretches that can hold a run go into the trees. A run of length ``max(6, 4 * period)`` or more holds every
group of five words in it again a period away, so within a quarter of its length. Words in no such group are
in no run; what is left falls into fragments, all fragments of a slice of texts go into one tree, apart from each other by
separators that occur once. Texts are units of work and are never shuffled; memory grows with the longest text.

Defined results: null and empty texts have no words and no runs; repeated rows each give their row; an id that is null is
kept, and its text is not rewritten by the query. Runs come by start, then period.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.llm.common import raw_bytes, slices

SHORTEST = 6  # words of a run
TIMES = 4  # periods of a run, at least
GROUP = 5  # words that must recur: a run of 6 words or 4 periods holds each such group twice

Prepare = Callable[[object, list[bytes]], list[bytes]]


# --- suffix trees ---------------------------------------------------------------------------------------------------


def suffix_tree(text: list[int], symbols: int) -> tuple[list[int], list[int], dict[int, int]]:
    """Ukkonen's algorithm: the depth of each branching node (0: root; -1: a leaf), the suffix of each leaf, and the child
    of each (node, first symbol). The last symbol of ``text`` must occur once."""
    n = len(text)
    begin, end, link, depth, suffix, child = [0], [0], [0], [0], [-1], {}
    node = edge = length = left = 0
    for i, c in enumerate(text):
        waiting, left = 0, left + 1
        while left:
            if not length:
                edge = i
            key = node * symbols + text[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(begin)
                begin.append(i), end.append(n), link.append(0), depth.append(-1), suffix.append(i - left + 1)
                if waiting:
                    link[waiting], waiting = node, 0
            else:
                at = begin[below]
                size = end[below] - at
                if length >= size:
                    node, edge, length = below, edge + size, length - size
                    continue
                if text[at + length] == c:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                split = len(begin)
                child[key], child[split * symbols + c] = split, split + 1
                begin += [at, i]
                end += [at + length, n]
                link += [0, 0]
                depth += [left - 1, -1]
                suffix += [-1, i - left + 1]
                begin[below] = at + length
                child[split * symbols + text[at + length]] = below
                if waiting:
                    link[waiting] = split
                waiting = split
            left -= 1
            if node:
                node = link[node]
            elif length:
                length, edge = length - 1, i - left + 1
    return depth, suffix, child


class Extensions:
    """Longest common extensions to the right of any two positions, and the order of suffixes.

    Symbols below ``separators`` are smaller than all others in either order.
    """

    def __init__(self, text: list[int], symbols: int, separators: int):
        depth, suffix, child = suffix_tree(text, symbols)
        keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        below = np.fromiter(child.values(), dtype=np.int64, count=len(child))
        # Each node but the root has one parent and one first symbol.
        self.above, self.symbol = (np.zeros(len(depth), dtype=np.int64) for _ in range(2))
        self.above[below], self.symbol[below] = np.divmod(keys, symbols)
        self.depth, self.suffix, self.separators = np.array(depth), np.array(suffix), separators
        order, between = self.walk(inverse=False)
        self.rank = self.places(order)
        levels = [between.astype(np.int32)]
        while len(levels[-1]) > 1 << (len(levels) - 1):
            last, step = levels[-1], 1 << (len(levels) - 1)
            levels.append(np.minimum(last[:-step], last[step:]))
        self.levels = levels

    def walk(self, inverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and the depth of the branching node that the walk turns at between neighbours."""
        symbol = np.where(inverse & (self.symbol >= self.separators), (1 << 40) - self.symbol, self.symbol)
        order = np.lexsort((-symbol[1:], self.above[1:])) + 1  # the stack gives the last child first
        children, first = order.tolist(), np.searchsorted(self.above[order], np.arange(len(self.above) + 1)).tolist()
        stack, visited = children[: first[1]], []
        while stack:
            v = stack.pop()
            visited.append(v)
            a, b = first[v], first[v + 1]
            if a < b:
                stack += children[a:b]
        met = np.array(visited)
        leaf = np.flatnonzero(self.depth[met] < 0)
        return self.suffix[met[leaf]], self.depth[self.above[met[leaf[:-1] + 1]]]

    @staticmethod
    def places(order: np.ndarray) -> np.ndarray:
        out = np.empty(len(order), dtype=np.int64)
        out[order] = np.arange(len(order))
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common extensions from positions ``a`` and ``b``, which differ."""
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=np.int64)
        for k in np.unique(level).tolist():
            own = level == k
            out[own] = np.minimum(self.levels[k][low[own]], self.levels[k][high[own] - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each position the next one whose suffix is smaller; the length of ``rank`` where there is none."""
    out, ranks, stack = [len(rank)] * len(rank), rank.tolist(), []
    for i, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, dtype=np.int64)


def runs_of(text: np.ndarray, separators: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of ``text``, in any order. Symbols below ``separators`` occur once; the
    first and last symbol are such ones."""
    symbols = int(text.max()) + 1
    right = Extensions(text.tolist(), symbols, separators)
    left = Extensions(text[::-1].tolist(), symbols, separators)
    at = np.flatnonzero(text >= separators)
    found = []
    for rank in (right.rank, Extensions.places(right.walk(inverse=True)[0])):
        after = next_smaller(rank)[at]  # a separator at the latest
        after_last = len(text) - 1
        before = left.common(after_last - (at - 1), after_last - (after - 1))
        # A word of one symbol is its own period; the position before it is then the same on both sides.
        start, length = at - before, before + (after - at) + right.common(at, after)
        period = after - at
        whole = length >= np.maximum(SHORTEST, TIMES * period)
        found.append(np.column_stack([start, length, period])[whole])
    return np.unique(np.concatenate(found), axis=0)


# --- fragments that can hold a run ----------------------------------------------------------------------------------


def covered(starts: np.ndarray, size: int) -> np.ndarray:
    """Positions inside the groups that begin at ``starts``."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + GROUP, -1)
    return np.cumsum(change[:-1]) > 0


def fragments(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (begin, end) of ``words`` that can hold a run; ``owner`` numbers the text of each word."""
    n = len(words)
    if n < SHORTEST:
        return []
    at = np.flatnonzero(owner[: n - GROUP + 1] == owner[GROUP - 1 :])
    key = owner.astype(np.uint64)[at]
    for k in range(GROUP):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words.astype(np.uint64)[at + k]
    # Equal groups have equal keys; unequal ones that share a key only leave more to look at.
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    far = n + 1
    gap = np.full((2, len(at)), far, dtype=np.int64)
    steps = np.where(same, at[order][1:] - at[order][:-1], far)
    gap[0, order[1:]], gap[1, order[:-1]] = steps, steps
    nearest = gap.min(axis=0)
    at, nearest = at[nearest < far], nearest[nearest < far]
    while True:
        inside = covered(at, n)
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False) | np.diff(np.append(owner, -1), prepend=-1).astype(bool))
        edge = edge[edge <= n]
        begins, ends = edge[:-1], edge[1:]
        held = inside[begins] if len(begins) else np.empty(0, dtype=bool)
        begins, ends = begins[held], ends[held]
        size = (ends - begins)[np.searchsorted(begins, at, "right") - 1] if len(at) else at
        fits = (TIMES * nearest <= size) & (size >= SHORTEST)
        if fits.all():
            return [(b, e) for b, e in zip(begins.tolist(), ends.tolist()) if e - b >= SHORTEST]
        at, nearest = at[fits], nearest[fits]


def runs_in(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each text's words, by start, then period."""
    number = {w: k for k, w in enumerate(set(chain.from_iterable(texts)))}
    sizes = np.array(list(map(len, texts)), dtype=np.int64)
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=sizes.sum())
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    cut = fragments(words, owner)
    none = np.empty((0, 3), dtype=np.int64)
    if not cut:
        return [none] * len(texts)
    separators = len(cut) + 1
    _, symbols = np.unique(np.concatenate([words[b:e] for b, e in cut]), return_inverse=True)
    lengths = np.array([e - b for b, e in cut])
    begins = np.cumsum(lengths + 1) - lengths  # in the joined text, each after its separator
    joined = np.empty(lengths.sum() + separators, dtype=np.int64)
    joined[np.append(begins - 1, len(joined) - 1)] = np.arange(separators)
    joined[np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())] = symbols + separators
    runs = runs_of(joined, separators)
    piece = np.searchsorted(begins, runs[:, 0], "right") - 1
    place = runs[:, 0] - begins[piece] + np.array([b for b, _ in cut])[piece]
    text = owner[place]
    runs[:, 0] = place - first[text]
    order = np.lexsort((runs[:, 2], runs[:, 0], text))
    bounds = np.searchsorted(text[order], np.arange(len(texts) + 1))
    return [runs[order[a:b]] if a < b else none for a, b in zip(bounds, bounds[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by a space, without those of a run after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


# --- on Spark -------------------------------------------------------------------------------------------------------

RUNS = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))


def find(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: the runs of its text, and the text without their repeats, as UTF-8.
    ``prepare`` may change a row's words first, given its id."""
    schema = docs.select("doc_id").schema.add("runs", RUNS).add("collapsed", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [text.split() for text in raw_bytes(part.column(1))]  # at ASCII blanks, as bytes do
                if prepare:
                    texts = list(map(prepare, part.column(0).to_pylist(), texts))
                found = runs_in(texts)
                rows = np.concatenate([np.empty((0, 3), dtype=np.int64), *found])
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                names = ["start", "length", "period"]
                items = pa.StructArray.from_arrays([pa.array(rows[:, k].copy()) for k in range(3)], names)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(ends, items),
                        pa.array(map(collapsed, texts, found), pa.binary()),
                    ],
                    schema.names,
                )

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def repeated_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The contract's rewriting: of the texts whose crc32 ends in 0, the words from one place on repeat a period."""
    if doc_id is None or not words:
        return words
    g, digit = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if digit:
        return words
    n = len(words)
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    return [*words[:begin], *(words[begin + i % period] for i in range(n - begin))]


def report(docs: DataFrame) -> DataFrame:
    """The longest run, digests of all runs and of the collapsed text, one row per document."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    found = find(docs, repeated_tail).withColumn("longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(1000 * F.col("longest.n") / -F.col("longest.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
