"""Operator 12: the trie of conversation prefixes, with subtree sums by the Euler-tour technique.

A node is a distinct sequence of first turns. Its key is the sum of 128-bit hashes of (place, role, text) over its turns, in
four lanes; sums run over ranges of rows, so one conversation may span tasks, and the parent's key is the node's own
without its last turn. A node is also named by its smallest member and its depth, and numbered by its parent
and that member, so that siblings are neighbours.

The tour enters and exits every node once. The arc after an entry is the first child's entry, or the node's own exit;
after an exit, the next sibling's entry, or the parent's exit. This list is ranked by removing independent elements
(``listrank``), and sums of leaves and savings run over the places of the arcs: what a subtree holds is the difference
between its exit and its entry. No step walks down the trie, so depth costs no rounds, and no step groups all children
of a node: siblings are linked by order, and a child learns its parent's name by a salted join.

Digests of the members that end at a node need them in one stream. Ranges first join ids to strings of up to ``JOINED``
ids in parallel; a node's task only feeds those strings to the hash.

Defined results: turns are ordered by turn, null first, then role and text; null roles and texts are empty; rows without a
conversation id are in no conversation; repeated rows are turns of their own. An empty table gives no node, not even the
root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import SLICE, written
from aislewise.llm.listrank import NONE, list_rank
from aislewise.llm.ranges import running, salted_join

WORDS = r"[^\x20\x09-\x0D]+"
LANES = [f"lane{k}" for k in range(4)]
KEY = ["hi", "lo", "depth"]
JOINED = 4_096


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, turn_hash, words) of every turn of a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("turn_hash"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        F.lit(1).cast("long").alias("one"),
    )
    numbered = running(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ["one"])
    return numbered.select("conv_id", F.col("one_upto").alias("place"), "turn_hash", "words")


def shared_heads(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: the first turns of each come from the first of its twenty.

    Gives (conv_id, depth, turn_hash, words) of the turns, and (conv_id) of all conversations, turnless ones included.
    """
    turns = written(ordered_turns(conversations))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    base = F.col("conv_id") - F.col("conv_id") % 20
    members = written(turns.select("conv_id").distinct())
    wanted = members.select("conv_id", taken.alias("taken"), base.alias("base"))
    firsts = turns.where((F.col("conv_id") % 20 == 0) & (F.col("place") <= 3)).withColumnRenamed("conv_id", "base")
    # At most 20 conversations and 3 turns a base.
    heads = written(wanted.join(firsts, "base").where("place <= taken").select("conv_id", F.col("place").alias("depth"), "turn_hash", "words"))
    got = heads.groupBy("conv_id").agg(F.max("depth").alias("got"))
    short = wanted.join(got, "conv_id", "left").where(F.coalesce("got", F.lit(0)) < F.col("taken"))
    short = short.select("conv_id", (F.col("taken") - F.coalesce("got", F.lit(0))).alias("missing"))
    own = written(turns.where(F.col("place") > taken))
    own = salted_join(own, short, ["conv_id"], "left")
    own = own.select("conv_id", (F.col("place") - F.coalesce("missing", F.lit(0))).alias("depth"), "turn_hash", "words")
    return heads.unionByName(own), members


def key_of(*lanes: Column) -> tuple[Column, Column]:
    """Two longs from four sums of 32-bit lanes."""
    a, b, c, d = (lane.bitwiseAND(F.lit(0xFFFFFFFF)) for lane in lanes)
    return F.shiftleft(a, 32).bitwiseOR(b), F.shiftleft(c, 32).bitwiseOR(d)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, hi, lo, parent_hi, parent_lo, words): the node that each turn of a conversation leads to."""
    hashed = F.sha2(F.concat(F.col("turn_hash"), F.col("depth").cast("string").cast("binary")), 256)
    lanes = [F.conv(F.substring(hashed, 1 + 8 * k, 8), 16, 10).cast("long").alias(c) for k, c in enumerate(LANES)]
    summed = running(turns.select("conv_id", "depth", "words", *lanes), ["conv_id"], [F.col("depth")], LANES)
    hi, lo = key_of(*(F.col(f"{c}_upto") for c in LANES))
    parent_hi, parent_lo = key_of(*(F.col(f"{c}_upto") - F.col(c) for c in LANES))
    return summed.select(
        "conv_id", "depth", hi.alias("hi"), lo.alias("lo"), parent_hi.alias("parent_hi"), parent_lo.alias("parent_lo"), "words"
    )


def nodes_of(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(hi, lo, depth, conv_id, n_convs, words, parent_hi, parent_lo) of every node, the root too."""
    inner = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *(F.max(c).alias(c) for c in ("words", "parent_hi", "parent_lo")),
    )
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("hi"), zero.alias("lo"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("words"), zero.alias("parent_hi"), zero.alias("parent_lo")
    )
    return inner.select(*KEY, "conv_id", "n_convs", "words", "parent_hi", "parent_lo").unionByName(root)


def tour_sums(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, n_children, n_leaves, saved_tokens) of nodes given as (conv_id, depth, parent_conv_id, saved)."""
    nothing = F.lit(NONE).cast("long")
    # Siblings by descending member: the row before, if it follows the same parent, is the next sibling to be entered.
    keyed = nodes.select(
        "conv_id",
        "depth",
        "saved",
        F.coalesce("parent_conv_id", F.lit(0)).alias("up_conv"),
        (F.col("depth") - 1).alias("up_depth"),
    )
    placed = written(running(keyed, ["up_depth", "up_conv"], [F.col("conv_id").desc()]))
    children = placed.where("depth > 0").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth"))
    children = children.agg(F.count("*").alias("n_children"), F.max("place").alias("eldest"), F.min("place").alias("youngest"))
    placed = written(placed.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    # Arc 2n enters node n, arc 2n + 1 exits it.
    enter, exit_ = F.col("place") * 2, F.col("place") * 2 + 1
    entered = placed.select(enter.alias("id"), F.coalesce(F.col("eldest") * 2, exit_).alias("next"))
    to_sibling = placed.where("follows AND depth > 0").select(exit_.alias("id"), ((F.col("place") - 1) * 2).alias("next"))
    to_parent = placed.where("n_children > 0").select((F.col("youngest") * 2 + 1).alias("id"), exit_.alias("next"))
    ended = placed.where("depth = 0").select(exit_.alias("id"), nothing.alias("next"))
    arcs = list_rank(written(entered.unionByName(to_sibling).unionByName(to_parent).unionByName(ended)))
    own = placed.select(enter.alias("id"), (F.col("n_children") == 0).cast("long").alias("leaf"), "saved")
    valued = arcs.withColumnRenamed("place", "at").join(own, "id", "left").fillna(0, ["leaf", "saved"])
    summed = running(valued, [], [F.col("at")], ["leaf", "saved"])
    # Up to its exit, less up to its entry, and its own: sums only grow along the tour.
    inside = summed.groupBy(F.shiftright("id", 1).alias("place")).agg(
        *((F.max(f"{c}_upto") - F.min(f"{c}_upto") + F.max(c)).alias(n) for c, n in (("leaf", "n_leaves"), ("saved", "saved_tokens")))
    )
    return placed.join(inside, "place").select("conv_id", "depth", "n_children", "n_leaves", "saved_tokens")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def in_batches(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of numbers that end in a text, as batches of about a megabyte."""
    held, size = [], 0
    for row in itertools.chain(rows, [None]):
        if row is not None:
            held.append(row)
            size += 40 + len(row[-1])
        if held and (row is None or size >= SLICE):
            *numbers, texts = zip(*held)
            yield pa.RecordBatch.from_arrays([*(pa.array(n, pa.int64()) for n in numbers), pa.array(texts, pa.string())], names)
            held, size = [], 0


def member_digests(ends: DataFrame) -> DataFrame:
    """(hi, lo, depth, ends_sha256) of the nodes at which members end, given (conv_id, hi, lo, depth)."""

    def strings_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, ids = None, []
        for conv, *k in rows:
            if ids and (k != key or len(ids) == JOINED):
                yield *key, ids[0], ",".join(map(str, ids))
                ids = []
            key = k
            ids.append(conv)
        if ids:
            yield *key, ids[0], ",".join(map(str, ids))

    def hashes_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, state = None, None
        for ids, *k in rows:
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                yield *key, state.hexdigest()
            key, state = k, hashlib.sha256(ids.encode())
        if key is not None:
            yield *key, state.hexdigest()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(strings_of(rows_of(batches, "conv_id", *KEY)), [*KEY, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(hashes_of(rows_of(batches, "ids", *KEY)), [*KEY, "ends_sha256"])

    kinds = "hi long, lo long, depth long"
    ranged = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    strings = ranged.mapInArrow(joined, f"{kinds}, first long, ids string")
    # Rows of up to JOINED ids each: a common node's task reads few of them.
    return strings.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, f"{kinds}, ends_sha256 string")


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row per node of conversations given as (conv_id, depth, turn_hash, words), depths from 1 without gaps."""
    rows = written(prefixes(turns))
    nodes = written(nodes_of(rows, members))
    named = nodes.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    nodes = written(salted_join(nodes, named, ["parent_hi", "parent_lo", "depth"], "left"))
    sums = tour_sums(nodes.select("conv_id", "depth", "parent_conv_id", ((F.col("n_convs") - 1) * F.col("words")).alias("saved")))
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), "depth").alias("end"))
    ends = members.join(last, "conv_id", "left")
    ends = ends.select("conv_id", *(F.coalesce(f"end.{c}", F.lit(0)).cast("long").alias(c) for c in KEY))
    nodes = nodes.join(member_digests(ends), KEY, "left").join(sums, ["conv_id", "depth"])
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def report(conversations: DataFrame) -> DataFrame:
    """The trie of the contract's conversations."""
    return trie(*shared_heads(conversations))
