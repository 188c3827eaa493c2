import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aislewise.llm import listrank, trie
from aislewise.llm.ranges import running, salted_join

SF = "/root/testdata/sf0.001"


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    ordered = {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}
    out = {}
    for c, own in ordered.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = ordered.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute_force(rows):
    members = defaultdict(list)
    convs = rebuilt(rows)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[x] for x in children[node])
    return sorted(
        (
            min(own),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(own),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node)).encode()).hexdigest(),
        )
        for node, own in members.items()
    )


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def result(df):
    assert df.columns == list(COLUMNS)
    return sorted(tuple(r) for r in df.collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_rows(spark):
    draw = random.Random(5)
    data = []
    for c in [*range(0, 90), 10**15]:
        for t in range(draw.choice([0, 1, 2, 5, 9])):
            data.append((c, draw.choice([t, t, None]), draw.choice(["user", "assistant", None]), draw.choice(["", "a b", "a  b\tc", None])))
    data += data[:7]  # repeated rows
    data += [(None, 1, "user", "x"), (95, 0, "user", "w " * 5000)]
    docs = spark.createDataFrame(data, SCHEMA).withColumn("place", F.lit("extra")).withColumn("depth", F.lit(1)).repartition(5)
    assert result(trie.report(docs)) == brute_force(data)


def test_one_conversation_holds_a_third_and_all_share_a_node(spark):
    data = [(c, t, "user", "same") for c in range(300) for t in range(4)]
    data += [(301, t, "user", f"turn {t % 7}") for t in range(600)]
    data += [(c, t, "user", "same" if t < 4 else f"own {c}") for c in range(400, 600) for t in range(5)]
    assert result(trie.report(spark.createDataFrame(data, SCHEMA).repartition(6))) == brute_force(data)


def test_empty_tables(spark):
    assert result(trie.report(spark.createDataFrame([], SCHEMA))) == []
    assert result(trie.report(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))) == []


def test_digests_of_many_members_are_joined_from_strings(spark, monkeypatch):
    monkeypatch.setattr(trie, "JOINED", 7)
    ends = spark.createDataFrame([(c, c % 3 if c > 400 else 0, 0, 1) for c in range(500)], "conv_id long, hi long, lo long, depth long")
    got = {r.hi: r.ends_sha256 for r in trie.member_digests(ends).collect()}
    want = {h: hashlib.sha256(",".join(str(c) for c in range(500) if (c % 3 if c > 400 else 0) == h).encode()).hexdigest() for h in range(3)}
    assert got == want


@pytest.mark.parametrize("n,at_once", [(1, 100), (2, 1), (700, 10), (700, 1000)])
def test_list_rank(spark, n, at_once):
    order = random.Random(n).sample(range(5 * n), n)
    links = spark.createDataFrame([(a, b) for a, b in zip(order, [*order[1:], -1])], "id long, next long")
    places = {r.id: r.place for r in listrank.list_rank(links, max(at_once, 2)).collect()}
    assert places == {x: k for k, x in enumerate(order)}


def test_running_values_cross_ranges(spark):
    draw = random.Random(2)
    data = [(draw.choice([1, 1, 1, 2, 3]), draw.randrange(50), draw.randrange(9)) for _ in range(900)]
    df = spark.createDataFrame(data, "g long, o long, v long")
    got = [tuple(r) for r in running(df, ["g"], [F.col("o")], ["v"]).orderBy("place").collect()]
    total = last = 0
    for k, (g, o, v, place, follows, upto) in enumerate(got):
        total = total + v if g == last else v
        assert (place, follows, upto) == (k, g == last, total)
        last = g
    assert sorted(x[:3] for x in got) == sorted(data)


def test_salted_join_equals_a_join(spark):
    large = spark.createDataFrame([(1 if k % 2 else k, k) for k in range(4000)] + [(None, 5)] * 3, "k int, v int")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (8, "c"), (None, "d"), (-5, "e")], "k int, w string")
    for how in ("inner", "left"):
        key = lambda r: str(tuple(r))
        want = sorted(large.join(small, "k", how).collect(), key=key)
        assert sorted(salted_join(large, small, ["k"], how).collect(), key=key) == want


def test_query_equals_sql(against_sql):
    assert against_sql("op12_trie") == []


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    docs = spark.read.parquet(f"{SF}/conversations.parquet")
    assert result(trie.report(docs)) == brute_force(rows)
