import random

from pyspark.sql import functions as F

from aislewise.operators import graph


def brute(starts, edges, onward, ends, low, high):
    out, frontier = [], [(s, s, ()) for s in starts]
    for length in range(1, high + 1):
        taken = edges if length == 1 else onward
        frontier = [(s, d, (*p, e)) for s, at, p in frontier for e, src, d in taken if src == at]
        if length >= low:
            out += [(s, at, p) for s, at, p in frontier if at in ends]
    return out


def frames(spark, starts, edges, onward, ends):
    kinds = "edge_id int, src int, dst int"
    node = lambda x: spark.createDataFrame([(v,) for v in x], "id int")
    return node(starts), spark.createDataFrame(edges, kinds), spark.createDataFrame(onward, kinds), node(ends)


def test_random_walks_and_their_counts(spark):
    draw = random.Random(6)
    for low, high in ((1, 3), (2, 3), (3, 3), (1, 1)):
        edges = [(k, draw.randrange(6), draw.randrange(6)) for k in range(14)]
        onward = [(k, draw.randrange(6), draw.randrange(6)) for k in range(9)]
        starts, ends = [0, 1, 2], [3, 4]
        s, e, o, t = frames(spark, starts, edges, onward, ends)
        want = brute(starts, edges, onward, ends, low, high)
        got = [(r.start_id, r.end_id, tuple(x.edge_id for x in r.path)) for r in graph.walks(s, e, t, low, high, onward=o).collect()]
        assert sorted(got) == sorted(want)
        counts = {(r.start_id, r.end_id, r.hops): r.walks for r in graph.walk_counts(s, e, t, low, high, onward=o).collect()}
        expected = {}
        for a, b, p in want:
            expected[a, b, len(p)] = expected.get((a, b, len(p)), 0) + 1
        assert counts == expected


def test_dead_ends_are_not_walked(spark):
    """One chain leads to the end; a hundred others lead nowhere."""
    edges = [(0, 0, 1), (1, 1, 2), (2, 2, 3)] + [(10 + k, 0, 100 + k) for k in range(100)] + [(200 + k, 1, 300 + k) for k in range(100)]
    s, e, _, t = frames(spark, [0], edges, [(0, 0, 0)], [3])
    live = [{r.id for r in x.collect()} for x in graph.reaching(t, e, e, 3, 3)]
    assert live == [{1}, {2}, {3}]
    first = e.join(graph.reaching(t, e, e, 3, 3)[0].withColumnRenamed("id", "dst"), "dst", "left_semi")
    assert first.where(F.col("src") == 0).count() == 1
    assert [r.path_json.count("edge_id") for r in graph.walks(s, e, t, 3, 3).collect()] == [3]


def test_path_text_without_arrays(spark):
    """The text is that of the path, and asked for alone it comes from text, not from arrays made for every walk."""
    edges = [(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 2, 3), (None, 3, 3)]
    found = graph.walks(*(frames(spark, [0], edges, edges, [1, 3])[k] for k in (0, 1, 3)), 1, 3)
    rows = found.select("hops", "path_json", F.to_json("path").alias("text"), F.size("path").alias("n")).collect()
    assert sorted(r.hops for r in rows) == [1, 2, 2, 3, 3]
    assert all(r.path_json == r.text and r.hops == r.n for r in rows)
    plan = found.drop("path")._jdf.queryExecution().optimizedPlan().toString()
    assert "array(" not in plan
