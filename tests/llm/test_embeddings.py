import math

import numpy as np
import pytest

from aislewise.llm import embeddings
from aislewise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def usable(r):
        v = r[1]
        return r[2] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    units = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) if usable(r) else None for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is None or units[j] is None or rows[i][2] != rows[j][2] or len(units[i]) != len(units[j]):
                continue
            if rows[i][1] == rows[j][1] or units[i] @ units[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], links[i], least.get(find(i)), r[0] == least.get(find(i))) for i, r in enumerate(rows)), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def clusters(seed, groups, size, noise, width=16):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = rng.normal(size=width)
        rows += [(len(rows) + i, (base + rng.normal(scale=noise, size=width)).tolist(), g % 3) for i in range(size)]
    return rows


def as_floats(rows):
    return [(a, None if v is None else [None if x is None else float(np.float32(x)) for x in v], b) for a, v, b in rows]


@pytest.mark.parametrize("chunk", [1_000, 7])
def test_groups_of_near_vectors(spark, chunk):
    rows = as_floats(clusters(1, 6, 25, 0.03) + [(900 + i, [1.0] * 16, 1) for i in range(9)])
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(embeddings.near_duplicates(df, chunk=chunk)) == brute(rows)


def test_query_against_brute_force(spark, tmp_path):
    """The table with near copies of a fifth of its rows: at least 0.9 of the true links and none besides."""
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [tuple(r) for r in table.collect()]
    rng = np.random.default_rng(8)
    for k, (_, v, label) in enumerate(rows[::5]):
        v = np.array(v)
        for i in range(1 + k % 4):
            noise = rng.normal(size=len(v)) * np.linalg.norm(v) / np.sqrt(len(v))
            rows.append((10_000 + 10 * k + i, (v + noise * rng.uniform(0.02, 0.2)).tolist(), label))
    rows = as_floats(rows)
    spark.createDataFrame(rows, table.schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    want = {}
    for label in {r[2] for r in rows}:
        ids, vectors = zip(*[(r[0], r[1]) for r in rows if r[2] == label])
        units = embeddings.unit(np.array(vectors, dtype=np.float64))
        want |= dict(zip(ids, ((units @ units.T >= 0.98).sum(axis=1) - 1).tolist()))
    links = {r[0]: r[1] for r in got(QUERIES["op9_embeddings"](spark, str(tmp_path)))}
    assert links.keys() == want.keys() and all(links[k] <= want[k] for k in want)
    assert sum(links.values()) >= 0.99 * sum(want.values()) > 100


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    a = embeddings.unit(rng.normal(size=(4000, 64)))
    b = rng.normal(size=(4000, 64))
    b = embeddings.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    near = 0.98 * a + math.sqrt(1 - 0.98**2) * b
    x, y = (embeddings.codes(v, embeddings.TABLES, embeddings.BITS) for v in (a, near))
    assert (x == y).any(axis=1).mean() > 0.99


def test_cases(spark):
    one = [1.0, 2.0]
    rows = [
        (1, one, 0), (2, one, 0), (3, [2.0, 4.0], 0), (4, one, 1), (5, one, None), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0], 0), (9, [None, 1.0], 0), (10, [float("nan"), 1.0], 0), (11, [float("inf"), 1.0], 0),
        (12, [1e30, 2e30], 0), (13, [1e-30, 2e-30], 0), (14, [1.0, 2.0, 0.0], 0), (None, one, 0), (None, [5.0, -1.0], 0),
        (15, [-0.0, 1.0], 2), (16, [0.0, 1.0], 2), (17, [0.5, 1.0], 2), (17, [0.5, 1.0], 2),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", no int, codes string")
    assert got(embeddings.near_duplicates(df)) == brute(as_floats(rows))


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
