"""Operator 9: near-duplicate embeddings by random-hyperplane signs in several tables.

Equal vectors with equal labels are one class, so copies are never compared. A class gets a code per table: the signs of
its products with ``BITS`` random hyperplanes. Classes of one label that share a code in some table are compared by
cosine in double precision. Two vectors at cosine 0.98 differ in a sign with probability 0.064, so they share none of
24 codes of 20 bits about once in 1,700 pairs; more similar ones more rarely.

A pair that shares several codes is compared in each, but counted in the first table only, which both classes' codes
tell. A bucket is cut into chunks of at most ``CHUNK`` classes by hash, and each pair of chunks is one group: a bucket that
holds a third of all rows is many groups of bounded size. Groups return one row per class (its number of links, and one
link that joins it to the rest of its component in the group), never pairs, so the output grows with the classes.

Components of the links come from alternating star steps.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and vectors with a null
label, link with nothing. Vectors of different lengths are not compared. Each row is its own vector, repeated rows
included; they are copies, with cosine 1. A component's id is its smallest non-null vec_id; rows with a null id get the
id of their component, or null; ``kept`` is whether the row's id is that id, nulls being equal. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import written
from aislewise.llm.components import components
from aislewise.llm.ranges import salted_join

TABLES, BITS = 24, 20
COSINE = 0.98
CHUNK = 500


def hyperplanes(width: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([20_240_602, width]).normal(size=(width, tables * bits))


def codes(vectors: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """The sign code of each vector in each table."""
    signs = (vectors @ hyperplanes(vectors.shape[1], tables, bits) > 0).reshape(len(vectors), tables, bits)
    return (signs.astype(np.int64) << np.arange(bits)).sum(axis=2).astype("<i4")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled by their largest component first so that squares neither vanish nor overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def with_codes(classes: DataFrame, tables: int, bits: int) -> DataFrame:
    """``classes`` (no, label, vector) with the packed codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector")).to_pylist()
            packed: list[bytes] = [b""] * len(vectors)
            widths = np.array([len(v) for v in vectors])
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                block = unit(np.array([vectors[i] for i in at], dtype=np.float64))
                for i, row in zip(at.tolist(), codes(block, tables, bits)):
                    packed[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary())], [*batch.schema.names, "codes"])

    return classes.mapInArrow(run, classes.withColumn("codes", F.lit(b"")).schema)


def compare(group: pd.DataFrame, diagonal: bool, table: int) -> pd.DataFrame:
    """Links within one pair of chunks: per class its links and copies linked, and one neighbour (or itself)."""
    vectors = unit(np.array(group["vector"].tolist(), dtype=np.float64))
    keys = np.array([np.frombuffer(c, dtype="<i4")[:table] for c in group["codes"]]).reshape(len(group), table)
    left = (group["side"] != 2).to_numpy().nonzero()[0]
    right = left if diagonal else (group["side"] != 1).to_numpy().nonzero()[0]
    near = vectors[left] @ vectors[right].T >= COSINE
    a, b = np.nonzero(near)
    a, b = left[a], right[b]
    keep = (a < b) if diagonal else np.ones(len(a), dtype=bool)
    a, b = a[keep], b[keep]
    if table:  # counted in an earlier table if the two share a code there
        new = ~(keys[a] == keys[b]).any(axis=1)
        a, b = a[new], b[new]
    copies, no = group["copies"].to_numpy(), group["no"].to_numpy()
    links = np.zeros(len(group), dtype=np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    # A forest of the links: each class points to its root in the group.
    root = np.arange(len(group))
    for i, j in zip(a.tolist(), b.tolist()):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        while root[j] != j:
            root[j] = root[root[j]]
            j = root[j]
        root[max(i, j)] = min(i, j)
    for i in range(len(root)):
        root[i] = root[root[i]]
    out = pd.DataFrame({"no": no, "linked": links, "root": no[root]})
    return out[links > 0]


def near_duplicates(vectors: DataFrame, tables: int = TABLES, bits: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label)."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", "label", vector.alias("vector"))
    # Adding 0.0 makes a negative zero a zero: equal vectors get equal texts.
    exact = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.select("vec_id", "label", F.when(usable, exact).alias("vector"))
    # Equal vectors with equal labels are told by 256 bits instead of by all their components.
    digest = F.unhex(F.sha2(F.to_json(F.struct("label", "vector")), 256))
    rows = written(rows.withColumn("class", F.when(F.col("vector").isNotNull(), digest)))

    classes = rows.where("class IS NOT NULL").groupBy("class")
    classes = classes.agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("first_id"), F.count("*").alias("copies")
    )
    classes = written(with_codes(classes.withColumn("no", F.monotonically_increasing_id()), tables, bits))

    # The label's hash is only a key; a collision is ruled out by comparing labels in the group key.
    code = lambda i: F.substr("codes", i * 4 + 1, F.lit(4))
    in_tables = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), code)).alias("t", "code")
    width = F.size("vector").alias("width")
    key = ["label", "width", "t", "code"]
    placed = classes.select("no", "label", width, in_tables)
    chunks = F.ceil(F.col("size") / F.lit(chunk)).cast("int").alias("chunks")
    shared = placed.groupBy(*key).agg(F.count("*").alias("size")).where("size > 1").select(*key, chunks)
    mine = F.pmod(F.xxhash64("no", "t"), F.col("chunks")).cast("int")
    # A class of chunk c goes to the pairs (c, d) for all d: as the first side if c < d, else as the second.
    spread = placed.join(shared, key).withColumn("mine", mine)
    spread = spread.select("no", *key, "mine", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    spread = spread.select(
        "no", *key, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), side.alias("side")
    )
    members = spread.join(classes.select("no", "vector", "codes", "copies"), "no")

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return compare(group, bool(key[4] == key[5]), int(key[2]))

    found = members.groupBy(*key, "i", "j").applyInPandas(run, "no long, linked long, root long")
    found = written(found.groupBy("no", "root").agg(F.sum("linked").alias("linked")))
    linked = found.groupBy("no").agg(F.sum("linked").cast("long").alias("linked"))
    grouped = components(found.select(F.col("no").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "no")

    named = classes.join(linked, "no", "left").join(grouped, "no", "left")
    named = named.withColumn("component", F.coalesce("component", "no"))
    least = named.groupBy("component").agg(F.min("first_id").alias("least_id"))
    of_class = named.join(least, "component").select(
        "class", "least_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("least_id"))
    # A class of very many copies is one key: its rows are dealt out by a number besides.
    return salted_join(rows.select("vec_id", "class"), of_class, ["class"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
