"""An inverted file over vectors: cells round the centres of a k-means, of which a search opens only the nearest.

``build`` trains the coarse quantiser on all vectors with Spark's distributed k-means, gives every vector to its nearest
centre and writes the table partitioned by cell. ``search`` compares a query with the centres, opens the partitions of its
nearest cells and ranks their rows exactly. What is read grows with the cells opened, not with the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.operators.dedup import top_per_key
from aislewise.operators.search import BROADCAST_BYTES, RANK_DIGITS, _unit_rows
from aislewise.session import cut_lineage

# The centres go to every task: at most so many cells of 8 bytes a dimension, whatever the table.
MOST_CELLS = 4_096
ROWS_A_CELL = 4_000
ITERATIONS = 8


@dataclass(frozen=True)
class VectorIndex:
    """Where the cells and their centres are, which columns identify a row, and the vector's column."""

    path: str
    keys: tuple[str, ...]
    vector: str

    @property
    def cells(self) -> str:
        return f"{self.path}/cells"

    @property
    def centres(self) -> str:
        return f"{self.path}/centres"

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.cells)

    def matrix(self, spark: SparkSession) -> np.ndarray:
        """The centres, at most ``MOST_CELLS`` rows."""
        return np.array([r.centre for r in spark.read.parquet(self.centres).orderBy("cell").collect()], dtype=float)


def _usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows with a direction: a vector that is not null and not all zero."""
    return vectors.where(F.col(vector).isNotNull() & F.exists(F.col(vector), lambda x: x != 0))


def _features(vector: str) -> F.Column:
    return array_to_vector(F.col(vector).cast("array<double>"))


def build(vectors: DataFrame, path: str, keys: Sequence[str], vector: str = "embedding", cells: int | None = None, seed: int = 11) -> VectorIndex:
    """Trains the centres on all rows and writes each row into its cell. A large cell is written by several tasks."""
    spark = vectors.sparkSession
    index = VectorIndex(path, tuple(keys), vector)
    rows = _usable(vectors, vector).select(*keys, vector)
    if cells is None:
        cells = math.ceil(rows.count() / ROWS_A_CELL)
    cells = max(2, min(cells, MOST_CELLS))
    featured = rows.withColumn("features", _features(vector))
    trained = featured.select("features").persist()
    try:
        if trained.isEmpty():
            raise ValueError("there is no vector to index")
        model = KMeans(k=cells, seed=seed, maxIter=ITERATIONS, distanceMeasure="cosine", predictionCol="cell").fit(trained)
    finally:
        trained.unpersist()
    centres = [(k, [float(x) for x in c]) for k, c in enumerate(model.clusterCenters())]
    spark.createDataFrame(centres, "cell int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(index.centres)
    add(index, rows, model, mode="overwrite")
    return index


def add(index: VectorIndex, vectors: DataFrame, model, mode: str = "append") -> None:
    """Writes rows into their cells; the centres stay as they are."""
    placed = model.transform(_usable(vectors, index.vector).select(*index.keys, index.vector).withColumn("features", _features(index.vector)))
    placed.drop("features").hint("rebalance", F.col("cell")).write.mode(mode).partitionBy("cell").parquet(index.cells)


def nearest_cells(index: VectorIndex, queries: DataFrame, vector: str, probes: int) -> DataFrame:
    """``queries`` with ``probes``: the numbers of each query's nearest cells."""
    spark = queries.sparkSession
    sent = spark.sparkContext.broadcast(_unit_rows(index.matrix(spark)))
    schema = T.StructType([*queries.schema.fields, T.StructField("probes", T.ArrayType(T.IntegerType()))])
    at = queries.columns.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sent.value
        step = max(1, (4 << 20) // len(centres))
        for batch in (b.slice(s, step) for b in batches for s in range(0, b.num_rows, step)):
            near = _unit_rows(np.array(batch.column(at).to_pylist(), dtype=float)) @ centres.T
            first = np.argsort(-near, axis=1, kind="stable")[:, :probes].astype(np.int32)
            ends = pa.array(np.arange(len(first) + 1, dtype=np.int32) * first.shape[1])
            probed = pa.ListArray.from_arrays(ends, pa.array(first.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, probed], schema.names)

    return queries.mapInArrow(run, schema)


def search(
    index: VectorIndex,
    queries: DataFrame,
    top_k: int = 3,
    probes: int = 8,
    query_id: str = "query_id",
    vector: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``top_k`` rows nearest to each query among those of its ``probes`` nearest cells, ranked by exact distance.

    Queries go to the tasks in blocks of a checked size, as in ``vector_search``; a block's cells are the partitions that its
    scan opens. A task gives out at most ``top_k`` rows a query. With all cells probed the result is exact.
    """
    spark = queries.sparkSession
    asked = _usable(queries, vector).select(F.col(query_id).alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
    asked = cut_lineage(nearest_cells(index, asked, "v", probes))
    size = asked.agg(F.sum(8 * F.size("v") + 4 * F.size("probes"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * size / broadcast_bytes))
    table = index.rows(spark)
    schema = T.StructType([asked.schema["query_id"], *(table.schema[k] for k in index.keys), T.StructField("distance", T.DoubleType())])
    found = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)) == b).toArrow()
        opened = sorted(set(rows.column("probes").combine_chunks().flatten().to_pylist()))
        sent = spark.sparkContext.broadcast(_block(rows))
        # The list of cells is a partition filter: other folders are not listed or read.
        pool = table.where(F.col("cell").isin(opened)).select(*index.keys, index.vector, "cell")

        def run(batches, sent=sent):
            return _ranked(batches, *sent.value, index, top_k)

        best = top_per_key(pool.mapInArrow(run, schema), ["query_id"], ["distance", *index.keys], top_k)
        found.append(cut_lineage(best.withColumn("similarity_score", F.round(1.0 - F.col("distance"), 4))))
        sent.unpersist()
    return reduce(DataFrame.unionByName, found)


def _block(rows: pa.Table) -> tuple[pa.Array, np.ndarray, dict[int, np.ndarray]]:
    """Query ids, unit vectors, and the queries that probe each cell."""
    vectors = rows.column("v").to_pylist()
    matrix = np.array(vectors, dtype=float).reshape(rows.num_rows, len(vectors[0]) if vectors else 0)
    probed = rows.column("probes").to_pylist()
    of_cell: dict[int, list[int]] = {}
    for q, cells in enumerate(probed):
        for c in cells:
            of_cell.setdefault(c, []).append(q)
    ids = rows.column("query_id").combine_chunks()
    return ids, _unit_rows(matrix), {c: np.array(q) for c, q in of_cell.items()}


def _ranked(batches, ids: pa.Array, matrix: np.ndarray, of_cell: dict[int, np.ndarray], index: VectorIndex, top_k: int):
    """Each query's best rows of a task, given out at its end; of a run of rows, only those that can be among them."""
    keys = list(index.keys)
    names = ["q", *keys, "distance"]
    order = [("q", "ascending"), ("distance", "ascending"), *((k, "ascending") for k in keys)]
    held, floor = None, np.full(len(matrix), np.inf)
    for batch in batches:
        cells = batch.column("cell").to_numpy(zero_copy_only=False)
        for cell in np.unique(cells).tolist():
            own, asking = np.flatnonzero(cells == cell), of_cell[cell]
            step = max(1, (4 << 20) // len(asking))
            for part in (batch.take(pa.array(own[s : s + step])) for s in range(0, len(own), step)):
                values = np.array(part.column(index.vector).to_pylist(), dtype=float)
                distance = np.round(1.0 - matrix[asking] @ _unit_rows(values).T, RANK_DIGITS)
                last = floor[asking]
                if part.num_rows >= top_k:
                    last = np.minimum(last, np.partition(distance, top_k - 1, axis=1)[:, top_k - 1])
                q, r = np.nonzero(distance <= last[:, None])
                new = pa.table([pa.array(asking[q]), *(part.column(k).take(pa.array(r)) for k in keys), pa.array(distance[q, r])], names=names)
                held = pa.concat_tables([held, new]) if held is not None else new
                held = held.take(pc.sort_indices(held, sort_keys=order, null_placement="at_start"))
                of = held.column("q").to_numpy()
                place = np.arange(len(of)) - np.searchsorted(of, of)
                held = held.filter(pa.array(place < top_k))
                full = place[place < top_k] == top_k - 1
                floor[of[place < top_k][full]] = held.column("distance").to_numpy()[full]
    for part in held.to_batches(max_chunksize=10_000) if held is not None else ():
        yield pa.RecordBatch.from_arrays(
            [ids.take(part.column("q")), *(part.column(k) for k in keys), part.column("distance")],
            names=["query_id", *keys, "distance"],
        )


def recall(found: DataFrame, exact: DataFrame, keys: Sequence[str], query_id: str = "query_id") -> DataFrame:
    """(query_id, wanted, hits): how many rows of an exact search an index search found, by query."""
    hit = found.select(query_id, *keys).withColumn("_hit", F.lit(1))
    return exact.join(hit, [query_id, *keys], "left").groupBy(query_id).agg(
        F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("hits")
    )
