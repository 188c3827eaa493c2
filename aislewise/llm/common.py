"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.session import shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROW = "__row"
SLICE = 1_000_000  # bytes
BATCH = 8_000_000  # bytes


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else, whatever the locale."""
    return F.translate(column, ASCII_UPPER, ASCII_UPPER.lower())


def written(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder as Parquet and reads it back: lineage ends here, and later reads take only
    the columns they need. The files stay with the other checkpoints until that folder is cleaned."""
    path = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def private(name: str, taken: list[str]) -> str:
    """``name`` with so many underscores before it that no column is called so."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with its columns of these names renamed, and the columns that give all of ``df`` back afterwards."""
    own = {c: private(f"__{c}", df.columns) for c in df.columns if c.lower() in names}
    return df.withColumnsRenamed(own), [F.col(own.get(c, c)).alias(c) for c in df.columns]


def small_batches(spark: SparkSession) -> None:
    """From now on, this session hands Python workers batches of at most ``BATCH`` bytes. Each is held three times or more, by
    the executor, on its way and by the worker, for every task that runs; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def slices(batch: pa.RecordBatch, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Runs of the batch's rows of about ``size`` bytes, a longer row alone, so that few rows are Python objects at once."""
    weight = np.full(batch.num_rows, 50, dtype=np.int64)
    for column in batch.columns:
        kind = column.type
        if pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
            weight += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        elif batch.num_rows:
            weight += column.nbytes // batch.num_rows
    run = (np.cumsum(weight) - weight) // size
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        yield batch.slice(begin, end - begin)


def by_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Applies ``work`` to slices of each Arrow batch of each partition, bounded by their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield work(part)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def raw_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null gives no bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]
