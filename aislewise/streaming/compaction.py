"""Keeping stream tables small: one bucket at a time is rewritten into a generation of few files.

Streams write ``salt=../batch_id=..`` folders, some per batch, for ever. A compaction reads a bucket up to a batch, drops expired
rows and old versions, and writes the rest as the generation ``salt=../upto=..`` beside the table. The generation counts from the
moment its success mark exists; readers take the newest one of each bucket and only later batches. So a batch that is written
meanwhile is never touched, and a job that stops between any two steps leaves a table that reads the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Rewrite = Callable[[DataFrame], DataFrame]


class Folders:
    """Names of folders on whatever file system a path lies."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def values(self, path: str, name: str) -> Iterator[int]:
        """The numbers in folders called ``name=number``."""
        if self.exists(path):
            for status in self.fs.listStatus(self.path(path)):
                folder = status.getPath().getName()
                if status.isDirectory() and folder.startswith(f"{name}="):
                    yield int(folder.split("=", 1)[1])

    def names(self, path: str, name: str) -> Iterator[str]:
        if self.exists(path):
            for status in self.fs.listStatus(self.path(path)):
                folder = status.getPath().getName()
                if status.isDirectory() and folder.startswith(f"{name}="):
                    yield folder.split("=", 1)[1]

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def generations(path: str) -> str:
    return f"{path.rstrip('/')}_generations"


def newest_generations(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch that each bucket's newest whole generation covers."""
    folders, root = Folders(spark, path), generations(path)
    out = {}
    for salt in folders.names(root, "salt"):
        whole = [b for b in folders.values(f"{root}/salt={salt}", "upto") if folders.exists(f"{root}/salt={salt}/upto={b}/_SUCCESS")]
        if whole:
            out[salt] = max(whole)
    return out


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows: each bucket's newest generation, and the batches after it. Filters on folders prune both."""
    covered, root = newest_generations(spark, path), generations(path)
    parts = []
    folders = Folders(spark, path)
    written = ((salt, b) for salt in folders.names(path, "salt") for b in folders.values(f"{path}/salt={salt}", "batch_id"))
    found = next(written, None)
    if found is not None:
        schema = spark.read.parquet(f"{path}/salt={found[0]}/batch_id={found[1]}").schema
        # Salts are text, also where all that there are look like numbers.
        batches = spark.read.schema(schema.add("salt", "string").add("batch_id", "long")).parquet(path)
        later = F.lit(True)
        for salt, upto in covered.items():
            later = later & ((F.col("salt") != salt) | (F.col("batch_id") > upto))
        parts.append(batches.where(later).drop("batch_id"))
    for salt, upto in covered.items():
        parts.append(spark.read.parquet(f"{root}/salt={salt}/upto={upto}").withColumn("salt", F.lit(salt)))
    if not parts:
        raise FileNotFoundError(path)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compact_bucket(spark: SparkSession, path: str, salt: str, rewrite: Rewrite, rows_a_file: int = 1_000_000) -> None:
    """Writes the next generation of a bucket from its rows so far, then deletes what it replaces."""
    folders, root = Folders(spark, path), generations(path)
    batches = sorted(folders.values(f"{path}/salt={salt}", "batch_id"))
    covered = newest_generations(spark, path).get(salt, -1)
    if not batches and covered < 0:
        return
    upto = max([covered, *batches])
    if upto > covered:
        fresh = [b for b in batches if covered < b <= upto]
        rows = spark.read.parquet(*(f"{path}/salt={salt}/batch_id={b}" for b in fresh))
        if covered >= 0:
            rows = rows.unionByName(spark.read.parquet(f"{root}/salt={salt}/upto={covered}"))
        # A generation that a stopped job began has no success mark and is written over.
        kept = rewrite(rows).hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", rows_a_file)
        kept.parquet(f"{root}/salt={salt}/upto={upto}")
    clean(spark, path, salt, upto)


def clean(spark: SparkSession, path: str, salt: str, upto: int) -> None:
    """Deletes the batches and generations that the whole generation ``upto`` replaces. Readers no longer look at them, so it
    can be stopped and repeated; run it when no reader is older than the generation."""
    folders, root = Folders(spark, path), generations(path)
    for b in list(folders.values(f"{path}/salt={salt}", "batch_id")):
        if b <= upto:
            folders.delete(f"{path}/salt={salt}/batch_id={b}")
    for b in list(folders.values(f"{root}/salt={salt}", "upto")):
        if b < upto:
            folders.delete(f"{root}/salt={salt}/upto={b}")


def compact_table(spark: SparkSession, path: str, rewrite: Rewrite, rows_a_file: int = 1_000_000) -> None:
    """Compacts every bucket, one after another. ``rewrite`` keeps the wanted rows of a bucket (``sales.compact``); all rows of
    a key must lie in one bucket."""
    folders = Folders(spark, path)
    for salt in sorted({*folders.names(path, "salt"), *folders.names(generations(path), "salt")}):
        compact_bucket(spark, path, salt, rewrite, rows_a_file)
