"""A table laid out by row key: files hold ranges of keys, and a small list tells the first and last key of each.

A prefix opens the files whose range can hold it, mostly one or two, and no other. Ranges are sampled by row count, so a prefix
with very many rows lies in several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAST = "\U0010ffff"


def write_key_ranges(df: DataFrame, path: str, key: str = "row_key", files: int | None = None) -> None:
    """Writes ``df`` sorted by key into files of one range each, and their list beside them."""
    spread = F.xxhash64(*[c for c in df.columns if c != key]) if len(df.columns) > 1 else F.lit(0)
    # Rows of one key may be split too: a second sort key makes it a range.
    keyed = df.withColumn("__spread", spread)
    dealt = keyed.repartitionByRange(files, key, "__spread") if files else keyed.repartitionByRange(key, "__spread")
    dealt.sortWithinPartitions(key).drop("__spread").write.mode("overwrite").parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = spark.read.parquet(f"{path}/rows")
    listed = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("n_rows")
    )
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/files")


def files_with(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """The files whose range of keys can hold the prefix; a row a file is read for it."""
    listed = spark.read.parquet(f"{path}/files")
    hit = listed.where((F.col("last_key") >= prefix) & (F.col("first_key") <= prefix + LAST))
    return [r.file for r in hit.orderBy("first_key").select("file").collect()]


def prefix_rows(spark: SparkSession, path: str, prefix: str, limit: int | None = None, key: str = "row_key") -> DataFrame:
    """Rows whose key starts with ``prefix``, in key order, the first ``limit`` of them if given."""
    schema: T.StructType = spark.read.parquet(f"{path}/rows").schema
    files = files_with(spark, path, prefix)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    found = rows.where(F.startswith(F.col(key), F.lit(prefix))).orderBy(key)
    return found if limit is None else found.limit(limit)
