"""Writing tables: dated ledgers, appends, views and the read-back audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class AuditError(RuntimeError):
    """What was read back is not what was written."""


def row_checksum(columns: Sequence[str]) -> Column:
    """Order-free checksum of a table: the sum of its rows' hashes."""
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def _measures(columns: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"), row_checksum(columns).alias("checksum")]


def write_dated(df: DataFrame, path: str, by: str = "business_date", order: Sequence[str] = (), mode: str = "overwrite") -> dict:
    """Write a table partitioned by day and sorted for skipping; returns its row count, checksum and days.

    Only the days present are replaced, so running a day again is safe. Rows are brought together by day and
    rebalanced by size: a day that holds a third of the table is written by many tasks. The measures
    are taken in the writing stage, whose tasks Spark counts once even when they run again.
    """
    seen = Observation()
    laid_out = df.hint("rebalance", F.col(by)).sortWithinPartitions(by, *order)
    watched = laid_out.observe(seen, *_measures(sorted(df.columns)), F.collect_set(by).alias("days"))
    watched.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return seen.get


def audit_written(spark: SparkSession, path: str, columns: Sequence[str], written: dict, by: str = "business_date") -> dict:
    """Read the written days back and compare columns, row count and checksum; raises where they differ."""
    back = spark.read.parquet(path).filter(F.col(by).isin(list(written["days"])))
    if sorted(back.columns) != sorted(columns):
        raise AuditError(f"columns {sorted(back.columns)} instead of {sorted(columns)}")
    found = back.agg(*_measures(sorted(columns))).first().asDict()
    if found != {k: written[k] for k in found}:
        raise AuditError(f"read back {found}, wrote {written}")
    return found


def write_first(df: DataFrame, targets: Sequence[str], mode: str = "overwrite", dry_run: bool = False) -> str | None:
    """Write to the first target that takes the table: a path, or a catalog name. A dry run writes nothing."""
    if dry_run:
        return None
    refused = []
    for target in targets:
        try:
            if "/" in target:
                df.write.mode(mode).parquet(target)
            else:
                df.write.mode(mode).saveAsTable(target)
            return target
        except Exception as e:  # noqa: BLE001 - the next target may take it
            refused.append(f"{target}: {e}")
    raise RuntimeError("no target took the table: " + "; ".join(refused))


def create_table_as(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def insert_select(df: DataFrame, table: str) -> None:
    """Append by column name to an existing table."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_view(spark: SparkSession, name: str, text: str) -> None:
    """A view in the catalog, for all sessions; its text reads catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table does not hold yet."""
    spark = df.sparkSession
    try:
        held = spark.read.parquet(path).select(key)
    except Exception as e:  # noqa: BLE001 - no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        df.write.parquet(path)
        return
    df.join(held, key, "left_anti").write.mode("append").parquet(path)
