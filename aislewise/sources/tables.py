"""Reading warehouse tables: ordered candidates, pushed filters, prefix scans and probes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.functions.time import date_range


def canonical_name(name: str, default_dataset: str | None = None) -> str:
    """``project:dataset.table`` and ``project.dataset.table`` become one multi-part identifier.

    Parts Spark would not parse, such as names with a dash, are quoted.
    """
    parts = [p for p in name.strip().strip("`").replace(":", ".").replace("`", "").split(".") if p]
    if len(parts) == 1 and default_dataset:
        parts = [*default_dataset.split("."), *parts]
    return ".".join(p if p.replace("_", "a").isalnum() else f"`{p}`" for p in parts)


def read_table(
    spark: SparkSession, candidates: Sequence[str], columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """The first candidate that exists: a path (``/``, ``scheme://``) or a catalog table of any format.

    Columns and filter are given to Spark as such, so they reach the scan of parquet and of
    connector tables alike.
    """
    missing = []
    for name in candidates:
        try:
            df = spark.read.parquet(name) if "/" in name else spark.table(canonical_name(name))
            df.schema  # noqa: B018 - resolves the name now, without a job
        except AnalysisException as e:
            missing.append(f"{name}: {e.getCondition()}")
            continue
        df = df if where is None else df.filter(where)
        return df if columns is None else df.select(*columns)
    raise RuntimeError("no candidate table could be read: " + "; ".join(missing))


@dataclass(frozen=True)
class Sources:
    pos: DataFrame
    inventory: DataFrame
    stores: DataFrame


def read_sources(
    spark: SparkSession,
    pos: Sequence[str],
    inventory: Sequence[str],
    stores: Sequence[str],
    start_date: str | None = None,
    until_date: str | None = None,
) -> Sources:
    """The three inputs of the nightly ledger; only the sales are limited by date.

    ISO text sorts like the date it spells, so the range is compared in the column's own type and stays a
    partition or row-group filter.
    """
    sales = read_table(spark, pos)
    kind = sales.schema["business_date"].dataType.simpleString()
    return Sources(
        sales.filter(date_range(F.col("business_date"), start_date, until_date, kind)),
        read_table(spark, inventory),
        read_table(spark, stores),
    )


def prefix_scan(df: DataFrame, prefix: str, limit: int, key: str = "row_key") -> DataFrame:
    """Rows whose key starts with a prefix, in key order, up to a limit. ``_`` and ``%`` are plain characters."""
    return df.filter(F.startswith(F.col(key), F.lit(prefix))).orderBy(key).limit(limit)


def is_readable(df: DataFrame, rows: int = 10) -> bool:
    """A bounded read that proves a remote table answers."""
    return df.limit(rows).count() >= 1


def bound_sql(spark: SparkSession, text: str, **values) -> DataFrame:
    """SQL with named parameters; values are bound, never pasted."""
    return spark.sql(text, args=values)
