"""Keep-latest deduplication and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = (), keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, NULL lowest, the other columns breaking ties.

    The row is the maximum of one struct, so every map task reduces its copies of a key before the
    shuffle. A key that owns a third of the table reaches its reducer as one row per map task, where
    a ``row_number`` window would bring all of its copies to a single task.
    """
    keep = [c for c in (keep or df.columns) if c not in keys]
    order = [c for c in newest_by if c in df.columns]
    ranked = order + sorted(c for c in keep if c not in order)
    best = F.max(F.struct(*[F.col(c) for c in ranked])).alias("best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*keys, *[F.col(f"best.{c}").alias(c) for c in keep])


def top_per_key(df: DataFrame, keys: Sequence[str], order, n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every key. Spark cuts each map task's rows to ``n`` before the shuffle."""
    from pyspark.sql import Window

    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(rank) <= n)


def duplicate_report(df: DataFrame, keys: Sequence[str], label: str = "table_name", name: str = "rows") -> DataFrame:
    """Rows, distinct keys, surplus rows, keys seen twice and three or more times, conflicting keys.

    Two levels of partial aggregation: identical payloads first, then their keys.
    """
    payload = [c for c in df.columns if c not in keys]
    variants = df.groupBy(*keys, *payload).agg(F.count(F.lit(1)).alias("copies"))
    per_key = variants.groupBy(*keys).agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("payloads")
    )
    return per_key.agg(
        F.sum("copies").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.col("copies") - 1).alias("surplus_rows"),
        F.count_if(F.col("copies") == 2).alias("keys_seen_twice"),
        F.count_if(F.col("copies") >= 3).alias("keys_seen_3_or_more"),
        F.count_if(F.col("payloads") > 1).alias("keys_with_conflicts"),
    ).select(F.lit(name).alias(label), "*")
