"""Column profiles from sketches that are stored per day and merged, so that a new day costs one day.

A day's row for a column holds its rows, NULLs and range, a HyperLogLog sketch of its values and, for numbers, a KLL sketch of
their distribution. Sketches have a fixed size, whatever the table; days are merged without reading their rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions.numbers import ratio

# Sketch sizes and the errors their authors state for them (DataSketches): a standard error of 1.04 over the root of the number
# of registers, of which three are allowed; a rank error of 1.65 % with k = 200, at 99 % confidence.
LG_K = 12
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(1 << LG_K)
KLL_K = 200
RANK_ERROR = 0.0165


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def day_sketches(df: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """(day, column_name, n_rows, n_nulls, low, high, distinct_sketch, number_sketch): a row per day and column, one pass over
    ``df`` with a sketch a task and day in the shuffle."""
    cells = []
    for c in columns:
        numeric = _is_number(df.schema[c].dataType)
        number = F.col(c).cast("double")
        none = F.lit(None)
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col(c).isNull()).alias("n_nulls"),
                # Adding zero makes a negative zero a zero.
                (F.min(number) + 0.0 if numeric else none.cast("double")).alias("low"),
                (F.max(number) + 0.0 if numeric else none.cast("double")).alias("high"),
                F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias("distinct_sketch"),
                (F.kll_sketch_agg_double(number, KLL_K) if numeric else none.cast("binary")).alias("number_sketch"),
            )
        )
    grouped = df.groupBy(day.alias("day")).agg(F.array(*cells).alias("cells"))
    return grouped.select("day", F.inline("cells"))


def store_days(sketches: DataFrame, path: str) -> None:
    """Writes the rows of their days; days written before are replaced, others stay."""
    dated = sketches.hint("rebalance", F.col("day"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def stored(spark: SparkSession, path: str, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Stored rows of the days from ``since`` to ``until``; other days' folders are not read."""
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.where(F.col("day") >= since)
    return rows if until is None else rows.where(F.col("day") <= until)


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column over all days given."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("number_sketch").alias("number_sketch"),
    )


def profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Rows, NULLs, range, estimated distinct values and estimated quantiles of each column."""
    known = F.col("number_sketch").isNotNull() & (F.coalesce(F.kll_sketch_get_n_double("number_sketch"), F.lit(0)) > 0)
    marks = F.array(*(F.kll_sketch_get_quantile_double("number_sketch", F.lit(q)) for q in quantiles))
    return merged(sketches).select(
        "column_name",
        "n_rows",
        "n_nulls",
        F.round(ratio(F.col("n_nulls"), F.col("n_rows")), 6).alias("null_ratio"),
        "low",
        "high",
        F.hll_sketch_estimate("distinct_sketch").alias("approx_distinct"),
        F.when(known, marks).alias("quantiles"),
    )


def within_error(df: DataFrame, profiled: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, distinct_ok, quantiles_ok): whether each estimate lies within its sketch's stated error of the exact value,
    counted over ``df``. Quantiles are judged by rank, as their error is stated; columns without numbers have none to judge."""
    rows = profiled.collect()  # one row a column
    distinct, ranked = [], []
    for r in rows:
        c = F.col(r.column_name)
        number, n = c.cast("double"), F.count(c)
        allowed = F.lit(DISTINCT_ERROR) * F.count_distinct(c) + 1
        distinct.append(df.agg((F.abs(F.count_distinct(c) - r.approx_distinct) <= allowed).alias("distinct_ok")).select(F.lit(r.column_name).alias("column_name"), "distinct_ok"))
        ok = F.lit(True)
        for q, mark in zip(quantiles, r.quantiles or []):
            ok = ok & (F.count_if(number < mark) <= (q + RANK_ERROR) * n) & (F.count_if(number <= mark) >= (q - RANK_ERROR) * n)
        ranked.append(F.struct(F.lit(r.column_name).alias("column_name"), ok.alias("quantiles_ok")))
    exact = distinct[0]
    for d in distinct[1:]:
        exact = exact.unionByName(d)
    ranks = df.agg(F.array(*ranked).alias("cells")).select(F.inline("cells"))
    return exact.join(ranks, "column_name")
