"""Warranty triage: purchased lines against policy terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.functions.time import month_boundaries
from aislewise.operators.dedup import latest_per_key

COVERED, EXPIRED = "COVERED", "EXPIRED"


def purchase_lines(txn: DataFrame) -> DataFrame:
    """One row per basket line; transactions without lines have nothing to triage."""
    carried = [c for c in txn.columns if c != "items"]
    return txn.select(*carried, F.explode("items").alias("line")).select(*carried, "line.*")


def triage(lines: DataFrame, policies: DataFrame, as_of: Column) -> DataFrame:
    """Lines with a policy, and whether the months since purchase are within its term, inclusive.

    Policies are unique by product, so a best-selling product skews only the line side, which the
    adaptive skew join can split; a small policy table is broadcast by Spark's own size threshold.
    """
    elapsed = month_boundaries(as_of, F.col("business_date"))
    return (
        lines.join(policies, lines["item_id"] == policies["product_id"])
        .withColumn("months_elapsed", elapsed)
        .withColumn(
            "warranty_status", F.when(elapsed <= F.col("warranty_duration_months"), COVERED).otherwise(EXPIRED)
        )
    )


def latest_purchase(triaged: DataFrame) -> DataFrame:
    """The newest purchase of every customer."""
    return latest_per_key(triaged, ["customer_id"], ["business_date", "transaction_id", "line_seq"])


def join_coverage(lines: DataFrame, policies: DataFrame) -> DataFrame:
    """How many distinct items find a policy: zero means the key convention has drifted."""
    matched = lines.select("item_id").distinct().join(policies, F.col("item_id") == F.col("product_id"), "left_semi")
    return matched.agg(F.count(F.lit(1)).alias("value"))
