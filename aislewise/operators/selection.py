"""Exact quantiles by counting: no sort of all rows, and no task that sees them all."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Values that are sorted at once when a bracket has shrunk so far, 8 bytes each.
SORTED_AT_ONCE = 10_000
ACCURACY = 200


def quantiles(df: DataFrame, column: str, at: Sequence[float], at_once: int = SORTED_AT_ONCE) -> list[float | None]:
    """For each of ``at`` the smallest value that at least this share of the non-NULL values does not exceed."""
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col(column).isNotNull())
    n = values.count()
    return [_ranked(values, max(1, math.ceil(q * n)), n, at_once) if n else None for q in at]


def _ranked(values: DataFrame, rank: int, n: int, at_once: int) -> float:
    """The value with the given rank from 1. A round brackets it between two approximate quantiles, counts what lies below and
    inside, and goes on inside: the bracket shrinks by a fixed share of its rows, whatever their distribution."""
    inside = values
    while n > at_once:
        share = rank / n
        marks = [max(0.0, share - 2 / ACCURACY), min(1.0, share + 2 / ACCURACY)]
        low, high = inside.agg(F.percentile_approx("x", marks, ACCURACY)).first()[0]
        below, equal_low, between, equal_high = inside.agg(
            F.count_if(F.col("x") < low), F.count_if(F.col("x") == low), F.count_if((F.col("x") > low) & (F.col("x") < high)), F.count_if(F.col("x") == high)
        ).first()
        if rank <= below:
            inside, n = inside.where(F.col("x") < low), below
        elif rank <= below + equal_low:
            return low
        elif rank <= below + equal_low + between:
            inside, rank, n = inside.where((F.col("x") > low) & (F.col("x") < high)), rank - below - equal_low, between
        elif high > low and rank <= below + equal_low + between + equal_high:
            return high
        else:
            done = below + equal_low + between + (equal_high if high > low else 0)
            inside, rank, n = inside.where(F.col("x") > high), rank - done, n - done
    return sorted(r.x for r in inside.collect())[rank - 1]
