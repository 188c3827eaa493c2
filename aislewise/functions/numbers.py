"""Money sums, ratios and vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(col: Column) -> Column:
    """Amounts are added as decimals so a total does not depend on the order of its rows."""
    return col.cast("decimal(28,9)")


def money_sum(col: Column) -> Column:
    return F.sum(money(col))


def ratio(part: Column, whole: Column) -> Column:
    """Safe division: NULL over zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pass_fraction(predicate: Column) -> Column:
    """Share of rows that meet the predicate; a NULL predicate counts as not met, no rows is NULL."""
    return ratio(F.count_if(predicate), F.count(F.lit(1)))


def percent(fraction: Column, digits: int = 2) -> Column:
    return F.round(fraction * 100.0, digits)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def has_dimension(vector: Column, size: int) -> Column:
    return F.size(vector) == size
