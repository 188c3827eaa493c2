"""Change feeds of keyed tables: what was inserted, updated and deleted between two versions, and back again.

Rows are told apart by digests, so unchanged rows are compared as 16 bytes each and only changed ones move whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits of a row; NULLs differ from all values."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """(keys, change, before, after, version): a row per key that the two versions hold differently. Keys are unique and not
    NULL in each version; both have the same columns."""
    names = [c for c in after.columns if c not in keys]
    sides = [
        df.select(*keys, F.lit(side).alias("side"), row_digest(names).alias("digest")) for df, side in ((before, 0), (after, 1))
    ]
    # A key's two digests meet in one grouping.
    met = sides[0].unionByName(sides[1]).groupBy(*keys).agg(
        F.max(F.when(F.col("side") == 0, F.col("digest"))).alias("old"), F.max(F.when(F.col("side") == 1, F.col("digest"))).alias("new")
    )
    change = F.when(F.col("old").isNull(), INSERT).when(F.col("new").isNull(), DELETE).otherwise(UPDATE)
    differ = met.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, change.alias("change"))
    old = before.select(*keys, F.struct(*names).alias("before"))
    new = after.select(*keys, F.struct(*names).alias("after"))
    return differ.join(old, list(keys), "left").join(new, list(keys), "left").withColumn("version", F.lit(version).cast("long"))


def apply(table: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` after all changes of ``feed``, which may hold several versions: the last change of a key counts."""
    last = feed.groupBy(*keys).agg(F.max_by(F.struct("change", "after"), "version").alias("c"))
    kept = table.join(last.select(*keys), list(keys), "left_anti")
    written = last.where(F.col("c.change") != DELETE).select(*keys, "c.after.*")
    return kept.unionByName(written.select(*table.columns))
