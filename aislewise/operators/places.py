"""Places of ordered rows, without a window over all of them."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.session import shared_dir

AT = "__at"
INSIDE = 33  # bits of a row's number inside its range


def places(ordered: DataFrame, *columns: str, name: str = "place") -> DataFrame:
    """``columns`` of the rows of ``ordered`` (the result of an orderBy) and their place from 1.

    The sort leaves one sorted range to each task, and a row's number there counts from 0; the counts of the ranges before
    it are added. Ranges are sampled, so the numbered rows are written once, and counts and places come from the same files.
    """
    spark = ordered.sparkSession
    numbered = ordered.select(*columns, F.monotonically_increasing_id().alias(AT))
    path = f"{shared_dir(spark)}/places-{uuid.uuid4().hex}"
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path)
    part = F.shiftright(AT, INSIDE).cast("int")
    counts = {r.part: r["count"] for r in rows.groupBy(part.alias("part")).count().collect()}  # one row a range
    sizes = [counts.get(k, 0) for k in range(max(counts, default=-1) + 1)]
    before = F.array(*(F.lit(n).cast("long") for n in itertools.accumulate(sizes[:-1], initial=0)))
    inside = F.col(AT).bitwiseAND(F.lit((1 << INSIDE) - 1))
    return rows.select(*columns, (F.get(before, part) + inside + 1).alias(name))
