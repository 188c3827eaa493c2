"""Running values and joins that no single key, however common, brings into one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import written

LEAST_HOT = 100  # rows of a key, before it is split
MOST_HOT = 2048  # keys that can be split: each holds more than 1 / MOST_HOT of the rows


def running(rows: DataFrame, group: Sequence[str], order: Sequence[Column], sums: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``group`` and ``order``), ``follows`` (the row before is of the same group) and,
    for each of ``sums``, ``<name>_upto``: its sum over the group's rows up to this one.

    Rows are dealt out by sampled ranges of all keys, so a large group spans tasks; each task adds up its own range, and
    one row a range (its first and last group, its last sums) tells what the ranges before add. ``group`` and ``sums``
    are long columns without nulls; rows that are equal in all keys come in any order.
    """
    spark = rows.sparkSession
    keys = [*group, *order, "__tie"]
    names = rows.columns
    upto = [f"{s}_upto" for s in sums]
    schema = rows.schema
    for name, kind in [("follows", "boolean"), *((u, "long") for u in upto), ("__open", "boolean"), ("__part", "integer"), ("__nth", "long")]:
        schema = schema.add(name, kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, open_ = TaskContext.get().partitionId(), 0, True
        last, totals = None, np.zeros(len(sums), dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = np.array([batch.column(c).to_numpy() for c in group], dtype=np.int64).reshape(len(group), n)
            change = np.zeros(n, dtype=bool)
            change[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
            change[0] = last is not None and (key[:, 0] != last).any()
            begins = np.flatnonzero(change)
            opening = np.full(n, open_)
            if len(begins):
                opening[begins[0] :] = False
            first = np.zeros(n, dtype=np.int64)  # where the row's group begins in this batch
            first[begins] = begins
            first = np.maximum.accumulate(first)
            carried = np.full(n, not len(begins)) if not len(begins) else np.arange(n) < begins[0]
            columns = []
            for k, s in enumerate(sums):
                value = batch.column(s).to_numpy()
                total = np.cumsum(value)
                before = np.where(first > 0, total[first - 1], 0)
                before = np.where(change[0] & (first == 0), 0, before)
                columns.append(total - before + np.where(carried, totals[k], 0))
            follows = ~change
            if nth == 0:
                follows[0] = False
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(follows),
                    *map(pa.array, columns),
                    pa.array(opening),
                    pa.array(np.full(n, part), pa.int32()),
                    pa.array(nth + np.arange(n)),
                ],
                schema.names,
            )
            last, totals = key[:, -1], np.array([c[-1] for c in columns], dtype=np.int64)
            nth, open_ = nth + n, bool(opening[-1])

    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    made = written(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*names).mapInArrow(work, schema))
    edge = F.struct(*group, *upto, "__open") if group or upto else F.struct("__open")
    edges = made.groupBy("__part").agg(
        F.count("*").alias("n"), F.min_by(edge, "__nth").alias("first"), F.max_by(edge, "__nth").alias("last")
    )
    carries, place, held, sums_held = [], 0, None, [0] * len(upto)
    for e in sorted(edges.collect(), key=lambda e: e["__part"]):  # one row a range
        goes_on = held is not None and [e.first[c] for c in group] == held
        add = sums_held if goes_on else [0] * len(upto)
        carries.append((e["__part"], place, goes_on, *add))
        held, place = [e.last[c] for c in group], place + e.n
        sums_held = [e.last[u] + (a if e.last["__open"] else 0) for u, a in zip(upto, add)]
    kinds = ", ".join(["__part int", "__place long", "__goes_on boolean", *(f"__add{k} long" for k in range(len(upto)))])
    carry = F.broadcast(spark.createDataFrame(carries, kinds))  # one row a range
    goes_on = (F.col("__nth") == 0) & F.col("__goes_on")
    return made.join(carry, "__part").select(
        *names,
        (F.col("__place") + F.col("__nth")).alias("place"),
        (F.col("follows") | goes_on).alias("follows"),
        *(
            (F.col(u) + F.when(F.col("__open"), F.col(f"__add{k}")).otherwise(F.lit(0))).alias(u)
            for k, u in enumerate(upto)
        ),
    )


def salted_join(large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``large`` joined with ``small``, which has few rows a key, on the columns ``on``; ``how``: inner or left.

    Keys that hold more than a fixed share of ``large`` are counted first (a partial sum a task). Their rows are dealt out
    by a number besides, and the rows of ``small`` with such a key are repeated for each number. ``large`` is read twice:
    it should be a written table.
    """
    on = list(on)
    counts = large.groupBy(*on).agg(F.count("*").alias("__n"))
    limit = max(LEAST_HOT, large.count() // MOST_HOT)
    # Fewer than MOST_HOT keys can hold more than such a share.
    hot = counts.where(F.col("__n") > limit).select(*on, F.ceil(F.col("__n") / limit).cast("int").alias("__copies")).dropna()
    hot = F.broadcast(hot)
    spread = F.monotonically_increasing_id()
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col("__copies")).cast("int"), F.lit(0))
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    salt = F.when(missing, F.pmod(F.xxhash64(spread), F.lit(MOST_HOT)).cast("int")).otherwise(salt)
    dealt = large.join(hot, on, "left").withColumn("__salt", salt).drop("__copies")
    numbers = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__copies"), F.lit(1)) - 1))
    repeated = small.join(hot, on, "left").withColumn("__salt", numbers).drop("__copies")
    return dealt.join(repeated, [*on, "__salt"], how).drop("__salt")
