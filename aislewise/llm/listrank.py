"""Places of the elements of one linked list, found by tasks that each hold a part of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import written

SOLVED_AT_ONCE = 100_000  # elements that one task ranks, 24 bytes each
NONE = -1


def heads(element: str, turn: int) -> F.Column:
    """A coin an element throws in a round; everybody can tell it."""
    return (F.col(element) != NONE) & (F.pmod(F.xxhash64(F.col(element), F.lit(turn)), F.lit(2)) == 1)


def list_rank(links: DataFrame, at_once: int = SOLVED_AT_ONCE) -> DataFrame:
    """(id, place) of the elements of a list given as (id, next); the last one's next is -1, places count from 0.

    A round takes out every element that throws heads while the one before it throws tails, about a quarter, and never
    two neighbours. Its neighbours are linked to each other, with the distance added, by one grouping on ids; so the work of
    all rounds is a few times that of the first. What is left, at most ``at_once`` elements, is ranked in one task, and the
    rounds are undone in reverse: an element's place is that of the one before it and the distance. Groups hold at
    most three rows.
    """
    backward = links.where(F.col("next") != NONE).select(F.col("next").alias("id"), F.col("id").alias("prev"))
    live = links.join(backward, "id", "left").select(
        "id", "next", F.coalesce("prev", F.lit(NONE)).alias("prev"), F.lit(1).cast("long").alias("after"), F.lit(1).cast("long").alias("back")
    )
    live, removed = written(live), []
    while live.count() > at_once:
        turn = len(removed)
        # The first has no one before it and stays; so does the last, which has no one after it.
        out = heads("id", turn) & (F.col("prev") != NONE) & ~heads("prev", turn) & (F.col("next") != NONE)
        marked = live.withColumn("out", out)
        none = F.lit(None).cast("long")
        stay = marked.where("NOT out").select("id", "next", "prev", "after", "back", none.alias("next2"), none.alias("prev2"), none.alias("gap"))
        gone = marked.where("out")
        gap = (F.col("back") + F.col("after")).alias("gap")
        to_prev = gone.select(F.col("prev").alias("id"), none.alias("next"), none.alias("prev"), none.alias("after"), none.alias("back"), F.col("next").alias("next2"), none.alias("prev2"), gap)
        to_next = gone.select(F.col("next").alias("id"), none.alias("next"), none.alias("prev"), none.alias("after"), none.alias("back"), none.alias("next2"), F.col("prev").alias("prev2"), gap)
        told = stay.unionByName(to_prev).unionByName(to_next).groupBy("id").agg(
            *(F.max(c).alias(c) for c in ("next", "prev", "after", "back", "next2", "prev2")),
            F.max(F.when(F.col("next2").isNotNull(), F.col("gap"))).alias("after2"),
            F.max(F.when(F.col("prev2").isNotNull(), F.col("gap"))).alias("back2"),
        )
        removed.append(written(gone.select("id", "prev", "back")))
        live = written(
            told.select(
                "id",
                *(F.coalesce(f"{c}2", c).alias(c) for c in ("next", "prev", "after", "back")),
            )
        )
    places = written(at_last(live))
    for gone in reversed(removed):
        before = places.withColumnsRenamed({"id": "prev", "place": "place_before"})
        found = gone.join(before, "prev").select("id", (F.col("place_before") + F.col("back")).alias("place"))
        places = written(places.unionByName(found))
    return places


def at_last(live: DataFrame) -> DataFrame:
    """Places in a short list with distances, by doubling pointers to the front in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        ids, prev, back = (table.column(c).to_numpy() for c in ("id", "prev", "back"))
        order = np.argsort(ids)
        front = prev == NONE
        at = order[np.minimum(np.searchsorted(ids, prev, sorter=order), len(ids) - 1)]
        at = np.where(front, np.arange(len(ids)), at)
        place = np.where(front, 0, back)
        while True:
            step = place[at]
            if not step.any():
                break
            place, at = place + step, at[at]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(place)], ["id", "place"])

    return live.select("id", "prev", "back").coalesce(1).mapInArrow(work, "id long, place long")
