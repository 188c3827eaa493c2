"""The trailing hour of every cashier as a stream that also goes down: a row when a pane enters, and one when it leaves.

Events become sums per ten-second pane, kept by a stateful processor for one hour. A pane enters the trailing hour at its
end and leaves it an hour later; event-time timers fire at both, once the watermark has passed, so every row is final. A
cashier who stops working gets rows down to the empty hour, and then no state is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from aislewise.functions.keys import salt_bucket, serving_key
from aislewise.streaming import events, scoring
from aislewise.streaming.jobs import Lake, run_with, write_batch
from aislewise.streaming.windows import KEYS, PANE_SECONDS, SPAN_SECONDS

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUMS = ("txn_count", "override_count", "promo_count", "discount_e4", "share_e4")
STATE = "panes binary, timer long"
ROWS = "store_id string, cashier_id string, window_end long, entered boolean, " + ", ".join(f"{c} long" for c in SUMS) + ", last_us long"
# A pane in the state: its end, its sums and its last event.
WIDTH = 2 + len(SUMS)


class TrailingHour(StatefulProcessor):
    """State per cashier: the panes of the last hour, one row of numbers each, and the next time at which one of them
    enters or leaves. At most 360 panes have entered; more wait only while the watermark lags."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", STATE)

    def load(self) -> tuple[np.ndarray, int]:
        if not self.state.exists():
            return np.empty((0, WIDTH), dtype=np.int64), -1
        packed, timer = self.state.get()
        return np.frombuffer(packed, dtype=np.int64).reshape(-1, WIDTH), timer

    def keep(self, panes: np.ndarray, timer: int, now: int) -> None:
        """Stores the panes, with a timer at the first time after ``now`` at which one enters or leaves."""
        times = np.concatenate([panes[:, 0], panes[:, 0] + SPAN_SECONDS])
        due = int(times[times > now].min()) if (times > now).any() else -1
        if due != timer:
            if timer >= 0:
                self.handle.deleteTimer(1000 * timer)
            if due >= 0:
                self.handle.registerTimer(1000 * due)
        if due >= 0:
            self.state.update((panes.tobytes(), due))
        else:
            self.state.clear()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        panes, timer = self.load()
        added = [panes, *(r[["pane_end", *SUMS, "last_us"]].to_numpy(dtype=np.int64) for r in rows)]
        every = np.concatenate(added)
        ends, at = np.unique(every[:, 0], return_inverse=True)
        merged = np.zeros((len(ends), WIDTH), dtype=np.int64)
        merged[:, 0] = ends
        np.add.at(merged[:, 1:-1], at, every[:, 1:-1])
        np.maximum.at(merged[:, -1], at, every[:, -1])
        # What entered or left up to the watermark has been told; what is due later fires by its timer.
        self.keep(merged, timer, min(self.told(timerValues), timer - 1) if timer >= 0 else self.told(timerValues))
        yield pd.DataFrame()

    @staticmethod
    def told(timerValues) -> int:
        """Seconds up to which no further event can come."""
        return timerValues.getCurrentWatermarkInMs() // 1000

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        panes, timer = self.load()
        now = self.told(timerValues)
        ends = panes[:, 0]
        entries, exits = ends[(ends >= timer) & (ends <= now)], (ends + SPAN_SECONDS)
        exits = exits[(exits >= timer) & (exits <= now)]
        times = np.union1d(entries, exits)
        total = np.concatenate([np.zeros((1, len(SUMS)), dtype=np.int64), np.cumsum(panes[:, 1:-1], axis=0)])
        inside, before = np.searchsorted(ends, times, "right"), np.searchsorted(ends, times - SPAN_SECONDS, "right")
        sums = total[inside] - total[before]
        out = pd.DataFrame(sums, columns=list(SUMS))
        out.insert(0, "store_id", key[0])
        out.insert(1, "cashier_id", key[1])
        out.insert(2, "window_end", times)
        out.insert(3, "entered", np.isin(times, entries))
        last = panes[np.maximum(inside - 1, 0), -1] if len(panes) else np.zeros(len(times), dtype=np.int64)
        out["last_us"] = pd.array(np.where(inside > before, last, -1), dtype="Int64")
        # The timer has fired and is gone.
        self.keep(panes[ends + SPAN_SECONDS > now], -1, now)
        yield out

    def close(self) -> None:
        pass


def trailing_stream(silver: DataFrame, late_by: str = events.LATE_BY) -> DataFrame:
    """(store, cashier, window_end, entered, metrics): the hour up to each time at which a pane enters or leaves it. Rates of
    an empty hour are 0, and it has no last event."""
    share = F.try_divide(F.col("discount_amount").cast("double"), F.col("subtotal_amount").cast("double"))
    once = events.once(silver, late_by)
    numbers = once.select(
        *KEYS,
        "event_ts",
        ((F.floor(F.unix_seconds("event_ts") / PANE_SECONDS) + 1) * PANE_SECONDS).cast("long").alias("pane_end"),
        F.lit(1).cast("long").alias("txn_count"),
        F.coalesce(F.col("manual_discount_flag").cast("long"), F.lit(0)).alias("override_count"),
        F.col("promo_code_applied").isNotNull().cast("long").alias("promo_count"),
        F.coalesce((F.col("discount_amount") * 10000).cast("long"), F.lit(0)).alias("discount_e4"),
        F.coalesce(F.round(share * 10000).cast("long"), F.lit(0)).alias("share_e4"),
        F.unix_micros("event_ts").alias("last_us"),
    )
    rows = numbers.groupBy(*KEYS).transformWithStateInPandas(TrailingHour(), ROWS, "Append", "EventTime")
    n = F.col("txn_count")

    def rate(c: str) -> F.Column:
        return F.coalesce(F.try_divide(F.col(c).cast("double"), n.cast("double")), F.lit(0.0))

    return rows.select(
        *KEYS,
        F.timestamp_seconds("window_end").alias("window_end"),
        "entered",
        n.alias("cashier_1h_txn_count"),
        F.col("override_count").alias("cashier_1h_manual_override_count"),
        F.col("promo_count").alias("cashier_1h_promo_count"),
        rate("promo_count").alias("cashier_1h_promo_rate"),
        F.round(F.coalesce(F.try_divide(F.col("share_e4").cast("double"), (n * 100).cast("double")), F.lit(0.0)), 4).alias(
            "cashier_1h_avg_discount_pct"
        ),
        (F.col("discount_e4") / F.lit(10000.0)).alias("cashier_1h_total_discount_usd"),
        F.when(F.col("last_us") >= 0, F.timestamp_micros("last_us")).alias("last_event_ts"),
    )


def started(spark: SparkSession, writer, trigger: dict | None, partitions: int | None) -> StreamingQuery:
    """Starts a query whose state lies in RocksDB; the session keeps its own settings. The number of state partitions is
    fixed by a query's first run."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": STORE}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    return run_with(spark, writer, trigger, wanted)


def trailing_watch(
    silver: DataFrame,
    lake: Lake,
    scorer=scoring.default_cashier_score,
    late_by: str = events.LATE_BY,
    trigger: dict | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Silver changes to serving rows that rise and fall, and to alerts where a pane that entered asks for review. Row keys
    hold the end of the hour, so a cashier's newest row is the current one."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        scored = scoring.score_cashiers(batch, scorer).persist()
        try:
            keyed = scored.withColumn("row_key", serving_key(F.col("store_id"), F.col("cashier_id"), F.col("window_end")))
            write_batch(keyed.withColumn("salt", salt_bucket(F.col("cashier_id"))), lake.path("trailing"), batch_id, ("salt",))
            write_batch(scoring.abuse_alerts(scored.where("entered")), lake.path("trailing_alerts"), batch_id)
        finally:
            scored.unpersist()

    writer = (
        trailing_stream(silver, late_by)
        .writeStream.outputMode("append")
        .foreachBatch(emit)
        .option("checkpointLocation", lake.checkpoint("trailing_watch"))
    )
    return started(silver.sparkSession, writer, trigger, partitions)
