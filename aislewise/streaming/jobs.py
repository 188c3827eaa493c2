"""The running streams: events to silver and dead letters, silver to panes, scores, alerts and serving rows.

Every micro-batch writes under its own ``batch_id`` with dynamic partition overwrite, so a batch that
runs again after a failure replaces its rows instead of adding them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aislewise.functions.keys import SALT_BUCKETS, salt_bucket
from aislewise.operators.dedup import latest_per_key
from aislewise.sources.streams import table_changes
from aislewise.streaming import events, scoring, windows


PANE_PARTITIONS = T.StructType([T.StructField("pane_hour", T.StringType()), T.StructField("batch_id", T.LongType())])


@dataclass(frozen=True)
class Lake:
    """Where the streams write; all folders are shared by the executors."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{job}"


def _gathered(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Few files per partition, and several tasks for one that is large.

    Spark plans the batches of stateful streams without adaptive execution. There it drops the hint without a word, and
    every task would write a file into every partition. So rows are dealt out by their values, the same way when a batch
    runs again: a partition gets a salt bucket's share of the tasks.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    share = -(-int(conf.get("spark.sql.shuffle.partitions")) // SALT_BUCKETS)
    # Maps and variants have no hash.
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return df.repartition(*partition_by, F.pmod(F.xxhash64(*hashed), F.lit(share)))


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    stamped = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if partition_by:
        stamped = _gathered(stamped, partition_by)
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, "batch_id")
        .parquet(path)
    )


def _run(writer, trigger: dict) -> StreamingQuery:
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def run_with(spark: SparkSession, writer, trigger: dict | None, settings: dict[str, str]) -> StreamingQuery:
    """Starts a query under settings of its own; the session keeps its settings."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return _run(writer, trigger)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_partitions(spark: SparkSession) -> int:
    """Two tasks a core, no more than the session's shuffles have. Each state partition costs its files in every batch,
    however few rows it holds, and a query keeps the number that its first run had."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def ingest(raw: DataFrame, lake: Lake, trigger: dict | None = None) -> StreamingQuery:
    """Raw JSON to the silver table by business date, and what cannot be read to the dead-letter table."""

    def both(batch: DataFrame, batch_id: int) -> None:
        parsed = events.parse_events(batch).persist()
        try:
            write_batch(events.accepted(parsed), lake.path("silver"), batch_id, ("business_date",))
            write_batch(events.rejected(parsed), lake.path("dead_letter"), batch_id)
        finally:
            parsed.unpersist()

    writer = raw.writeStream.foreachBatch(both).option("checkpointLocation", lake.checkpoint("ingest"))
    return _run(writer, trigger)


def pane_stream(silver: DataFrame, late_by: str = events.LATE_BY) -> DataFrame:
    """Closed ten-second panes per store and cashier; state holds ids and panes no older than the watermark."""
    return windows.panes(events.once(silver, late_by)).withColumn("pane_end", F.col("pane.end")).drop("pane")


def _recent_panes(spark: SparkSession, lake: Lake, fresh: DataFrame, batch_id: int) -> DataFrame | None:
    """Stored panes of the hour before the batch. Only the folders of the hours needed are listed, by their names."""
    first, last = fresh.agg(F.min("pane_end"), F.max("pane_end")).first()
    if first is None:
        return None
    columns = T.StructType([*fresh.schema.fields, *PANE_PARTITIONS.fields])
    hours, at = [], (first - timedelta(hours=1)).replace(minute=0, second=0, microsecond=0)
    while at <= last:
        hours.append(f"{at:%Y-%m-%d-%H}")
        at += timedelta(hours=1)
    folder = lake.path("panes")
    try:
        stored = spark.read.schema(columns).option("basePath", folder).parquet(f"{folder}/pane_hour={{{','.join(hours)}}}")
    except Exception as e:  # noqa: BLE001 - the first batch has no table yet
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    start = F.lit(first) - F.expr("INTERVAL 1 HOUR")
    return stored.filter(
        (F.col("pane_end") > start)
        & (F.col("pane_end") <= F.lit(last))
        & (F.col("batch_id") < batch_id)
    ).select(*fresh.columns)


def cashier_watch(
    silver: DataFrame, lake: Lake, scorer=scoring.default_cashier_score, late_by: str = events.LATE_BY, trigger: dict | None = None
) -> StreamingQuery:
    """Silver changes to trailing-hour metrics, scores, alerts and serving rows.

    The stream's own state is the open panes. The trailing hour is read back from the pane table, so it
    survives a restart and a slow hour costs no memory.
    """

    def emit(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.persist()
        try:
            spark = batch.sparkSession
            history = _recent_panes(spark, lake, fresh, batch_id)
            known = fresh if history is None else history.unionByName(fresh)
            new_ends = fresh.select(*windows.KEYS, F.col("pane_end").alias("window_end")).distinct()
            rolled = windows.rolling_from_panes(known).join(new_ends, [*windows.KEYS, "window_end"], "left_semi")
            scored = windows.serving_rows(scoring.score_cashiers(rolled, scorer)).persist()
            try:
                write_batch(scored.withColumn("salt", salt_bucket(F.col("cashier_id"))), lake.path("serving"), batch_id, ("salt",))
                write_batch(scoring.abuse_alerts(scored), lake.path("alerts"), batch_id)
                # Last: a write to the pane table makes Spark read it again for whatever is cached from it.
                hour = F.date_format("pane_end", "yyyy-MM-dd-HH")
                write_batch(fresh.withColumn("pane_hour", hour), lake.path("panes"), batch_id, ("pane_hour",))
            finally:
                scored.unpersist()
        finally:
            fresh.unpersist()

    writer = (
        pane_stream(silver, late_by)
        .writeStream.outputMode("append")
        .foreachBatch(emit)
        .option("checkpointLocation", lake.checkpoint("cashier_watch"))
    )
    return _run(writer, trigger)


def hourly_watch(
    silver: DataFrame, lake: Lake, late_by: str = events.LATE_BY, trigger: dict | None = None, partitions: int | None = None
) -> StreamingQuery:
    """Cashier metrics of each whole hour under its serving key, once the watermark has passed the hour's end.
    ``partitions`` are those of the state; without it, as many as the session's shuffles have."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn("salt", salt_bucket(F.col("cashier_id"))), lake.path("hourly"), batch_id, ("salt",))

    hours = windows.hourly_metrics(events.once(silver, late_by))
    writer = hours.writeStream.outputMode("append").foreachBatch(emit).option("checkpointLocation", lake.checkpoint("hourly"))
    return run_with(silver.sparkSession, writer, trigger, {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})


def order_watch(
    silver: DataFrame, lake: Lake, threshold: float = 0.5, trigger: dict | None = None, late_by: str = events.LATE_BY
) -> StreamingQuery:
    """Order-level anomaly alerts, one per transaction: repeats within the watermark are dropped before scoring, and
    a repeated batch replaces its rows."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        write_batch(scoring.order_alerts(batch, threshold), lake.path("alerts_orders"), batch_id)

    once = events.once(silver, late_by)
    writer = once.writeStream.foreachBatch(emit).option("checkpointLocation", lake.checkpoint("order_watch"))
    return _run(writer, trigger)


def silver_changes(spark: SparkSession, lake: Lake, files_per_trigger: int | None = None) -> DataFrame:
    """The silver table as a stream."""
    schema = spark.read.parquet(lake.path("silver")).schema
    return table_changes(spark, lake.path("silver"), schema, files_per_trigger)


def serving_table(spark: SparkSession, lake: Lake) -> DataFrame:
    """Current serving rows: the newest write of every row key."""
    return latest_per_key(spark.read.parquet(lake.path("serving")), ["row_key"], ["batch_id"]).drop("batch_id", "salt")
