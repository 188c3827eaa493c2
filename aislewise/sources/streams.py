"""Stream sources: point-of-sale events as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_events(spark: SparkSession, servers: str, topic: str, *, per_trigger: int | None = None, **options: str) -> DataFrame:
    """The event topic. Needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at"))


def text_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same events from a folder of JSON-lines files."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def table_changes(
    spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, name_filter: str | None = None
) -> DataFrame:
    """An append-only parquet table as a stream of its new rows."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)
