"""Event intake: sources, delivery to files, quarantine, typed staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from sluiceway.operators.layout import partition_columns
from sluiceway.plans.events import stg_sensor_events
from sluiceway.sources.tables import CORRUPT, event_schema

# How long and how much the delivery buffers.
BUFFER_SECONDS = 60
BUFFER_BYTES = 64 * 1024 * 1024
# Where streaming state is kept: on local disk, with changes in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # To count the keys it would look each up again.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def text_event_source(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Undelivered events, one JSON text per row, from a folder that files drop into."""
    reader = spark.readStream
    # The source takes one limit: a number of files, or the size of the delivery buffer.
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", BUFFER_BYTES)
    return reader.text(path)


def kafka_event_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Undelivered events from Kafka, keyed by device; needs Spark's Kafka package."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def _is_deliverable() -> Column:
    """Whether a text is a JSON object: it parses and begins as one. Writing it again to see that
    would take four times as long."""
    begins = F.ltrim("value", F.lit(" \t\r\n")).startswith("{")
    return F.coalesce(begins & F.try_parse_json("value").isNotNull(), F.lit(False))


def deliver_events(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    repeats_within: str | None = None,
) -> DataStreamWriter:
    """Write events as gzip NDJSON under the date of delivery.

    The file sink keeps a log of finished batches, so a retried batch is not seen twice. With
    ``repeats_within``, an event whose text arrived before is left out if that was at most so
    long ago. State is a hash of 128 bits per text, and leaves as the time of arrival passes. It
    is kept in RocksDB: a batch costs what it holds, not what all before it held.
    """
    events = stream.where(_is_deliverable())
    if repeats_within is not None:
        keep_state_on_disk(stream.sparkSession)
        events = drop_repeats(events, repeats_within)
    rows = partition_columns(events, F.current_timestamp(), ("year", "month", "day"))
    return _file_sink(rows, path, checkpoint, trigger, ["year", "month", "day"])


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams that start from now on keep their state in RocksDB, in bounded memory, and write
    only its changes to the checkpoint. The default store copies all state for every batch."""
    for key, value in STATE_ON_DISK.items():
        spark.conf.set(key, value)


def drop_repeats(stream: DataFrame, within: str) -> DataFrame:
    """Leave out texts that arrived before, as far back as ``within``."""
    return (
        stream.withColumns(
            {
                "_arrived": F.current_timestamp(),
                "_text_hash": F.unhex(F.md5(F.col("value"))),
            }
        )
        .withWatermark("_arrived", within)
        .dropDuplicatesWithinWatermark(["_text_hash"])
        .drop("_arrived", "_text_hash")
    )


def quarantine_bad_events(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> DataStreamWriter:
    """Write the text of events that are not JSON objects under ``type=malformed``."""
    rows = partition_columns(
        stream.where(~_is_deliverable()).withColumn("type", F.lit("malformed")),
        F.current_timestamp(),
        ("year", "month", "day"),
    )
    return _file_sink(rows, path, checkpoint, trigger, ["type", "year", "month", "day"])


def _file_sink(rows, path, checkpoint, trigger, partitions) -> DataStreamWriter:
    return (
        rows.select("value", *partitions)
        .writeStream.format("text")
        .option("compression", "gzip")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partitions)
        .trigger(**(trigger or {"processingTime": f"{BUFFER_SECONDS} seconds"}))
    )


def delivered_event_stream(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Delivered event files as a stream, columns as in the batch reader. A batch is bounded by
    a number of files or by their size."""
    reader = (
        spark.readStream.schema(event_schema(with_corrupt=False))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def stage_events_stream(raw: DataFrame) -> DataFrame:
    """The batch staging model, applied to a stream."""
    return stg_sensor_events(raw)
