"""Event tables and marts kept up to date by micro-batch, exact for late and repeated data.

Streaming aggregates cannot count distinct devices, and a newer version of an event can move it
to another date. So a keyed streaming aggregation holds the newest version of every event and all
dates it ever had; each batch it hands on the events that changed. The batch then replaces
these dates in the event table and computes the daily marts of these dates again, both by Spark's
dynamic partition overwrite.

As late data touch any date, a batch may rewrite most of the tables. Where only the end counts
(:meth:`EventMarts.drain`), batches wait in a folder until they are as large as the event table,
so what is written in all grows with the events, not with the events times the batches.

A batch that is done again gets the same events and dates from the state that Spark keeps by
batch, and ends in the same tables. Looking an event up costs what the batch holds, not what
the table holds. The state has a row per event in RocksDB on the executors' disks, with its changes in
the checkpoint. Readers that read while a batch is moved in may see some of its dates before the
others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from sluiceway.operators.latest import latest_by
from sluiceway.plans import events as evt
from sluiceway.session import configure, materialize
from sluiceway.sinks.partitions import (
    dates_of,
    exists,
    folders,
    on_dates,
    read_table,
    remove,
    size_of,
)
from sluiceway.sinks.writers import BY_PARTITION, GROUPED, write_model
from sluiceway.streaming.intake import (
    BUFFER_BYTES,
    STATE_STORE,
    deliver_events,
    delivered_event_stream,
    quarantine_bad_events,
    stage_events_stream,
    text_event_source,
)

EVENTS = """
    workflow_name STRING, source_preset_id STRING, source_schema_version STRING,
    source_scenario_name STRING, source_seed BIGINT, emitter_event_id STRING,
    emission_batch_started_at TIMESTAMP, emitted_at TIMESTAMP, emission_index INT,
    device_id STRING, site_id STRING, device_type STRING, temperature_c DOUBLE,
    pressure_kpa DOUBLE, device_status STRING, event_date DATE
"""
SITE_DAILY = """
    site_id STRING, device_type STRING, event_count BIGINT, device_count BIGINT,
    avg_temperature_c DOUBLE, avg_pressure_kpa DOUBLE, warning_event_count BIGINT,
    missing_pressure_event_count BIGINT, event_date DATE
"""
SENSOR_EVENTS = """
    workflow_name STRING, source_preset_id STRING, source_scenario_name STRING,
    emitter_event_id STRING, emitted_at TIMESTAMP, device_id STRING, site_id STRING,
    device_type STRING, temperature_c DOUBLE, pressure_kpa DOUBLE, device_status STRING,
    event_date DATE
"""
HEALTH = """
    event_count BIGINT, distinct_device_count BIGINT, distinct_site_count BIGINT,
    warning_event_count BIGINT, missing_pressure_event_count BIGINT, event_date DATE
"""
# What a batch changed, as newest_versions gives it.
_EVENT_FIELDS = ", ".join(
    f"{name}: {kind}" for name, kind in (field.split() for field in EVENTS.split(","))
)
CHANGED = f"event STRUCT<{_EVENT_FIELDS}>, dates ARRAY<STRUCT<event_date: DATE>>"


def newest_versions(staged: DataFrame) -> DataFrame:
    """Newest version of each event (``event``) and all dates its versions have (``dates``).

    On a stream, run in update mode, a batch gives the events of which it had a version. The
    newest is the greatest by stamp and index, then by the other columns, so it does not
    depend on the order of arrival.
    """
    order = [*evt.NEWEST_FIRST]
    rest = [name for name in evt.EVENT_COLUMNS if name not in order]
    return staged.groupBy("emitter_event_id").agg(
        F.max(F.struct(*order, *rest)).alias("event"),
        # An array cannot hold a NULL that counts, so dates are one-element structs.
        F.collect_set(F.struct("event_date")).alias("dates"),
    )


@dataclass(frozen=True)
class DatedTable:
    """A table by ``event_date`` at a path, with declared columns."""

    path: str
    schema: str
    arrange: str = BY_PARTITION

    def read(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self.path):
            return spark.createDataFrame([], self.schema)
        return read_table(spark, self.path, self.schema)

    def replace(self, rows: DataFrame, dates: Sequence[date | None]) -> None:
        """Make ``rows`` the whole content of ``dates``; other dates stay as they are."""
        write_model(rows, self.path, "event_date", self.arrange, dates)


def upsert_latest_events(table: DatedTable, changed: DataFrame) -> list[date | None]:
    """Put the newest versions (``newest_versions``) into the table; returns the dates that
    may have changed: all that the versions of these events have. Only these are read."""
    spark = changed.sparkSession
    changed = materialize(changed, "events-batch")
    events = changed.select("event.*").select(*evt.EVENT_COLUMNS)
    dates = dates_of(changed.select(F.explode("dates").alias("day")).select("day.event_date"))
    if dates:
        present = table.read(spark).where(on_dates("event_date", dates))
        others = present.join(events.select("emitter_event_id"), "emitter_event_id", "left_anti")
        table.replace(others.unionByName(events), dates)
    return dates


@dataclass(frozen=True)
class EventMarts:
    """The event table and the four published marts, under one root and one checkpoint."""

    root: str

    @property
    def events(self) -> DatedTable:
        return DatedTable(f"{self.root}/int_sensor_events", EVENTS)

    @property
    def waiting(self) -> str:
        """Folder of the changes that batches made and that the tables do not have yet."""
        return f"{self.root}/waiting"

    @property
    def site_daily(self) -> DatedTable:
        return DatedTable(f"{self.root}/analytics_site_daily_metrics", SITE_DAILY, GROUPED)

    @property
    def health(self) -> DatedTable:
        return DatedTable(f"{self.root}/management_stream_health_summary", HEALTH, GROUPED)

    @property
    def sensor_events(self) -> DatedTable:
        return DatedTable(f"{self.root}/analytics_sensor_events", SENSOR_EVENTS)

    @property
    def device_daily(self) -> DatedTable:
        """Newest event of each device and date, which the device status is taken from."""
        return DatedTable(f"{self.root}/device_daily", EVENTS, GROUPED)

    def device_status(self, spark: SparkSession) -> DataFrame:
        """Newest reading per device. An event that a newer version moved to another device
        or date is no longer among the rows of the old one."""
        return evt.analytics_device_latest_status(self.device_daily.read(spark))

    def process_batch(self, changed: DataFrame) -> None:
        dates = upsert_latest_events(self.events, changed)
        if not dates:
            return
        rows = self.events.read(changed.sparkSession).where(on_dates("event_date", dates))
        devices = latest_by(rows, ["device_id", "event_date"], evt.NEWEST_FIRST)
        for table, content in (
            (self.sensor_events, evt.analytics_sensor_events(rows)),
            (self.device_daily, devices),
            (self.site_daily, evt.analytics_site_daily_metrics(rows)),
            (self.health, evt.management_stream_health_summary(rows)),
        ):
            table.replace(content, dates)

    def keep_batch(self, changed: DataFrame, batch: int) -> None:
        """Let a batch wait; all that wait go into the tables once they are as large as the
        event table. A batch done again takes the place of what it left."""
        spark = changed.sparkSession
        changed.write.mode("overwrite").parquet(f"{self.waiting}/batch={batch}")
        if size_of(spark, self.waiting) >= size_of(spark, self.events.path):
            self.apply_waiting(spark)

    def apply_waiting(self, spark: SparkSession) -> None:
        """Bring the tables up to date with the batches that wait. An event is taken from its
        last batch, which has its newest version; the dates are those of all batches."""
        if not exists(spark, self.waiting):
            return
        waiting = read_table(spark, self.waiting, f"{CHANGED}, batch BIGINT")
        changed = latest_by(
            waiting.withColumn("_id", F.col("event.emitter_event_id")), ["_id"], ["batch"]
        )
        self.process_batch(changed.select("event", "dates"))
        # Oldest first: what is left if this breaks off are the last batches, and to put these in
        # again changes nothing.
        batches = [int(name.partition("=")[2]) for name in folders(spark, self.waiting)]
        for batch in sorted(batches):
            remove(spark, f"{self.waiting}/batch={batch}")
        remove(spark, self.waiting)

    def writer(
        self, staged: DataFrame, checkpoint: str, trigger: dict | None = None
    ) -> DataStreamWriter:
        """The checkpoint belongs to the tables: it holds the versions seen. A new checkpoint
        needs a new root, and all events again."""
        self._check(staged.sparkSession, checkpoint)
        self.apply_waiting(staged.sparkSession)
        return self._writer(
            staged, checkpoint, lambda changed, _: self.process_batch(changed), trigger
        )

    def drain(self, staged: DataFrame, checkpoint: str) -> None:
        """Take in all events there are; the tables have them when this returns. If it fails
        midway, they lack the batches that wait, which the next run puts in first or last."""
        spark = staged.sparkSession
        self._check(spark, checkpoint)
        writer = self._writer(staged, checkpoint, self.keep_batch, {"availableNow": True})
        writer.start().awaitTermination()
        self.apply_waiting(spark)

    def _check(self, spark: SparkSession, checkpoint: str) -> None:
        held = exists(spark, self.events.path) or exists(spark, self.waiting)
        if held and not exists(spark, f"{checkpoint}/offsets"):
            raise ValueError(f"{self.root} holds tables of another checkpoint than {checkpoint}")

    def _writer(self, staged, checkpoint, each_batch, trigger) -> DataStreamWriter:
        spark = staged.sparkSession
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        return (
            newest_versions(staged)
            .writeStream.outputMode("update")
            .foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"}))
        )


def stream_build(
    spark: SparkSession, incoming: str, root: str, checkpoint: str, max_files: int | None = None
) -> EventMarts:
    """Deliver all waiting events, then bring the marts up to date; returns the marts.

    Both steps remember in their checkpoints what they have done, so a later call only
    handles what is new. ``max_files`` bounds the incoming files of a batch; of the delivered
    ones, which are many and small, a batch takes as many bytes as the buffer holds.
    """
    configure(spark)
    now = {"availableNow": True}
    source = text_event_source(spark, incoming, max_files)
    for writer in (
        deliver_events(source, f"{root}/events", f"{checkpoint}/deliver", now),
        quarantine_bad_events(source, f"{root}/errors", f"{checkpoint}/quarantine", now),
    ):
        writer.start().awaitTermination()
    marts = EventMarts(f"{root}/marts")
    delivered = delivered_event_stream(spark, f"{root}/events", max_bytes=BUFFER_BYTES)
    marts.drain(stage_events_stream(delivered), f"{checkpoint}/marts")
    return marts
