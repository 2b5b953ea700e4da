"""Sensor-event models, from delivered events to audience marts.

The staging and mart functions work on batch and on streaming frames alike, as far as
Spark allows the aggregate on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sluiceway.functions.aggregates import conditional_count, count_all
from sluiceway.functions.columns import iso_to_ts
from sluiceway.operators.latest import latest_by
from sluiceway.operators.projection import select_columns, typed_projection

# Published columns, in order.
EVENT_COLUMNS = (
    "workflow_name",
    "source_preset_id",
    "source_schema_version",
    "source_scenario_name",
    "source_seed",
    "emitter_event_id",
    "emission_batch_started_at",
    "emitted_at",
    "emission_index",
    "device_id",
    "site_id",
    "device_type",
    "temperature_c",
    "pressure_kpa",
    "device_status",
    "event_date",
)

NEWEST_FIRST = ("emitted_at", "emission_index")


def stg_sensor_events(raw: DataFrame) -> DataFrame:
    """Typed events; rows without an event id (malformed lines among them) are dropped."""
    text = {name: f"{name}:string" for name in EVENT_COLUMNS[:4]}
    # Parsed once, used twice.
    identified = raw.where(F.col("emitter_event_id").isNotNull()).withColumn(
        "_emitted_ts", iso_to_ts("emitted_at")
    )
    return typed_projection(
        identified,
        {
            **text,
            "source_seed": "source_seed:bigint",
            "emitter_event_id": "emitter_event_id:string",
            "emission_batch_started_at": iso_to_ts("emission_batch_started_at"),
            "emitted_at": "_emitted_ts",
            "emission_index": "emission_index:int",
            "device_id": "device_id:string",
            "site_id": "site_id:string",
            "device_type": "device_type:string",
            "temperature_c": "temperature_c:double",
            "pressure_kpa": "pressure_kpa:double",
            "device_status": "device_status:string",
            "event_date": F.to_date("_emitted_ts"),
        },
    )


def int_sensor_events(staged: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest version of each event."""
    return latest_by(staged, ["emitter_event_id"], NEWEST_FIRST, tiebreak).select(*EVENT_COLUMNS)


def analytics_sensor_events(events: DataFrame) -> DataFrame:
    return select_columns(
        events,
        (
            "workflow_name",
            "source_preset_id",
            "source_scenario_name",
            "emitter_event_id",
            "emitted_at",
            "device_id",
            "site_id",
            "device_type",
            "temperature_c",
            "pressure_kpa",
            "device_status",
            "event_date",
        ),
    )


DEVICE_COLUMNS = (
    "device_id",
    "site_id",
    "device_type",
    "device_status",
    "temperature_c",
    "pressure_kpa",
    "emitted_at",
    "event_date",
)


def analytics_device_latest_status(events: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest reading of each device over all dates."""
    return latest_by(events, ["device_id"], NEWEST_FIRST, tiebreak).select(*DEVICE_COLUMNS)


def _warnings() -> list:
    return [
        conditional_count(F.col("device_status") == "warning").alias("warning_event_count"),
        conditional_count(F.col("pressure_kpa").isNull()).alias("missing_pressure_event_count"),
    ]


def analytics_site_daily_metrics(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("site_id", "device_type", "event_date")
        .agg(
            count_all().alias("event_count"),
            F.count_distinct("device_id").alias("device_count"),
            F.avg("temperature_c").alias("avg_temperature_c"),
            F.avg("pressure_kpa").alias("avg_pressure_kpa"),
            *_warnings(),
        )
        .select(
            "site_id",
            "device_type",
            "event_count",
            "device_count",
            "avg_temperature_c",
            "avg_pressure_kpa",
            "warning_event_count",
            "missing_pressure_event_count",
            "event_date",
        )
    )


def management_stream_health_summary(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_date")
        .agg(
            count_all().alias("event_count"),
            F.count_distinct("device_id").alias("distinct_device_count"),
            F.count_distinct("site_id").alias("distinct_site_count"),
            *_warnings(),
        )
        .select(
            "event_count",
            "distinct_device_count",
            "distinct_site_count",
            "warning_event_count",
            "missing_pressure_event_count",
            "event_date",
        )
    )
