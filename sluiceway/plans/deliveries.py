"""Member-file delivery models, from raw rows to audience marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sluiceway.functions.aggregates import avg_as_double, count_all, sum_as_double
from sluiceway.functions.columns import (
    concat_key,
    file_name_from_key,
    iso_to_date,
    relabel,
    try_cast_date,
    try_iso_to_ts,
)
from sluiceway.operators.bundles import canonical_bundles, keep_canonical_rows
from sluiceway.operators.latest import latest_by
from sluiceway.operators.projection import select_columns, typed_projection

# Labels of known locations; others keep their code.
LOCATION_LABELS = {"location_1": "Location 1", "location_2": "Location 2"}

_MEMBER = (
    "facility_id",
    "facility_region",
    "facility_type",
    "feed_type",
    "member_status",
    "plan_tier",
    "age_band",
    "postal_prefix",
)


def bronze_canonical_raw_bundles(raw: DataFrame) -> DataFrame:
    return canonical_bundles(raw, row_date="delivery_date")


def typed_records(raw: DataFrame) -> DataFrame:
    """Raw rows with their final names and types; nothing is dropped yet."""
    return typed_projection(
        raw,
        {
            "delivery_record_id": concat_key("delivery_id", "record_number"),
            "source_system_id": "source_system_id:string",
            "delivery_id": "delivery_id:string",
            "delivery_date": try_cast_date("delivery_date"),
            "record_number": "record_number:bigint",
            "member_id": "member_id:bigint",
            **{name: f"{name}:string" for name in _MEMBER},
            "allowed_amount": "allowed_amount:double",
            "landing_key": "_landing_key:string",
            "standardize_strategy": "_standardize_strategy:string",
            "source_preset_id": "_source_preset_id:string",
            "logical_ts": try_iso_to_ts("_logical_date"),
            "ingested_ts": try_iso_to_ts("_ingested_at"),
            "raw_bundle_id": "_raw_bundle_id:string",
            "raw_bundle_key": "_raw_bundle_key:string",
            "raw_bundle_manifest_key": "_raw_bundle_manifest_key:string",
            "raw_standardized_ts": try_iso_to_ts("_raw_standardized_at"),
            "raw_bundle_granularity": "_raw_bundle_granularity:string",
            "raw_input_object_count": "_raw_input_object_count:bigint",
            "raw_bundle_row_count": "_raw_bundle_row_count:bigint",
            "event_date": F.coalesce(
                try_cast_date("delivery_date"),
                iso_to_date("_logical_date"),
                iso_to_date("_raw_standardized_at"),
            ),
        },
    )


def dedupe_delivery_records(records: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest version of each delivered record."""
    return latest_by(
        records,
        keys=["delivery_record_id"],
        newest_first=["ingested_ts", "raw_standardized_ts", "record_number"],
        tiebreak=tiebreak,
    )


def bronze_delivery_records(
    raw: DataFrame, bundles: DataFrame, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Rows of canonical bundles, one per delivered record."""
    return dedupe_delivery_records(keep_canonical_rows(typed_records(raw), bundles), tiebreak)


def silver_delivery_records(records: DataFrame) -> DataFrame:
    return records.select(
        "delivery_record_id",
        F.col("source_system_id").alias("location_code"),
        relabel("source_system_id", LOCATION_LABELS).alias("location_label"),
        "delivery_id",
        "delivery_date",
        file_name_from_key("landing_key").alias("source_file_name"),
        "record_number",
        "member_id",
        *_MEMBER,
        "allowed_amount",
        "raw_bundle_id",
        "event_date",
    )


def _amounts() -> list:
    return [
        sum_as_double("allowed_amount").alias("total_allowed_amount"),
        avg_as_double("allowed_amount").alias("average_allowed_amount"),
    ]


def silver_delivery_batches(silver: DataFrame) -> DataFrame:
    """One row per delivered file, stored by delivery date."""
    file_keys = ("location_code", "location_label", "source_file_name", "delivery_id", "feed_type")
    return (
        silver.groupBy(*file_keys, "delivery_date")
        .agg(count_all().alias("record_count"), *_amounts())
        .select(
            *file_keys,
            "record_count",
            "total_allowed_amount",
            "average_allowed_amount",
            "delivery_date",
        )
    )


def gold_daily_delivery_metrics(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("event_date")
        .agg(
            count_all().alias("record_count"),
            F.count_distinct("delivery_id").alias("delivery_count"),
            F.count_distinct("location_code").alias("location_count"),
            *_amounts(),
        )
        .select(
            "record_count",
            "delivery_count",
            "location_count",
            "total_allowed_amount",
            "average_allowed_amount",
            "event_date",
        )
    )


def gold_source_system_daily_metrics(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("event_date", "location_code", "location_label")
        .agg(
            count_all().alias("record_count"),
            F.count_distinct("delivery_id").alias("delivery_count"),
            *_amounts(),
        )
        .select(
            "location_code",
            "location_label",
            "record_count",
            "delivery_count",
            "total_allowed_amount",
            "average_allowed_amount",
            "event_date",
        )
    )


def analytics_delivery_records(silver: DataFrame) -> DataFrame:
    return silver.select("*")


def analytics_daily_delivery_metrics(daily: DataFrame) -> DataFrame:
    return daily.select("*")


def management_daily_summary(daily: DataFrame) -> DataFrame:
    return select_columns(
        daily,
        (
            "record_count",
            "delivery_count",
            "location_count",
            "total_allowed_amount",
            "average_allowed_amount",
            "event_date",
        ),
    )


def location_counts(silver: DataFrame) -> DataFrame:
    """Records per location, in location order."""
    return silver.groupBy("location_code").agg(count_all().alias("record_count")).orderBy(
        "location_code"
    )
