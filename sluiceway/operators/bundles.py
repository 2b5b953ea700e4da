"""Canonical bundle selection: one standardized bundle per time slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.functions.aggregates import count_all
from sluiceway.functions.columns import iso_to_date, try_cast_date, try_iso_to_ts
from sluiceway.operators.latest import latest_by

BUNDLE_COLUMNS = (
    "raw_bundle_id",
    "raw_standardized_ts",
    "bundle_logical_ts",
    "bundle_granularity",
    "bundle_selector_key",
    "raw_input_object_count",
    "raw_bundle_row_count",
    "raw_bundle_file_count",
    "bundle_event_date",
)

_TUPLE = (
    "_raw_bundle_id",
    "_raw_bundle_key",
    "_raw_standardized_at",
    "_raw_bundle_logical_date",
    "_raw_bundle_granularity",
    "_raw_input_object_count",
    "_raw_bundle_row_count",
)


def bundle_dates() -> list[Column]:
    """Event date of a bundle, by preference: its logical date, its standardized date."""
    return [iso_to_date("_raw_bundle_logical_date"), iso_to_date("_raw_standardized_at")]


def bundle_candidates(raw: DataFrame, row_date: str | None = None) -> DataFrame:
    """Distinct bundle descriptions found on the raw rows.

    ``row_date`` names a text column whose date, where it has one, comes before the
    bundle's own dates. Distinct runs on the raw text first: it shrinks in the map tasks
    to a few rows per bundle, and only those are parsed.
    """
    extra = [row_date] if row_date else []
    dates = [try_cast_date(name) for name in extra] + bundle_dates()
    return (
        raw.select(*_TUPLE, *extra)
        .distinct()
        .select(
            F.col("_raw_bundle_id").alias("raw_bundle_id"),
            F.col("_raw_bundle_key").alias("raw_bundle_key"),
            try_iso_to_ts("_raw_standardized_at").alias("raw_standardized_ts"),
            try_iso_to_ts("_raw_bundle_logical_date").alias("bundle_logical_ts"),
            F.col("_raw_bundle_granularity").alias("bundle_granularity"),
            F.coalesce("_raw_bundle_logical_date", "_raw_bundle_id").alias("bundle_selector_key"),
            F.col("_raw_input_object_count").alias("raw_input_object_count"),
            F.col("_raw_bundle_row_count").alias("raw_bundle_row_count"),
            F.coalesce(*dates).alias("bundle_event_date"),
        )
        .distinct()
    )


def bundle_rollup(candidates: DataFrame) -> DataFrame:
    """One row per bundle id.

    Row and file counts add up over the distinct descriptions, so a bundle described
    with two event dates counts twice.
    """
    newest = [
        F.max(name).alias(name)
        for name in (
            "raw_standardized_ts",
            "bundle_logical_ts",
            "bundle_granularity",
            "bundle_selector_key",
            "raw_input_object_count",
            "bundle_event_date",
        )
    ]
    return (
        candidates.groupBy("raw_bundle_id")
        .agg(
            *newest,
            F.sum("raw_bundle_row_count").alias("raw_bundle_row_count"),
            count_all().alias("raw_bundle_file_count"),
        )
        .select(*BUNDLE_COLUMNS)
    )


def canonical_bundles(raw: DataFrame, row_date: str | None = None) -> DataFrame:
    """Newest standardized bundle of each (granularity, selector key)."""
    return latest_by(
        bundle_rollup(bundle_candidates(raw, row_date)),
        keys=["bundle_granularity", "bundle_selector_key"],
        newest_first=["raw_standardized_ts", "raw_bundle_id"],
    )


def keep_canonical_rows(rows: DataFrame, bundles: DataFrame) -> DataFrame:
    """Rows of the winning bundles.

    Bundle ids are unique in ``bundles``, so a semi join equals the inner join. No
    broadcast hint: hand in a written table (``session.materialize`` or a model output)
    and Spark broadcasts it if its files are under the threshold. Larger ones shuffle on
    the bundle id, where AQE splits a bundle that holds too many rows.
    """
    return rows.join(bundles.select("raw_bundle_id"), "raw_bundle_id", "left_semi").select(
        *rows.columns
    )
