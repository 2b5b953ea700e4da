"""Backfill: standardize a range of slices, then rebuild the models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.operators.calendar import SliceSelector, slice_calendar
from sluiceway.operators.layout import place
from sluiceway.plans.build import Workspace, build_models
from sluiceway.plans.standardize import StandardizeJob, standardize_slices
from sluiceway.sources.tables import read_raw_deliveries, read_raw_transactions

# How each landed workflow reads its standardized table.
RAW_READERS = {"transactions": read_raw_transactions, "deliveries": read_raw_deliveries}


def backfill(
    spark: SparkSession,
    workflow: str,
    job: StandardizeJob,
    selector: SliceSelector,
    workspace: Workspace,
    *,
    manifests: DataFrame | None = None,
    mode: str = "run",
    select: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
    incremental: bool = False,
    full_refresh: bool = False,
) -> DataFrame | None:
    """One standardize job over all slices of the selector, then the models.

    A rerun adds newer bundles for the same slices; canonical selection picks them. With
    ``incremental`` only the dates that the new bundles change are rebuilt, unless a
    ``full_refresh`` is asked for.
    """
    bundles = standardize_slices(
        spark,
        job,
        slice_calendar(spark, selector),
        selector_mode=selector.resolved_mode(),
        manifests=manifests,
    )
    raw = RAW_READERS[workflow](spark, place(job.processed_root, job.processed_prefix))
    added = None
    if incremental:
        written = bundles.select(F.col("run_id").alias("_raw_bundle_id"))
        added = raw.join(written, "_raw_bundle_id", "left_semi").select(*raw.columns)
    return build_models(
        spark,
        workflow,
        raw,
        workspace,
        mode=mode,
        select=select,
        exclude=exclude,
        options=options,
        added=added,
        full_refresh=full_refresh,
    )
