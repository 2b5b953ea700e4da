"""Land payloads in bulk and record a manifest for every file that results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway import contracts
from sluiceway.operators.layout import place
from sluiceway.session import configure
from sluiceway.sinks.writers import landing_manifests, write_landing, write_manifests
from sluiceway.sources.landing import landing_inventory
from sluiceway.sources.tables import read_manifests


def known_manifests(
    spark: SparkSession, path: str, calendar: DataFrame | None = None
) -> DataFrame:
    """Landing manifests written so far, of the calendar's slices or all; none if the folder is
    not there yet."""
    try:
        return read_manifests(spark, path, contracts.LANDING_MANIFEST, calendar)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], contracts.LANDING_MANIFEST)
        raise


def record_landed(
    spark: SparkSession,
    root: str,
    manifest_path: str,
    calendar: DataFrame,
    *,
    workflow_name: str,
    source_adapter: str,
    selector_mode: str,
    granularity: str,
    fields: Sequence[str],
    content_type: str = "application/json",
    metadata: Mapping[str, str] | None = None,
    base_prefix: str | None = None,
    suffix: Sequence[str] = (),
    ingested_at: datetime | None = None,
    adapter_config: Mapping[str, object] | None = None,
) -> DataFrame:
    """Manifests for the files of these slices that have none yet; returns all manifests.

    What to record is found by comparing files with manifests, so a run that stopped
    between the two is completed by the next.
    """
    configure(spark)
    ingested_at = ingested_at or datetime.now(timezone.utc)
    landed = landing_inventory(
        spark,
        place(root, base_prefix),
        calendar,
        partition_fields=fields,
        granularity=granularity,
        suffix=suffix,
        key_root=root,
    )
    recorded = known_manifests(spark, manifest_path, calendar).select(
        F.col("storage.payload_key").alias("_landing_key")
    )
    pairs = [F.lit(item) for pair in (metadata or {}).items() for item in pair]
    objects = landed.join(recorded, "_landing_key", "left_anti").select(
        "run_id",
        "slice_start",
        "slice_end",
        F.col("_landing_key").alias("payload_key"),
        F.lit(content_type).alias("content_type"),
        F.create_map(*pairs).cast("map<string,string>").alias("metadata"),
        F.lit(ingested_at).alias("ingested_at"),
        F.lit(None).cast("string").alias("suggested_object_name"),
    )
    write_manifests(
        landing_manifests(
            objects,
            workflow_name=workflow_name,
            source_adapter=source_adapter,
            selector_mode=selector_mode,
            granularity=granularity,
            fields=fields,
            base_prefix=base_prefix,
            suffix=suffix,
            calendar=calendar,
            adapter_config=adapter_config,
        ),
        manifest_path,
    )
    return known_manifests(spark, manifest_path)


def land_payloads(
    payloads: DataFrame,
    root: str,
    manifest_path: str,
    calendar: DataFrame,
    ts: Column | str,
    *,
    granularity: str,
    fields: Sequence[str],
    base_prefix: str | None = None,
    suffix: Sequence[str] = (),
    compression: str = "none",
    **manifest_settings,
) -> DataFrame:
    """Write payload lines under the landing layout, then their manifests."""
    write_landing(
        payloads,
        root,
        ts,
        fields=fields,
        granularity=granularity,
        base_prefix=base_prefix,
        suffix=suffix,
        compression=compression,
    )
    return record_landed(
        payloads.sparkSession,
        root,
        manifest_path,
        calendar,
        granularity=granularity,
        fields=fields,
        base_prefix=base_prefix,
        suffix=suffix,
        **manifest_settings,
    )
