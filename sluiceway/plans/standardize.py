"""Landed objects to standardized bundles.

All chosen slices are one job: the slice is a column, rows are written partitioned by it,
and slices without input simply have no rows. Every row says how many its bundle has, so these
are counted first: from the objects where the standardizer says how many rows one holds, else from
the parsed rows, which are staged as Parquet for that.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway import contracts
from sluiceway.functions.slices import GRANULARITIES, check_granularity, partition_value
from sluiceway.operators.joins import attach_manifest_metadata
from sluiceway.operators.layout import Layout, place
from sluiceway.operators.projection import iso_text, lineage_columns
from sluiceway.session import configure, materialize
from sluiceway.sinks.writers import (
    AS_READ,
    spread,
    suffix_columns,
    write_bundle,
    write_manifests,
)
from sluiceway.sources.landing import (
    explode_bundles,
    file_path,
    landing_inventory,
    list_manual_prefix,
    read_bundle_documents,
    read_csv_delivery,
    slice_paths,
)


@dataclass(frozen=True)
class Standardizer:
    """How one kind of landed object becomes rows.

    ``read`` takes the paths, the root that keys are relative to, a condition on the files
    to read (or None) and the job's reader options, and gives a frame with
    ``_landing_key``; ``to_rows`` runs after slices and metadata are attached. ``extra_lineage`` maps output columns to
    metadata keys, and ``columns`` is the published order before the bundle columns.
    ``row_count`` is the number of rows that ``to_rows`` makes of a row that ``read`` gives, where
    that can be told without ``to_rows``.
    """

    read: Callable[..., DataFrame]
    to_rows: Callable[[DataFrame], DataFrame]
    columns: Sequence[str]
    extra_lineage: Mapping[str, str] = field(default_factory=dict)
    row_count: Callable[[], Column] | None = None


def _read_bundles(spark, paths, *, root, only, one_per_line=False):
    return read_bundle_documents(
        spark,
        paths,
        contracts.TRANSACTION_ROW,
        root=root,
        json_columns=contracts.TRANSACTION_JSON_COLUMNS,
        only=only,
        one_per_line=one_per_line,
    )


def _read_deliveries(spark, paths, *, root, only, columns=None, quoted_newlines=True):
    columns = columns or contracts.DELIVERY_FIELDS
    rows = read_csv_delivery(
        spark, paths, columns, root=root, only=only, quoted_newlines=quoted_newlines
    )
    absent = [name for name in contracts.DELIVERY_FIELDS if name not in columns]
    return rows.withColumns({name: F.lit(None).cast("string") for name in absent})


_BUNDLE_COLUMN_COUNT = len(contracts.names(contracts.BUNDLE_LINEAGE))

STANDARDIZERS: dict[str, Standardizer] = {
    "json_bundle": Standardizer(
        read=_read_bundles,
        to_rows=lambda df: explode_bundles(
            df, contracts.TRANSACTION_ROW, contracts.TRANSACTION_JSON_COLUMNS
        ),
        columns=contracts.names(contracts.RAW_TRANSACTIONS)[:-_BUNDLE_COLUMN_COUNT],
        row_count=lambda: F.coalesce(F.array_size("rows"), F.lit(0)),
    ),
    "csv_delivery": Standardizer(
        read=_read_deliveries,
        to_rows=lambda df: df,
        columns=contracts.names(contracts.RAW_DELIVERIES)[:-_BUNDLE_COLUMN_COUNT],
        extra_lineage={
            "_source_system_id": "source_system_id",
            "_delivery_id": "delivery_id",
            "_delivery_date": "delivery_date",
            "_feed_type": "feed_type",
            "_response_row_count": "row_count",
        },
    ),
}


def get_standardizer(key: str) -> Standardizer:
    if key not in STANDARDIZERS:
        raise ValueError(f"unknown standardizer {key!r}; known: {sorted(STANDARDIZERS)}")
    return STANDARDIZERS[key]


def register_standardizer(key: str, standardizer: Standardizer) -> None:
    STANDARDIZERS[key] = standardizer


@dataclass(frozen=True)
class StandardizeJob:
    """Parameters of a standardize run. Paths are full; keys are relative to the roots."""

    standardizer: str
    preset_id: str
    landing_root: str
    processed_root: str
    manifest_root: str
    workflow_name: str = "workflow"
    label: str | None = None
    landing_granularity: str = "day"
    output_granularity: str = "day"
    landing_prefix: str | None = None
    landing_fields: Sequence[str] = ("year", "month", "day")
    landing_suffix: Sequence[str] = ()
    # Where all objects lie, whatever their slice; takes the place of the landing layout.
    landing_input_prefix: str | None = None
    processed_prefix: str = "raw"
    processed_fields: Sequence[str] = ("year", "month", "day")
    # Segments key=value below the time fields.
    processed_suffix: Sequence[str] = ()
    reader_options: Mapping[str, object] = field(default_factory=dict)

    def validate(self) -> None:
        get_standardizer(self.standardizer)
        if not self.preset_id:
            raise ValueError("preset_id must be a non-empty string")
        check_granularity(self.landing_granularity)
        check_granularity(self.output_granularity)
        order = GRANULARITIES.index
        if order(self.output_granularity) < order(self.landing_granularity):
            raise ValueError("output granularity cannot be finer than landing granularity")
        Layout(self.landing_granularity, self.landing_fields, self.landing_suffix)
        Layout(self.output_granularity, self.processed_fields, self.processed_suffix)
        suffix_columns(self.processed_suffix)


def annotate_bundle(rows: DataFrame, bundles: DataFrame, standardized_at: datetime) -> DataFrame:
    """Append the eight bundle columns, and the slice start that places the row.

    ``bundles`` has one row per run id: keys, granularity, slice start and both counts.
    """
    columns = bundles.select(
        "run_id",
        "slice_start",
        F.col("run_id").alias("_raw_bundle_id"),
        F.col("bundle_key").alias("_raw_bundle_key"),
        F.col("manifest_key").alias("_raw_bundle_manifest_key"),
        F.lit(_iso(standardized_at)).alias("_raw_standardized_at"),
        iso_text("slice_start").alias("_raw_bundle_logical_date"),
        F.col("granularity").alias("_raw_bundle_granularity"),
        F.col("object_count").alias("_raw_input_object_count"),
        F.col("row_count").alias("_raw_bundle_row_count"),
    )
    return rows.join(columns, "run_id", "inner")


def _iso(value: datetime) -> str:
    return value.astimezone(timezone.utc).isoformat()


def bundle_summary(
    rows: DataFrame, inventory: DataFrame, row_count: Column | None = None
) -> DataFrame:
    """Rows and input objects per run id, for the bundles that have rows.

    A row of ``rows`` counts as ``row_count`` rows, by default one.
    """
    counts = F.count(F.lit(1)) if row_count is None else F.sum(row_count)
    counted = rows.groupBy("run_id").agg(counts.cast("bigint").alias("row_count"))
    counted = counted.where(F.col("row_count") > 0)
    objects = inventory.groupBy("run_id").agg(F.count(F.lit(1)).alias("object_count"))
    return counted.join(objects, "run_id", "inner")


def bundle_manifests(
    bundles: DataFrame, job: StandardizeJob, standardized_at: datetime, selector_mode: str | None
) -> DataFrame:
    """One manifest row per written bundle; its input keys are in a table of their own."""
    temporal = selector_mode is not None
    mode = F.lit("temporal" if temporal else "manual")
    null = F.lit(None).cast("string")
    output_metadata = F.create_map(
        F.lit("preset_id"),
        F.lit(job.preset_id),
        F.lit("input_object_count"),
        F.col("object_count").cast("string"),
    )
    return bundles.select(
        F.lit("1").alias("schema_version"),
        F.lit(job.workflow_name).alias("workflow_name"),
        F.lit(job.label or job.standardizer).alias("standardize_strategy"),
        mode.alias("planning_mode"),
        F.lit(_iso(standardized_at)).alias("standardized_at"),
        F.struct(
            mode.alias("mode"),
            F.lit(job.landing_prefix).cast("string").alias("input_prefix"),
            F.col("object_count"),
            F.lit(selector_mode).cast("string").alias("slice_selector_mode"),
            F.lit(job.landing_granularity if temporal else None)
            .cast("string")
            .alias("landing_slice_granularity"),
            iso_text("slice_start").alias("logical_date"),
            iso_text("slice_start").alias("slice_start"),
            iso_text("slice_end").alias("slice_end"),
            (F.col("granularity") if temporal else null).alias("slice_granularity"),
            F.col("run_id"),
        ).alias("input"),
        F.struct(
            mode.alias("mode"),
            F.col("bundle_key").alias("payload_key"),
            F.col("manifest_key"),
            F.lit(None if temporal else job.processed_prefix).cast("string").alias("output_prefix"),
            F.lit(job.processed_prefix if temporal else None).cast("string").alias("base_prefix"),
            F.array(*[F.lit(f) for f in job.processed_fields]).alias("partition_fields"),
            F.array(*[F.lit(s) for s in job.processed_suffix if temporal])
            .cast("array<string>")
            .alias("path_suffix"),
            F.col("row_count"),
            output_metadata.alias("metadata"),
            F.lit("application/x-parquet").alias("content_type"),
        ).alias("output"),
    )


BUNDLES = """
    run_id STRING, row_count BIGINT, object_count BIGINT, slice_start TIMESTAMP,
    slice_end TIMESTAMP, granularity STRING, bundle_key STRING, manifest_key STRING
"""


def write_bundle_inputs(inventory: DataFrame, job: StandardizeJob) -> None:
    """Append the landed objects of each bundle, one row each."""
    keys = inventory.select("run_id", "slice_start", F.col("_landing_key").alias("landing_key"))
    keys.write.mode("append").parquet(f"{job.manifest_root}/inputs")


def standardize_slices(
    spark: SparkSession,
    job: StandardizeJob,
    calendar: DataFrame,
    *,
    selector_mode: str = "range",
    manifests: DataFrame | None = None,
    standardized_at: datetime | None = None,
) -> DataFrame:
    """Standardize every slice of the calendar; returns one summary row per written bundle.

    ``manifests`` carries the landed objects' metadata. A slice that finds no objects, or
    whose objects hold no rows, writes nothing.
    """
    configure(spark)
    job.validate()
    standardized_at = standardized_at or datetime.now(timezone.utc)
    kind = get_standardizer(job.standardizer)
    landing = place(job.landing_root, job.landing_prefix)

    # Which objects belong to which slice is settled on the file list, with its manifests.
    # It has a row per object, and Spark knows its size when the rows are joined to it.
    inventory = materialize(
        landing_inventory(
            spark,
            landing,
            calendar,
            partition_fields=job.landing_fields,
            granularity=job.output_granularity,
            suffix=job.landing_suffix,
            manifests=manifests,
            key_root=job.landing_root,
            input_prefix=job.landing_input_prefix,
        ),
        "standardize-inputs",
    )
    if inventory.isEmpty():
        return spark.createDataFrame([], BUNDLES)
    if job.landing_input_prefix is not None:
        paths, only = place(job.landing_root, job.landing_input_prefix), None
    else:
        paths = slice_paths(landing, calendar, job.landing_fields, job.output_granularity)
        only = Layout("hour", job.landing_fields, job.landing_suffix).in_folders(file_path())
    objects = kind.read(spark, paths, root=job.landing_root, only=only, **job.reader_options)
    placed = objects.join(
        inventory.select("_landing_key", "run_id", "slice_start", "_metadata_map"), "_landing_key"
    )
    rows = lineage_columns(
        kind.to_rows(placed),
        "_metadata_map",
        label=job.label or job.standardizer,
        preset_id=job.preset_id,
        extra_keys=kind.extra_lineage,
    ).select("run_id", *kind.columns)
    if kind.row_count is None:
        counted = rows = materialize(rows, "standardize-rows")
        row_count = None
    else:
        counted, row_count = placed, kind.row_count()
    directory = F.concat_ws(
        "/",
        *[F.lit(job.processed_prefix.strip("/"))][: bool(job.processed_prefix.strip("/"))],
        *[
            F.concat(F.lit(f"{name}="), partition_value("slice_start", name))
            for name in job.processed_fields
        ],
        *[F.lit(segment) for segment in job.processed_suffix],
    )
    file_name = F.concat(F.lit("slice_id="), F.col("run_id"), F.lit(".parquet"))
    bundles = materialize(
        bundle_summary(counted, inventory, row_count)
        .join(calendar, "run_id")
        .withColumns(
            {
                "bundle_key": F.concat_ws("/", directory, file_name),
                "manifest_key": F.concat_ws(
                    "/", directory, F.concat(F.lit("_"), file_name, F.lit(".manifest.json"))
                ),
            }
        ),
        "standardize-bundles",
    )
    # A run is in one folder. What is the same in all rows of a bundle is added after the shuffle.
    annotated = annotate_bundle(spread(rows, "run_id"), bundles, standardized_at)
    # The folder of a bundle has the name that its key ends in, so the key leads to it.
    write_bundle(
        annotated.select(
            "slice_start",
            *kind.columns,
            *contracts.names(contracts.BUNDLE_LINEAGE),
            F.concat("_raw_bundle_id", F.lit(".parquet")).alias("slice_id"),
        ),
        place(job.processed_root, job.processed_prefix),
        "slice_start",
        job.processed_fields,
        below=("slice_id",),
        suffix=job.processed_suffix,
        arrange=AS_READ,
    )
    write_manifests(
        bundle_manifests(bundles, job, standardized_at, selector_mode),
        f"{job.manifest_root}/bundles",
    )
    inputs = inventory.join(bundles.select("run_id"), "run_id", "left_semi")
    write_bundle_inputs(inputs, job)
    return bundles.select(*contracts.names(BUNDLES))


def standardize_manual(
    spark: SparkSession,
    job: StandardizeJob,
    *,
    input_prefix: str,
    object_name: str | None = None,
    manifests: DataFrame | None = None,
    standardized_at: datetime | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Standardize everything below a prefix as one bundle without a slice."""
    if not input_prefix.strip():
        raise ValueError("input_prefix must be a non-empty path prefix")
    if object_name is not None and (not object_name.strip() or "/" in object_name):
        raise ValueError("object_name must be a non-empty file name without '/'")
    configure(spark)
    job.validate()
    standardized_at = standardized_at or datetime.now(timezone.utc)
    run_id = run_id or str(uuid4())
    kind = get_standardizer(job.standardizer)
    prefix = f"{job.landing_root.rstrip('/')}/{input_prefix.strip('/')}"
    if manifests is None:
        manifests = spark.createDataFrame([], contracts.LANDING_MANIFEST)
    no_slice = F.lit(None).cast("timestamp")

    objects = kind.read(spark, prefix, root=job.landing_root, only=None, **job.reader_options)
    rows = lineage_columns(
        kind.to_rows(
            attach_manifest_metadata(objects, manifests).withColumns(
                {"run_id": F.lit(run_id), "slice_start": no_slice}
            )
        ),
        "_metadata_map",
        label=job.label or job.standardizer,
        preset_id=job.preset_id,
        extra_keys=kind.extra_lineage,
    ).select("run_id", *kind.columns)
    staged = materialize(rows, "standardize-rows")
    inventory = list_manual_prefix(spark, prefix, root=job.landing_root).select(
        F.lit(run_id).alias("run_id"),
        no_slice.alias("slice_start"),
        "_landing_key",
    )
    name = object_name or f"run_id={run_id}.parquet"
    directory = [part for part in [job.processed_prefix.strip("/")] if part]
    bundles = materialize(
        bundle_summary(staged, inventory).withColumns(
            {
                "slice_start": no_slice,
                "slice_end": no_slice,
                "granularity": F.lit("manual"),
                "bundle_key": F.lit("/".join([*directory, name])),
                "manifest_key": F.lit("/".join([*directory, f"_{name}.manifest.json"])),
            }
        ),
        "standardize-bundles",
    )
    if bundles.isEmpty():
        return spark.createDataFrame([], BUNDLES)
    annotated = annotate_bundle(staged, bundles, standardized_at)
    annotated.select(*kind.columns, *contracts.names(contracts.BUNDLE_LINEAGE)).write.mode("append").option(
        "compression", "snappy"
    ).parquet(place(job.processed_root, *directory, name))
    write_manifests(
        bundle_manifests(bundles, job, standardized_at, None), f"{job.manifest_root}/bundles"
    )
    write_bundle_inputs(inventory, job)
    return bundles.select(*contracts.names(BUNDLES))
