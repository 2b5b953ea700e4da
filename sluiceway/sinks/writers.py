"""Writers: landing payloads, CSV deliveries, standardized bundles, manifests, models."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from sluiceway.functions.slices import partition_value, slice_shift
from sluiceway.operators.layout import Layout, partition_columns, place
from sluiceway.operators.projection import iso_text, partition_last
from sluiceway.session import shuffles_freed
from sluiceway.sinks.partitions import replace_all, replace_partitions

# How rows are arranged for a partitioned write.
BY_PARTITION = "by_partition"
GROUPED = "grouped"
AS_READ = "as_read"


def spread(df: DataFrame, *columns: str, arrange: str = BY_PARTITION) -> DataFrame:
    """Arrange rows for a partitioned write without putting a large group in one task.

    ``by_partition``: rebalance hashes by the columns and lets AQE merge small partitions
    and split large ones to the advisory size, which keeps the number of files down on
    both ends.

    ``grouped``: for tables whose partitions hold a few aggregate rows each the work is
    opening files, so their partitions are dealt out to all cores. Hashing the columns
    first keeps Spark from folding this into the shuffle of the aggregate, which AQE
    would then merge into one task.

    ``as_read``: no shuffle. For a projection of a table that is stored by the same
    columns: a task reads files of few partitions and writes about as many.
    """
    if arrange == AS_READ:
        return df
    if arrange == GROUPED:
        cores = df.sparkSession.sparkContext.defaultParallelism
        return df.repartition(cores, F.xxhash64(*columns))
    return df.hint("rebalance", *columns)


def write_model(
    df: DataFrame,
    path: str,
    partition: str | None = None,
    arrange: str = BY_PARTITION,
    dates: Sequence[date | None] | None = None,
    observation: Observation | None = None,
    measures: Sequence[Column] = (),
) -> None:
    """Rebuild a model as snappy Parquet, partition column last, or only ``dates`` of it.

    A failed write leaves the old rows. ``measures`` are taken of the rows while they are
    written, in the last stage, where a repeated task counts once. Read the model with its
    declared schema (:func:`partitions.read_table`): a column of nulls alone or a table without
    rows has no type in its directories.
    """
    rows = df.hint("rebalance") if partition is None else None
    if rows is None:
        rows = spread(partition_last(df, partition), partition, arrange=arrange)
    if observation is not None and measures:
        rows = rows.observe(observation, *measures)
    options = {"compression": "snappy"}
    if partition is None:
        replace_all(rows, path, options)
    else:
        replace_partitions(rows, path, partition, dates, options)


def model_location(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_bundle(
    df: DataFrame,
    root: str,
    ts: Column | str,
    fields: Sequence[str] = ("year", "month", "day"),
    below: Sequence[str] = (),
    suffix: Sequence[str] = (),
    arrange: str = BY_PARTITION,
) -> None:
    """Append standardized rows under ``root/<field>=.../<suffix>/``.

    Suffix segments must be ``key=value``, the only directories that Spark writes. Columns in
    ``below`` give further directories. An empty frame adds no directory. ``arrange`` as in
    :func:`spread`; rows that were spread before are written ``as_read``.
    """
    fixed = suffix_columns(suffix)
    rows = partition_columns(df, ts, fields).withColumns(fixed)
    with shuffles_freed(df.sparkSession):
        (
            spread(rows, *fields, arrange=arrange)
            .write.mode("append")
            .option("compression", "snappy")
            .partitionBy(*fields, *fixed, *below)
            .parquet(root)
        )


def suffix_columns(suffix: Sequence[str]) -> dict[str, Column]:
    """Path segments ``key=value`` as constant columns to partition by."""
    fixed = dict(segment.partition("=")[::2] for segment in suffix)
    if not all(fixed.values()):
        raise ValueError(f"path suffix segments must be key=value to be written: {suffix}")
    return {key: F.lit(value) for key, value in fixed.items()}


def bundle_documents(
    rows: DataFrame,
    row_columns: Sequence[str],
    *,
    schema_version: str,
    scenario_name: str,
    keep: Sequence[str] = (),
    rows_per_document: int = 250,
) -> DataFrame:
    """Pack rows into JSON bundle documents, one text value each.

    Each document holds at most ``rows_per_document`` rows that share the ``keep`` values
    and lie in one task, so nothing is shuffled or gathered to form it.
    """
    head = F.to_json(
        F.struct(
            F.lit(schema_version).alias("schema_version"),
            F.lit(scenario_name).alias("scenario_name"),
        )
    )
    texts = rows.select(
        *keep, F.to_json(F.struct(*row_columns)).alias("row"), head.alias("head")
    )
    schema = T.StructType([*texts.select(*keep).schema.fields, T.StructField("payload", T.StringType())])
    names = list(keep)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups = batch.groupby(names, sort=False, dropna=False) if names else [((), batch)]
            documents = []
            for values, group in groups:
                for start in range(0, len(group), rows_per_document):
                    part = group["row"].iloc[start : start + rows_per_document]
                    payload = (
                        f'{{"row_count":{len(part)},{group["head"].iloc[0][1:-1]},'
                        f'"rows":[{",".join(part)}]}}'
                    )
                    documents.append((*values, payload))
            yield pd.DataFrame(documents, columns=[*names, "payload"])

    return texts.mapInPandas(pack, schema)


def write_landing(
    payloads: DataFrame,
    root: str,
    ts: Column | str | None,
    *,
    fields: Sequence[str] = ("year", "month", "day"),
    granularity: str = "day",
    base_prefix: str | None = None,
    suffix: Sequence[str] = (),
    content: str = "payload",
    compression: str = "none",
) -> str:
    """Append payload text in bulk under the landing layout; returns the base path.

    One payload per line. With ``ts=None`` the write is a manual one: no time fields and
    no suffix. Suffix segments follow the time fields and must be ``key=value``, the only
    directories that Spark writes.
    """
    path = place(root, base_prefix)
    if ts is None:
        payloads.select(content).write.mode("append").option("compression", compression).text(path)
        return path
    Layout(granularity, tuple(fields), tuple(suffix))
    fixed = suffix_columns(suffix)
    rows = partition_columns(payloads, ts, fields).select(
        content, *fields, *[value.alias(key) for key, value in fixed.items()]
    )
    with shuffles_freed(payloads.sparkSession):
        (
            spread(rows, *fields)
            .write.mode("append")
            .option("compression", compression)
            .partitionBy(*fields, *fixed)
            .text(path)
        )
    return path


def write_csv_delivery(
    df: DataFrame, path: str, fields: Sequence[str], partition_by: Sequence[str] = ()
) -> None:
    """CSV with a header; other columns are dropped and nested values become JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    values = [
        F.to_json(name).alias(name) if isinstance(df.schema[name].dataType, nested) else F.col(name)
        for name in fields
    ]
    writer = df.select(*values, *partition_by).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    (
        writer.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def object_stem(run_id: Column | str) -> Column:
    return F.concat(F.lit("run_id="), F.col(run_id) if isinstance(run_id, str) else run_id)


# Suffix by content type.
CONTENT_SUFFIX = {
    "application/json": ".json",
    "text/csv": ".csv",
    "text/plain": ".txt",
    "application/octet-stream": ".bin",
}


def object_name(
    content_type: Column | str,
    run_id: Column | str,
    suggested: Column | str | None = None,
    override: str | None = None,
) -> Column:
    """Name of a landed object: the override, else the suggestion, else its run id."""
    content_type = F.col(content_type) if isinstance(content_type, str) else content_type
    kind = F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))
    suffix = F.when(kind.endswith("+json"), ".json")
    for name, extension in CONTENT_SUFFIX.items():
        suffix = suffix.when(kind == name, extension)
    stem_name = F.concat(object_stem(run_id), suffix.otherwise(""))
    if override is not None:
        if not override.strip() or "/" in override:
            raise ValueError("a landed object needs one plain file name")
        return F.lit(override)
    if suggested is None:
        return stem_name
    suggested = F.col(suggested) if isinstance(suggested, str) else suggested
    bad = (F.trim(suggested) == "") | suggested.contains("/")
    checked = F.when(
        bad, F.raise_error(F.concat(F.lit("bad object name: "), suggested)).cast("string")
    ).otherwise(suggested)
    return F.coalesce(checked, stem_name)


def _slice_struct(start: Column, granularity: str) -> Column:
    return F.struct(
        iso_text(start).alias("logical_date"),
        iso_text(start).alias("slice_start"),
        iso_text(slice_shift(start, granularity, 1)).alias("slice_end"),
        F.lit(granularity).alias("granularity"),
    )


def landing_manifests(
    objects: DataFrame,
    *,
    workflow_name: str,
    source_adapter: str,
    selector_mode: str | None,
    granularity: str | None,
    fields: Sequence[str] = ("year", "month", "day"),
    base_prefix: str | None = None,
    suffix: Sequence[str] = (),
    calendar: DataFrame | None = None,
    request_payload: Mapping[str, object] | None = None,
    object_name_override: str | None = None,
    storage_prefix: str | None = None,
    adapter_config: Mapping[str, object] | None = None,
) -> DataFrame:
    """One manifest row per landed object.

    ``objects`` has ``run_id, content_type, metadata, ingested_at, suggested_object_name``
    and, for temporal landings, ``slice_start`` and ``slice_end``; ``selector_mode=None``
    means a manual landing. Objects that are landed already also have a ``payload_key``;
    otherwise the key follows from the layout and the object's name. With the ``calendar``
    of a multi-slice request the manifests also say how many slices it had, and which were
    first and last; ``request_payload`` is what a manual request asked for.

    ``object_name_override`` names every object, whatever was suggested; ``storage_prefix``
    takes the place of ``base_prefix`` in the keys; ``adapter_config`` is kept as JSON text. The
    result is a plain DataFrame: append it as JSON with :func:`write_manifests`.
    """
    temporal = selector_mode is not None
    kind = {None: "manual", "current": "live", "pinned": "slice"}.get(selector_mode, "multi_slice")
    named = objects.withColumn(
        "_name",
        object_name("content_type", "run_id", "suggested_object_name", object_name_override),
    )
    placed = (base_prefix if storage_prefix is None else storage_prefix) or ""
    parts = [placed.strip("/")] if placed.strip("/") else []
    directory = [F.lit(part) for part in parts]
    if temporal:
        directory += [
            F.concat(F.lit(f"{field}="), partition_value("slice_start", field)) for field in fields
        ]
        directory += [F.lit(part) for part in suffix]
    has_name = F.col("suggested_object_name").isNotNull() | F.lit(object_name_override is not None)
    stem = F.when(has_name, F.col("_name")).otherwise(object_stem("run_id"))
    components = F.lit(None)
    if temporal:
        components = F.array(
            *[
                F.struct(
                    F.lit(field).alias("key"), partition_value("slice_start", field).alias("value")
                )
                for field in fields
            ]
        )
    payload_key = F.concat_ws("/", *directory, "_name")
    manifest_key = F.concat_ws(
        "/", *directory, F.concat(F.lit("_"), stem, F.lit(".manifest.json"))
    )
    if "payload_key" in objects.columns:
        payload_key = F.col("payload_key")
        manifest_key = F.regexp_replace(payload_key, "([^/]+)$", "_$1.manifest.json")
    own = F.create_map(
        F.lit("workflow_name"),
        F.lit(workflow_name),
        F.lit("source_adapter"),
        F.lit(source_adapter),
        F.lit("ingested_at"),
        iso_text("ingested_at"),
        F.lit("planning_mode"),
        F.lit("temporal" if temporal else "manual"),
    )
    null = F.lit(None).cast("string")
    bound = {
        "logical_date": iso_text("slice_start") if temporal else null,
        "slice_start": iso_text("slice_start") if temporal else null,
        "slice_end": iso_text("slice_end") if temporal else null,
    }
    if temporal:
        own = F.map_concat(
            own,
            F.create_map(
                F.lit("logical_date"),
                bound["logical_date"],
                F.lit("slice_selector_mode"),
                F.lit(selector_mode),
                F.lit("slice_granularity"),
                F.lit(granularity),
            ),
        )
    # What the object says about itself wins over what the job knows.
    adapter = F.col("metadata")
    own = F.map_filter(own, lambda key, _: ~F.map_contains_key(adapter, key))
    requested = F.when(
        F.lit(kind in ("slice", "multi_slice")),
        F.struct(
            bound["logical_date"].alias("logical_date"),
            bound["slice_start"].alias("slice_start"),
            bound["slice_end"].alias("slice_end"),
            F.lit(granularity).cast("string").alias("granularity"),
        ),
    )
    span = []
    if kind == "multi_slice" and calendar is not None:
        first, last, count = calendar.agg(
            F.min("slice_start"), F.max("slice_start"), F.count(F.lit(1))
        ).first()
        span = [
            F.lit(count).cast("bigint").alias("slice_count"),
            _slice_struct(F.lit(first), granularity).alias("first_slice"),
            _slice_struct(F.lit(last), granularity).alias("last_slice"),
        ]
    if kind == "manual" and request_payload is not None:
        span = [F.lit(json.dumps(dict(request_payload), sort_keys=True)).alias("payload")]
    return named.select(
        F.lit("1").alias("schema_version"),
        F.lit(workflow_name).alias("workflow_name"),
        F.lit(source_adapter).alias("source_adapter"),
        F.lit("temporal" if temporal else "manual").alias("planning_mode"),
        iso_text("ingested_at").alias("ingested_at"),
        F.struct(
            F.lit(kind).alias("kind"),
            F.when(F.lit(kind == "slice"), requested).alias("slice"),
            F.when(F.lit(kind == "multi_slice"), requested).alias("matched_slice"),
            *span,
        ).alias("request"),
        F.struct(
            payload_key.alias("payload_key"),
            manifest_key.alias("manifest_key"),
            F.lit(object_name_override).cast("string").alias("object_name_override"),
            F.lit(storage_prefix).cast("string").alias("resolved_storage_prefix"),
            F.lit("temporal" if temporal else "manual").alias("mode"),
            F.lit(selector_mode).cast("string").alias("slice_selector_mode"),
            F.lit(base_prefix).cast("string").alias("base_prefix"),
            F.array(*[F.lit(f) for f in fields]).alias("partition_fields"),
            F.array(*[F.lit(s) for s in suffix]).cast("array<string>").alias("path_suffix"),
            components.alias("partition_components"),
            *[column.alias(name) for name, column in bound.items()],
            F.lit(granularity).cast("string").alias("slice_granularity"),
            F.col("run_id"),
            object_stem("run_id").alias("object_stem"),
        ).alias("storage"),
        F.struct(
            "content_type",
            F.map_concat(own, adapter).alias("metadata"),
            "suggested_object_name",
        ).alias("payload"),
        F.lit(
            None if adapter_config is None else json.dumps(dict(adapter_config), sort_keys=True)
        )
        .cast("string")
        .alias("adapter_config"),
    )


# Manifest tables are stored by the date of the slice; those without a slice have no date.
MANIFEST_DATE = "slice_date"
MANIFEST_FORMAT = {"ignoreNullFields": "false"}
# Names of the files of a manifest table, plain or compressed, and of sidecars.
MANIFEST_FILES = "*.{json,json.gz}"


def manifest_options(compression: str) -> dict[str, str]:
    if compression not in ("none", "gzip"):
        raise ValueError(f"manifests are written plain or as gzip, not as {compression}")
    return {**MANIFEST_FORMAT, "compression": compression}


def dated_manifests(manifests: DataFrame) -> DataFrame:
    """Landing or bundle manifests with the date of their slice."""
    place = "storage" if "storage" in manifests.columns else "input"
    day = F.substring(F.col(f"{place}.slice_start"), 1, 10).cast("date")
    return manifests.withColumn(MANIFEST_DATE, day)


def write_manifests(manifests: DataFrame, path: str, compression: str = "none") -> None:
    """Append manifests to a manifest table of JSON lines, by the date of their slice.

    Manifests say much the same of every object: gzip takes a small part of the room, and a table
    may hold plain and compressed files.
    """
    (
        spread(dated_manifests(manifests), MANIFEST_DATE)
        .write.mode("append")
        .options(**manifest_options(compression))
        .partitionBy(MANIFEST_DATE)
        .json(path)
    )
