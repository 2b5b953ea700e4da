"""Readers for standardized tables, event files and manifests."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluiceway import contracts
from sluiceway.sinks.partitions import (
    dates_of,
    exists,
    is_partitioned,
    on_dates,
    replace_partitions,
)
from sluiceway.sinks.writers import (
    MANIFEST_DATE,
    MANIFEST_FILES,
    dated_manifests,
    manifest_options,
    spread,
)

CORRUPT = "_corrupt_record"


def _read_raw(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(f"{schema}, {contracts.DATE_PARTITIONS}")
        .option("basePath", root)
        .option("pathGlobFilter", "*.parquet")
        .parquet(root)
        # Folders below the date: of a bundle, which its rows name in full, and of a suffix.
        .select(*T.StructType.fromDDL(f"{schema}, {contracts.DATE_PARTITIONS}").names)
    )


def read_raw_transactions(spark: SparkSession, root: str) -> DataFrame:
    """Standardized transactions; ``year``, ``month`` and ``day`` prune directories."""
    return _read_raw(spark, root, contracts.RAW_TRANSACTIONS)


def read_raw_deliveries(spark: SparkSession, root: str) -> DataFrame:
    """Standardized deliveries; ``year``, ``month`` and ``day`` prune directories."""
    return _read_raw(spark, root, contracts.RAW_DELIVERIES)


def event_schema(with_corrupt: bool = False) -> str:
    corrupt = f", {CORRUPT} STRING" if with_corrupt else ""
    return f"{contracts.RAW_EVENTS}{corrupt}, {contracts.DATE_PARTITIONS}"


def read_stream_events(spark: SparkSession, root: str, with_corrupt: bool = False) -> DataFrame:
    """Delivered NDJSON events (gzip by file extension).

    A line that does not parse gives a row of NULLs, which staging drops with the other
    rows that have no event id; ``with_corrupt`` also keeps its text.
    """
    return (
        spark.read.schema(event_schema(with_corrupt))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", root)
        .json(root)
    )


def read_manifests(
    spark: SparkSession, path: str, schema: str, calendar: DataFrame | None = None
) -> DataFrame:
    """Manifests as rows, from sidecar files or from a manifest table's JSON files.

    With a ``calendar`` only manifests whose slice begins on a date of its slices. Of a manifest
    table only the directories of these dates are listed and read, however long its history is;
    sidecar files are all read. The calendar's dates reach the driver, as its slices do.
    """
    if calendar is None:
        return (
            spark.read.schema(schema)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", MANIFEST_FILES)
            .json(path)
        )
    last = F.col("slice_end") - F.expr("interval 1 microsecond")
    days = F.explode(F.sequence(F.to_date("slice_start"), F.to_date(last)))
    dates = dates_of(calendar.select(days.alias("day")), column="day")
    if is_partitioned(spark, path, MANIFEST_DATE):
        folders = [f"{path}/{MANIFEST_DATE}={day}" for day in dates]
        present = [folder for folder in folders if exists(spark, folder)]
        if not present:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("pathGlobFilter", MANIFEST_FILES).json(present)
    every = read_manifests(spark, path, schema)
    return dated_manifests(every).where(on_dates(MANIFEST_DATE, dates)).drop(MANIFEST_DATE)


def compact_manifests(
    spark: SparkSession,
    path: str,
    schema: str,
    dates: Sequence[date | None] | None = None,
    compression: str = "none",
) -> None:
    """Keep the newest manifest of every payload, and one file a date as far as sizes allow.

    Appending makes a file a run; this makes reading cost what the slices hold. Dates are
    replaced as a whole, all or the given ones. A manifest is newer if it was taken in or
    standardized later, then by its text.
    """
    table = spark.read.schema(f"{schema}, {MANIFEST_DATE} DATE").json(path)
    if dates is not None:
        table = table.where(on_dates(MANIFEST_DATE, dates))
    landing = "storage" in table.columns
    payload = F.col("storage.payload_key" if landing else "output.payload_key")
    stamp = "ingested_at" if landing else "standardized_at"
    names = [name for name in table.columns if name != MANIFEST_DATE]
    newest = F.max_by(
        F.struct(*names), F.struct(stamp, F.to_json(F.struct(*names)).alias("text"))
    ).alias("row")
    kept = table.groupBy(payload.alias("key"), MANIFEST_DATE).agg(newest)
    rows = spread(kept.select("row.*", MANIFEST_DATE), MANIFEST_DATE)
    options = manifest_options(compression)
    replace_partitions(rows, path, MANIFEST_DATE, dates, options, "json")


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition: str
) -> DataFrame:
    """The external Parquet table ``name`` at ``path``, with the partitions that are there now.

    Partitions that landed since are added and those that are gone are dropped, so readers by
    name see what readers by path see. A table of other columns or at another place is
    described anew; no data is touched.
    """
    database, _, _ = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = [(field.name, field.dataType.simpleString()) for field in schema.fields]
    if spark.catalog.tableExists(name) and (
        spark.table(name).dtypes != columns or not _lies_at(spark, name, path)
    ):
        spark.sql(f"DROP TABLE {name}")
    described = ", ".join(f"`{column}` {kind}" for column, kind in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({described}) USING parquet "
        f"PARTITIONED BY (`{partition}`) LOCATION '{path}'"
    )
    refresh_partitions(spark, name)
    return spark.table(name)


def _lies_at(spark: SparkSession, name: str, path: str) -> bool:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    plain = [re.sub("^[a-z0-9]+:/+", "/", place) for place in (described.first()[1], path)]
    return plain[0] == plain[1]


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Bring the partitions of an external table in line with its directories."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def sanity_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
