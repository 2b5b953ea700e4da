"""Readers for the landing area: JSON bundles, CSV deliveries, inventories."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sluiceway.functions.columns import nested_member_to_json, try_iso_to_ts
from sluiceway.functions.slices import partition_value, slice_floor
from sluiceway.operators.joins import attach_manifest_metadata
from sluiceway.operators.layout import Layout, place
from sluiceway.session import materialize

MANIFEST_SUFFIX = ".manifest.json"


def file_path() -> Column:
    """Path of the file a row comes from. Spark gives it percent-encoded."""
    encoded = F.col("_metadata.file_path")
    # url_decode also turns plus signs into blanks, so those are encoded first.
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(encoded.contains("%"), decoded).otherwise(encoded)


def landing_key(root: str, path: Column | None = None) -> Column:
    """File path relative to the landing root, by default of the row's own file."""
    path = file_path() if path is None else path
    bare = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    return F.substring(path, F.locate(bare, path) + len(bare), F.length(path))


def _is_payload(only: Column | None = None) -> Column:
    # A filter on _metadata drops files before any of them is opened.
    payload = ~F.col("_metadata.file_name").endswith(MANIFEST_SUFFIX)
    return payload if only is None else payload & only


def _with_partitions(schema: str, fields: Sequence[str]) -> str:
    # Declared as text: Spark would infer month "03" as the number 3.
    return ", ".join([schema, *[f"{field} STRING" for field in fields]])


def _reader(spark: SparkSession, recursive: bool):
    # Without partition fields the directory names carry no meaning.
    return spark.read.option("recursiveFileLookup", recursive)


def read_bundle_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    row_schema: str,
    *,
    root: str,
    json_columns: Sequence[str] = (),
    partition_fields: Sequence[str] = (),
    one_per_line: bool = False,
    only: Column | None = None,
    keep_unknown: bool = False,
) -> DataFrame:
    """One row per bundle document, its rows still nested.

    ``only`` is a condition on the file, such as ``Layout.in_folders`` of :func:`file_path`.
    A ``rows`` value that is not an array fails the read. With ``json_columns`` or
    ``keep_unknown`` the rows are text, which :func:`explode_bundles` parses.
    """
    fields = T.StructType.fromDDL(row_schema).fields
    typed = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in fields)
    element = "STRING" if json_columns or keep_unknown else f"STRUCT<{typed}>"
    envelope = (
        f"row_count BIGINT, schema_version STRING, scenario_name STRING, rows ARRAY<{element}>"
    )
    return (
        _reader(spark, recursive=not partition_fields)
        .schema(_with_partitions(envelope, partition_fields))
        .option("multiLine", not one_per_line)
        .option("mode", "FAILFAST")
        .option("basePath", root)
        .json(paths)
        .where(_is_payload(only))
        .select("*", landing_key(root).alias("_landing_key"))
    )


def explode_bundles(
    documents: DataFrame,
    row_schema: str,
    json_columns: Sequence[str] = (),
    keep_unknown: bool = False,
) -> DataFrame:
    """One output row per bundle row, carrying the document's own columns.

    Nested values of ``json_columns`` become text with their numbers as landed. Keys outside
    ``row_schema`` are dropped, or kept as text in ``_extra`` with ``keep_unknown``. Rows that are
    text are parsed here, one by one: within an array of rows every column would parse its row
    again. A row that is not an object fails the query.
    """
    carried = [name for name in documents.columns if name not in _ENVELOPE]
    rows = documents.select(
        F.explode("rows").alias("_row"),
        F.col("schema_version").alias("_schema_version"),
        F.col("scenario_name").alias("_scenario_name"),
        F.col("row_count").alias("_response_row_count"),
        *carried,
    )
    others = [name for name in rows.columns if name != "_row"]
    fields = T.StructType.fromDDL(row_schema).fields
    if not (json_columns or keep_unknown):
        return rows.select(*[F.col(f"_row.{f.name}") for f in fields], *others)
    text = F.col("_row")
    checked = F.when(text.isNull() | F.ltrim(text).startswith("{"), text).otherwise(
        F.raise_error(F.concat(F.lit("a bundle row is not an object: "), text)).cast("string")
    )
    schema = ", ".join(
        f"`{f.name}` {'STRING' if f.name in json_columns else f.dataType.simpleString()}"
        for f in fields
    )
    parsed = rows.withColumn("_typed", F.from_json(checked, schema, {"mode": "FAILFAST"}))
    values = [
        nested_member_to_json("_row", f.name, f"_typed.{f.name}").alias(f.name)
        if f.name in json_columns
        else F.col(f"_typed.{f.name}").alias(f.name)
        for f in fields
    ]
    if keep_unknown:
        known = F.array(*[F.lit(f.name) for f in fields])
        extra = F.map_filter(
            F.from_json(text, "map<string,string>"),
            lambda name, _: ~F.array_contains(known, name),
        )
        values.append(extra.alias("_extra"))
    return parsed.select(*values, *others)


_ENVELOPE = ("rows", "row_count", "schema_version", "scenario_name")


def read_json_bundles(
    spark: SparkSession,
    paths: str | Sequence[str],
    row_schema: str,
    *,
    root: str,
    json_columns: Sequence[str] = (),
    partition_fields: Sequence[str] = (),
    one_per_line: bool = False,
    keep_unknown: bool = False,
) -> DataFrame:
    """Rows of all bundle documents under the paths, with their landing key."""
    documents = read_bundle_documents(
        spark,
        paths,
        row_schema,
        root=root,
        json_columns=json_columns,
        partition_fields=partition_fields,
        one_per_line=one_per_line,
        keep_unknown=keep_unknown,
    )
    return explode_bundles(documents, row_schema, json_columns, keep_unknown)


def read_csv_delivery(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    *,
    root: str,
    partition_fields: Sequence[str] = (),
    only: Column | None = None,
    quoted_newlines: bool = True,
) -> DataFrame:
    """Rows of CSV files with a header, all text, empty values NULL.

    ``columns`` is the header the files carry, in order; a file with another header fails
    the read instead of shifting values. Large files are split between tasks; with
    ``quoted_newlines`` by :func:`csv_records`, which costs a pass over the text and a shuffle.
    """
    reader = _reader(spark, recursive=not partition_fields).option("basePath", root)
    schema = ", ".join(f"`{name}` STRING" for name in columns)
    key = landing_key(root).alias("_landing_key")
    if quoted_newlines:
        texts = reader.schema(_with_partitions("value STRING", partition_fields))
        lines = texts.option("lineSep", "\n").text(paths).where(_is_payload(only))
        rows = _parsed(csv_records(lines, [key, *partition_fields]), columns)
        key = F.col("_landing_key")
    else:
        rows = (
            reader.schema(_with_partitions(schema, partition_fields))
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .csv(paths)
            .where(_is_payload(only))
        )
    values = [F.nullif(F.col(name), F.lit("")).alias(name) for name in columns]
    return rows.select(*values, key, *partition_fields)


def csv_records(lines: DataFrame, keep: Sequence[Column | str]) -> DataFrame:
    """Records of CSV files read as lines: ``record``, its ``number`` in the file from 1, and the
    ``keep`` columns, which are constant in a file.

    A line break belongs to a value if the quotes before it in the file are odd in number
    (quotes inside values are doubled). Each split of a file counts its quotes; sums over the
    splits before it say whether a split begins inside a value, and sums over the lines of a split
    say where its records begin. Only lines of records that have several are gathered.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    file = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
    ]
    kept = [column if isinstance(column, Column) else F.col(column) for column in keep]
    split = Window.partitionBy("_file").orderBy("_split")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("_quotes").over(before), F.lit(0)), F.lit(2))
    begun = (
        lines.select(*file, quotes.alias("_quotes"))
        .groupBy("_file", "_split")
        .agg(F.sum("_quotes").alias("_quotes"))
        .select("_file", "_split", inside.alias("_inside"))
    )
    # Lines of a split are in order in its task.
    numbered = lines.select(
        "value",
        *kept,
        *file,
        quotes.alias("_quotes"),
        F.monotonically_increasing_id().alias("_line"),
    )
    names = numbered.columns[1 : 1 + len(kept)]
    line = Window.partitionBy("_file", "_split").orderBy("_line")
    earlier = F.sum("_quotes").over(line.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.pmod(F.col("_inside") + F.coalesce(earlier, F.lit(0)), F.lit(2)) == 0
    placed = materialize(
        numbered.join(begun, ["_file", "_split"])
        .withColumn("_begins", begins)
        .withColumn("_number", F.count_if("_begins").over(line)),
        "csv-lines",
    )
    # Records that began in earlier splits; a line that goes on belongs to the last of them.
    started = (
        placed.groupBy("_file", "_split")
        .agg(F.max("_number").alias("_started"))
        .select(
            "_file",
            "_split",
            F.coalesce(F.sum("_started").over(before), F.lit(0)).alias("_before"),
        )
    )
    lines = placed.join(started, ["_file", "_split"]).withColumn(
        "number", F.col("_before") + F.col("_number")
    )
    whole = F.col("_begins") & (F.pmod("_quotes", F.lit(2)) == 0)
    in_order = F.sort_array(F.collect_list(F.struct("_split", "_line", "value")))
    gathered = (
        lines.where(~whole)
        .groupBy("_file", "number", *names)
        .agg(F.array_join(F.transform(in_order, lambda part: part["value"]), "\n").alias("record"))
    )
    parts = [lines.where(whole).withColumnRenamed("value", "record"), gathered]
    one, several = [part.select("record", "number", *names) for part in parts]
    record = F.regexp_replace("record", "\r$", "")
    return one.unionByName(several).withColumn("record", record)


def _parsed(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of the records; the first of a file is its header, which must be ``columns``."""
    schema = ", ".join(f"`{name}` STRING" for name in [*columns, "_more"])
    rows = records.where(F.trim("record") != "").withColumn(
        "_row", F.from_csv("record", schema, {"escape": '"'})
    )
    row = F.col("_row")
    same = row["_more"].isNull()
    for name in columns:
        same = same & (F.lower(F.coalesce(row[name], F.lit(""))) == name.lower())
    wrong = F.raise_error(F.concat(F.lit("another header than declared: "), "record"))
    is_row = F.when(F.col("number") > 1, F.lit(True)).otherwise(
        F.when(same, F.lit(False)).otherwise(wrong.cast("boolean"))
    )
    others = [name for name in records.columns if name not in ("record", "number")]
    return rows.where(is_row).select("_row.*", *others).drop("_more")


def list_manual_prefix(spark: SparkSession, prefix: str, *, root: str) -> DataFrame:
    """Key, path and length of every payload object below a prefix, whatever its directories
    are called. No object is opened. Spark lists no empty objects."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(prefix)
        .where(~F.col("path").endswith(MANIFEST_SUFFIX))
        .select(landing_key(root, F.col("path")).alias("_landing_key"), "path", "length")
    )


def read_manual_prefix(
    spark: SparkSession,
    prefix: str,
    *,
    root: str,
    piece_bytes: int = 64 << 20,
    filesystem: Callable[[str], tuple[FileSystem, str]] | None = None,
) -> DataFrame:
    """Every payload object below a prefix as numbered pieces of its bytes.

    The listing gives the ranges, ``piece_bytes`` long but for the last of an object, and tasks
    read one range at a time, so objects may be of any size and a large one is read by many
    tasks. Empty objects have no piece. An object that is shorter than listed fails the read.
    ``filesystem`` maps ``scheme://authority/`` to a file system of Arrow and its base path;
    by default Arrow finds it by the scheme.
    """
    if not 0 < piece_bytes <= 1 << 30:
        raise ValueError("piece_bytes must be from 1 to 2^30")
    size = F.lit(piece_bytes).cast("long")
    last = F.expr(f"(length - 1) div {piece_bytes}")
    ranges = list_manual_prefix(spark, prefix, root=root).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    )
    # Rows of ranges are tiny: left to itself, Spark would put them all into one task.
    tasks = max(1, min(ranges.count(), 16 * spark.sparkContext.defaultParallelism))
    start = F.col("piece") * size
    planned = ranges.select(
        "_landing_key",
        "path",
        "length",
        "piece",
        start.alias("start"),
        F.least(size, F.col("length") - start).alias("size"),
    ).repartition(tasks, "path", "piece")

    def opened(path: str) -> tuple[FileSystem, str]:
        scheme, colon, rest = path.partition(":")
        if not colon or scheme == "file":
            return LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
        authority, _, inner = rest.lstrip("/").partition("/")
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        files, base = (filesystem or FileSystem.from_uri)(f"{scheme}://{authority}/")
        return files, f"{base.rstrip('/')}/{inner}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = opened(row["path"])
                with files.open_input_file(path) as source:
                    payload = source.read_at(row["size"], row["start"])
                if len(payload) != row["size"]:
                    raise OSError(f"{row['path']} is shorter than listed")
                yield pa.RecordBatch.from_pydict(
                    {
                        "_landing_key": pa.array([row["_landing_key"]], pa.string()),
                        "length": pa.array([row["length"]], pa.int64()),
                        "piece": pa.array([row["piece"]], pa.int64()),
                        "start": pa.array([row["start"]], pa.int64()),
                        "payload": pa.array([payload], pa.binary()),
                    }
                )

    return planned.mapInArrow(
        read, "_landing_key STRING, length BIGINT, piece BIGINT, start BIGINT, payload BINARY"
    )


def piece_lines(pieces: DataFrame) -> DataFrame:
    """Lines of the objects that :func:`read_manual_prefix` gives: key, number from 0, bytes.

    A line ends at each line feed and may reach over any number of pieces; what follows the last
    line feed of an object is a line if it is not empty. Line feeds are counted by piece, sums over
    the pieces before give the numbers, and only the ends of pieces are gathered.
    """
    # One character per byte, so that pieces may end within a character.
    parts = F.split(F.decode("payload", "ISO-8859-1"), "\n", -1)
    order = Window.partitionBy("_landing_key").orderBy("piece")
    before = F.sum("_breaks").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = pieces.select(
        "_landing_key", "piece", (F.size(parts) - 1).cast("long").alias("_breaks")
    ).select(
        "_landing_key",
        "piece",
        "_breaks",
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_breaks").over(Window.partitionBy("_landing_key")).alias("_all"),
    )
    fragments = (
        pieces.select("_landing_key", "piece", F.posexplode(parts).alias("_at", "_text"))
        .join(starts, ["_landing_key", "piece"])
        .withColumn("number", F.col("_before") + F.col("_at"))
    )
    whole = (F.col("_at") > 0) & (F.col("_at") < F.col("_breaks"))
    in_order = F.sort_array(F.collect_list(F.struct("piece", "_text")))
    gathered = (
        fragments.where(~whole)
        .groupBy("_landing_key", "number", "_all")
        .agg(F.array_join(F.transform(in_order, lambda part: part["_text"]), "").alias("_text"))
        .where((F.col("number") < F.col("_all")) | (F.col("_text") != ""))
    )
    line = F.encode("_text", "ISO-8859-1").alias("line")
    columns = ["_landing_key", "number", line]
    return fragments.where(whole).select(*columns).unionByName(gathered.select(*columns))


def read_manual_lines(spark: SparkSession, prefix: str, *, root: str) -> DataFrame:
    """One row per text line of the payload objects below a prefix, split by Spark."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(prefix)
        .where(_is_payload())
        .select(landing_key(root).alias("_landing_key"), F.col("value").alias("line"))
    )


def slice_paths(
    root: str, calendar: DataFrame, partition_fields: Sequence[str], granularity: str
) -> str:
    """Glob of the directories that the calendar's slices can be in.

    Only these are listed, however many they are, so a run costs what its slices hold and
    not what the landing area holds.
    """
    names = Layout("hour", tuple(partition_fields)).directories(calendar, granularity)
    return root if names == [""] else f"{root}/{{{','.join(names)}}}"


def keep_selected(
    objects: DataFrame,
    calendar: DataFrame,
    *,
    partition_fields: Sequence[str],
    granularity: str,
    logical_date: Column,
) -> DataFrame:
    """Landed objects that belong to a slice of the calendar, with the slice columns.

    An object qualifies if it lies under the slice's path prefix and its logical date is
    inside the slice or unknown. Matching the prefix is an equi-join on its fields.
    """
    prefix = Layout("hour", tuple(partition_fields)).constant(granularity)
    inside = (logical_date >= F.col("slice_start")) & (logical_date < F.col("slice_end"))
    if not prefix:
        no_place = F.raise_error(
            F.lit("the landing layout cannot place an object that has no logical date")
        )
        start = F.coalesce(slice_floor(logical_date, granularity), no_place.cast("timestamp"))
        return objects.withColumn("slice_start", start).join(calendar, "slice_start", "inner")
    slices = calendar.withColumns(
        {field: partition_value("slice_start", field) for field in prefix}
    )
    return objects.join(slices, list(prefix), "inner").where(logical_date.isNull() | inside)


def keep_dated(
    objects: DataFrame, calendar: DataFrame, granularity: str, logical_date: Column
) -> DataFrame:
    """Objects by the slice of their logical date; one without a date goes to every slice.

    The calendar comes from selector parameters and is small, so its slices are held as an
    array for the objects without a date.
    """
    names = ["slice_start", "slice_end", "granularity", "run_id"]
    slices = calendar.select(*names).collect()
    held = F.array(
        *[F.struct(*[F.lit(row[name]).alias(name) for name in names]) for row in slices]
    )
    everywhere = (
        objects.where(logical_date.isNull())
        .withColumn("_slice", F.explode(held))
        .select(*objects.columns, "_slice.*")
    )
    dated = objects.withColumn("slice_start", slice_floor(logical_date, granularity))
    placed = dated.where(logical_date.isNotNull()).join(calendar.select(*names), "slice_start")
    return placed.unionByName(everywhere) if slices else placed


INVENTORY = """
    slice_start TIMESTAMP, slice_end TIMESTAMP, granularity STRING, run_id STRING,
    _landing_key STRING, length BIGINT, _metadata_map MAP<STRING, STRING>
"""


def landing_inventory(
    spark: SparkSession,
    root: str,
    calendar: DataFrame,
    *,
    partition_fields: Sequence[str],
    granularity: str,
    suffix: Sequence[str] = (),
    manifests: DataFrame | None = None,
    key_root: str | None = None,
    input_prefix: str | None = None,
) -> DataFrame:
    """Landed objects per slice: slice columns, key, size and manifest metadata.

    Lists files; no payload is read. With a ``suffix`` only objects directly in that folder
    of a time directory count. Keys are relative to ``key_root``, by default the listed
    root.

    With an ``input_prefix`` below it all objects lie there, whatever their slice: the logical
    date of an object's manifest says which slice it belongs to, and an object without one
    belongs to every slice of the calendar.
    """
    if input_prefix is not None:
        partition_fields, suffix = (), ()
    layout = Layout("hour", tuple(partition_fields), tuple(suffix))
    path = F.col("path")
    key_root = key_root or root
    listed = slice_paths(root, calendar, partition_fields, granularity)
    if input_prefix is not None:
        listed = place(key_root, input_prefix)
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(listed)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], INVENTORY)
        raise
    wanted = ~path.endswith(MANIFEST_SUFFIX) & layout.in_folders(path)
    objects = files.where(wanted).select(
        landing_key(key_root, path).alias("_landing_key"),
        "length",
        *[F.regexp_extract(path, f"/{f}=([^/]*)/", 1).alias(f) for f in partition_fields],
    )
    if manifests is None:
        empty = F.create_map().cast("map<string,string>")
        objects = objects.withColumn("_metadata_map", empty)
    else:
        objects = attach_manifest_metadata(objects, manifests)
    logical_date = try_iso_to_ts(F.col("_metadata_map")["logical_date"])
    if input_prefix is not None:
        chosen = keep_dated(objects, calendar, granularity, logical_date)
    else:
        chosen = keep_selected(
            objects,
            calendar,
            partition_fields=partition_fields,
            granularity=granularity,
            logical_date=logical_date,
        )
    return chosen.select(
        "slice_start",
        "slice_end",
        "granularity",
        "run_id",
        "_landing_key",
        "length",
        "_metadata_map",
    )
