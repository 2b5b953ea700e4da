"""Sources, sinks and standardize jobs as queries: write the given tables out, read back."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway import contracts
from sluiceway.functions.aggregates import count_all
from sluiceway.functions.columns import iso_to_ts
from sluiceway.operators.calendar import SliceSelector, slice_calendar
from sluiceway.operators.joins import attach_manifest_metadata
from sluiceway.operators.layout import partition_columns
from sluiceway.plans import events as evt
from sluiceway.plans import standardize as std
from sluiceway.registry.adapters import raw_deliveries, raw_events, raw_transactions, table
from sluiceway.registry.oracle import with_ctes
from sluiceway.session import materialize, scratch_dir
from sluiceway.sinks import writers
from sluiceway.sources import landing, tables

QUERIES = {}
SQL = {}
STAMP = datetime(2026, 1, 1, tzinfo=timezone.utc)


def query(name: str, sql: str, *ctes: str):
    def register(function):
        QUERIES[name] = function
        SQL[name] = with_ctes(sql, *ctes) if ctes else sql
        return function

    return register


_TXN_NAMES = contracts.names(contracts.TRANSACTION_ROW)
_TXN_ROW = ", ".join(_TXN_NAMES)
_DLV_ROW = ", ".join(contracts.DELIVERY_FIELDS)

# Sources ----------------------------------------------------------------------------


def land_transactions(spark: SparkSession, sf_dir: str, fields=("year",)) -> str:
    """All raw transactions as JSON bundle documents under their logical date."""
    root = scratch_dir(spark, "landing-json")
    rows = raw_transactions(spark, sf_dir).withColumn(
        "ts", F.date_trunc("month", iso_to_ts("_logical_date"))
    )
    documents = writers.bundle_documents(
        rows, _TXN_NAMES, schema_version="v1", scenario_name="lineitem", keep=["ts"]
    )
    # Plain text takes some twelve times the room of its gzip, and 17 times that of the table.
    writers.write_landing(
        documents, root, "ts", fields=fields, granularity="month", compression="gzip"
    )
    return root


def land_deliveries(spark: SparkSession, sf_dir: str, fields=("year", "month")) -> str:
    """All raw deliveries as CSV files under their logical date."""
    root = scratch_dir(spark, "landing-csv")
    rows = partition_columns(
        raw_deliveries(spark, sf_dir), iso_to_ts("_logical_date"), fields
    )
    writers.write_csv_delivery(
        writers.spread(rows, *fields), root, contracts.DELIVERY_FIELDS, partition_by=fields
    )
    return root


@query(
    "read_json_bundles",
    f"""select {_TXN_ROW}, 'v1' as _schema_version, 'lineitem' as _scenario_name,
      'year=' || strftime(_logical_date::timestamp, '%Y') || '/' as landing_folder,
      true as row_count_fits, strftime(_logical_date::timestamp, '%Y') as year from raw_txn""",
    "raw_txn",
)
def read_json_bundles(spark, sf_dir):
    """Names of landed files and the cut into documents are Spark's; the folder of the key is not."""
    root = land_transactions(spark, sf_dir)
    rows = landing.read_json_bundles(
        spark,
        root,
        contracts.TRANSACTION_ROW,
        root=root,
        json_columns=contracts.TRANSACTION_JSON_COLUMNS,
        partition_fields=("year",),
        one_per_line=True,
    )
    return rows.select(
        "*",
        F.regexp_extract("_landing_key", "^(.*/)[^/]+$", 1).alias("landing_folder"),
        F.col("_response_row_count").between(1, 250).alias("row_count_fits"),
    ).drop("_landing_key", "_response_row_count")


@query(
    "read_csv_delivery",
    f"select {_DLV_ROW}, strftime(_logical_date::timestamp, '%Y') as year, "
    "strftime(_logical_date::timestamp, '%m') as month from raw_dlv",
    "raw_dlv",
)
def read_csv_delivery(spark, sf_dir):
    root = land_deliveries(spark, sf_dir)
    return landing.read_csv_delivery(
        spark,
        root,
        contracts.DELIVERY_FIELDS,
        root=root,
        partition_fields=("year", "month"),
        quoted_newlines=False,
    ).drop("_landing_key")


def _land_events(spark: SparkSession, sf_dir: str) -> str:
    """All events as text payloads under the day of their time stamp."""
    root = scratch_dir(spark, "landing-events")
    payloads = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_json(F.struct("event_id", "event_type")).alias("payload"),
    )
    writers.write_landing(payloads, root, "ts")
    return root


@query(
    "landing_inventory",
    """select slice_start, slice_start + interval 1 day as slice_end, 'day' as granularity,
      strftime(slice_start, 'year=%Y/month=%m/day=%d/') as folder, sum(length) as length
    from (select date_trunc('day', ts)::timestamp as slice_start, strlen('{"event_id":' || event_id
        || ',"event_type":"' || event_type || '"}') + 1 as length from events)
    where slice_start between timestamp '2024-01-03' and timestamp '2024-02-10'
    group by slice_start""",
)
def landing_inventory(spark, sf_dir):
    """Objects of a range of days, summed up by folder: the names of the files are Spark's."""
    root = _land_events(spark, sf_dir)
    selector = SliceSelector("day", range_start="2024-01-03", range_end="2024-02-10")
    calendar = slice_calendar(spark, selector)
    found = landing.landing_inventory(
        spark, root, calendar, partition_fields=("year", "month", "day"), granularity="day"
    )
    folder = F.regexp_extract("_landing_key", "^(.*/)[^/]+$", 1)
    return found.groupBy("slice_start", "slice_end", "granularity", folder.alias("folder")).agg(
        F.sum("length").cast("bigint").alias("length")
    )


@query(
    "landing_inventory_by_prefix",
    """with slices as (select unnest(generate_series(timestamp '2024-01-03',
      timestamp '2024-02-10', interval 1 day)) as slice_start),
    objects as (select distinct date_trunc('day', ts)::timestamp as day,
      extract(day from ts) % 7 = 0 as undated from events)
    select slice_start, strftime(day, 'dropped/%Y-%m-%d/') as folder
    from slices join objects on undated or day = slice_start""",
)
def landing_inventory_by_prefix(spark, sf_dir):
    """All objects under one prefix: manifests say their dates, those without go everywhere."""
    root = scratch_dir(spark, "landing-dropped")
    ts = F.col("ts").cast("timestamp")
    payloads = table(spark, sf_dir, "events").select(
        F.date_format(ts, "yyyy-MM-dd").alias("dropped"), F.col("event_id").cast("string")
    )
    # A folder a day that is no time field; Spark names it, so its key is made from the listing.
    payloads.write.partitionBy("dropped").text(f"{root}/all")
    calendar = slice_calendar(
        spark, SliceSelector("day", range_start="2024-01-03", range_end="2024-02-10")
    )
    day = F.regexp_extract("_landing_key", "dropped=([0-9-]+)/", 1)
    keys = landing.read_manual_lines(spark, f"{root}/all", root=root).select(
        "_landing_key", day.alias("day")
    ).distinct()
    dated = F.dayofmonth(F.to_date("day")) % 7 != 0
    objects = keys.where(dated).select(
        F.col("day").alias("run_id"),
        F.lit("text/plain").alias("content_type"),
        F.create_map(F.lit("preset_id"), F.lit("events")).alias("metadata"),
        F.col("day").cast("timestamp").alias("ingested_at"),
        F.lit(None).cast("string").alias("suggested_object_name"),
        F.col("day").cast("timestamp").alias("slice_start"),
        (F.col("day").cast("timestamp") + F.make_interval(days=F.lit(1))).alias("slice_end"),
        F.col("_landing_key").alias("payload_key"),
    )
    manifests = writers.landing_manifests(
        objects,
        workflow_name="events",
        source_adapter="table",
        selector_mode="pinned",
        granularity="day",
    )
    found = landing.landing_inventory(
        spark,
        root,
        calendar,
        partition_fields=("year", "month", "day"),
        granularity="day",
        manifests=manifests,
        input_prefix="all",
    )
    folder = F.concat(F.lit("dropped/"), day, F.lit("/"))
    return found.select("slice_start", folder.alias("folder")).distinct()


_CONVERSATION = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


@query("read_manual_prefix", "select conv_id, turn, role, text from conversations")
def read_manual_prefix(spark, sf_dir):
    root = scratch_dir(spark, "landing-manual")
    payloads = table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("payload")
    )
    prefix = writers.write_landing(payloads, root, None, base_prefix="client=a/resend")
    # Pieces far shorter than the objects, so that lines and characters reach over their ends.
    pieces = landing.read_manual_prefix(spark, prefix, root=root, piece_bytes=10_007)
    lines = landing.piece_lines(pieces).select(F.col("line").cast("string").alias("line"))
    return lines.select(F.from_json("line", _CONVERSATION).alias("row")).select("row.*")


def _raw_columns(cte: str) -> str:
    ts = "_logical_date::timestamp"
    return (
        f"select *, strftime({ts}, '%Y') as year, strftime({ts}, '%m') as month, "
        f"'01' as day from {cte}"
    )


def _write_raw(raw: DataFrame, label: str) -> str:
    """Raw rows under the first day of their month, as monthly bundles would be."""
    root = scratch_dir(raw.sparkSession, label)
    writers.write_bundle(raw, root, F.date_trunc("month", iso_to_ts("_logical_date")))
    return root


query("read_raw_transactions", _raw_columns("raw_txn"), "raw_txn")(
    lambda s, d: tables.read_raw_transactions(s, _write_raw(raw_transactions(s, d), "raw-txn"))
)
query("read_raw_deliveries", _raw_columns("raw_dlv"), "raw_dlv")(
    lambda s, d: tables.read_raw_deliveries(s, _write_raw(raw_deliveries(s, d), "raw-dlv"))
)


@query("read_stream_events", "select * from evt_staged", "evt_staged")
def read_stream_events(spark, sf_dir):
    """Events without an id are landed as broken text, which must not survive staging."""
    root = scratch_dir(spark, "events-gz")
    whole = F.to_json(F.struct(*contracts.names(contracts.RAW_EVENTS)))
    text = F.when(F.col("emitter_event_id").isNotNull(), whole).otherwise(
        F.concat(F.lit('{"broken": '), whole)
    )
    payloads = raw_events(spark, sf_dir).select(
        iso_to_ts("emitted_at").alias("ts"), text.alias("payload")
    )
    writers.write_landing(payloads, root, "ts", compression="gzip")
    raw = tables.read_stream_events(spark, root)
    return evt.stg_sensor_events(raw)


# Sinks ------------------------------------------------------------------------------


@query(
    "write_bundle",
    """select event_id, event_type, value, strftime(ts, '%Y') as year, strftime(ts, '%m') as month,
      strftime(ts, '%d') as day, 'events' as api from events""",
)
def write_bundle(spark, sf_dir):
    root = scratch_dir(spark, "bundle")
    rows = table(spark, sf_dir, "events")
    writers.write_bundle(
        rows.select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")),
        root,
        "ts",
        suffix=("api=events",),
    )
    schema = "event_id BIGINT, event_type STRING, value DOUBLE"
    return spark.read.schema(f"{schema}, {contracts.DATE_PARTITIONS}, api STRING").parquet(root)


def _event_bundles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as bundles of a day: rows, one row per bundle, and the inputs of each.

    The landing key of an event is its hour, so a day has up to 24 input objects.
    """
    ts = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").select(
        F.date_format(ts, "yyyy-MM-dd").alias("run_id"),
        F.date_trunc("day", ts).alias("slice_start"),
        F.date_format(ts, "'hour='HH'.json'").alias("landing_key"),
        "event_id",
    )
    inputs = rows.select(
        "run_id", "slice_start", F.col("landing_key").alias("_landing_key")
    ).distinct()
    key = F.concat(F.lit("slice_id="), F.col("run_id"), F.lit(".parquet"))
    bundles = (
        std.bundle_summary(rows, inputs)
        .withColumn("slice_start", F.col("run_id").cast("timestamp"))
        .withColumns(
            {
                "slice_end": F.col("slice_start") + F.make_interval(days=F.lit(1)),
                "granularity": F.lit("day"),
                "bundle_key": F.concat(F.lit("raw/"), key),
                "manifest_key": F.concat(F.lit("raw/_"), key, F.lit(".manifest.json")),
            }
        )
    )
    return rows, materialize(bundles, "event-bundles"), inputs


_BUNDLE_SQL = """
with days as (
  select strftime(ts, '%Y-%m-%d') as run_id, date_trunc('day', ts)::timestamp as slice_start,
    count(*) as row_count, count(distinct hour(ts)) as object_count
  from events group by 1, 2)
"""


@query(
    "annotate_bundle",
    _BUNDLE_SQL
    + """select event_id, run_id as _raw_bundle_id, 'raw/slice_id=' || run_id || '.parquet' as _raw_bundle_key,
      'raw/_slice_id=' || run_id || '.parquet.manifest.json' as _raw_bundle_manifest_key,
      '2026-01-01T00:00:00+00:00' as _raw_standardized_at,
      run_id || 'T00:00:00+00:00' as _raw_bundle_logical_date,
      'day' as _raw_bundle_granularity, object_count as _raw_input_object_count,
      row_count as _raw_bundle_row_count
    from events join days on date_trunc('day', ts) = slice_start""",
)
def annotate_bundle(spark, sf_dir):
    rows, bundles, _ = _event_bundles(spark, sf_dir)
    return std.annotate_bundle(rows.select("run_id", "event_id"), bundles, STAMP).drop(
        "run_id", "slice_start"
    )


_EVENT_JOB = std.StandardizeJob(
    standardizer="json_bundle",
    preset_id="events",
    landing_root="landing",
    processed_root="processed",
    manifest_root="manifests",
    workflow_name="events",
)


def _bundle_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "bundle-manifests")
    _, bundles, _ = _event_bundles(spark, sf_dir)
    writers.write_manifests(std.bundle_manifests(bundles, _EVENT_JOB, STAMP, "range"), path)
    return tables.read_manifests(spark, path, contracts.BUNDLE_MANIFEST)


@query(
    "write_bundle_manifest",
    _BUNDLE_SQL
    + """, keys as (select strftime(ts, '%Y-%m-%d') as run_id,
      'hour=' || strftime(ts, '%H') || '.json' as landing_key, count(*) as n_rows
      from events group by all)
    select run_id, landing_key, n_rows, '1' as schema_version, 'events' as workflow_name,
      'json_bundle' as standardize_strategy, 'temporal' as mode, 'range' as slice_selector_mode,
      object_count, row_count, 'year,month,day' as partition_fields, 'api=events' as path_suffix,
      'raw/slice_id=' || run_id || '.parquet' as payload_key,
      'raw/_slice_id=' || run_id || '.parquet.manifest.json' as manifest_key,
      run_id || 'T00:00:00+00:00' as slice_start, 'day' as slice_granularity,
      'application/x-parquet' as content_type
    from days join keys using (run_id)""",
)
def write_bundle_manifest(spark, sf_dir):
    """The manifest of every bundle with its input keys, which are rows of their own."""
    root = scratch_dir(spark, "bundle-inputs")
    job = replace(_EVENT_JOB, manifest_root=root, processed_suffix=("api=events",))
    rows, bundles, inputs = _event_bundles(spark, sf_dir)
    writers.write_manifests(
        std.bundle_manifests(bundles, job, STAMP, "range"), f"{root}/bundles"
    )
    std.write_bundle_inputs(inputs, job)
    keys = spark.read.schema(contracts.BUNDLE_INPUTS).parquet(f"{root}/inputs")
    counts = rows.groupBy("run_id", "landing_key").agg(count_all().alias("n_rows"))
    manifests = tables.read_manifests(spark, f"{root}/bundles", contracts.BUNDLE_MANIFEST).select(
        "input.run_id",
        "schema_version",
        "workflow_name",
        "standardize_strategy",
        "input.mode",
        "input.slice_selector_mode",
        "input.object_count",
        "input.slice_start",
        "input.slice_granularity",
        "output.row_count",
        F.array_join("output.partition_fields", ",").alias("partition_fields"),
        F.array_join("output.path_suffix", ",").alias("path_suffix"),
        "output.payload_key",
        "output.manifest_key",
        "output.content_type",
    )
    counted = keys.drop("slice_start").join(counts, ["run_id", "landing_key"])
    return counted.join(manifests, "run_id")


@query(
    "read_manifests",
    _BUNDLE_SQL
    + """select workflow_name, standardize_strategy, planning_mode, standardized_at, run_id,
      object_count, logical_date, slice_end, payload_key, row_count, preset_id
    from (select 'events' as workflow_name, 'json_bundle' as standardize_strategy,
      'temporal' as planning_mode, '2026-01-01T00:00:00+00:00' as standardized_at, run_id,
      object_count, run_id || 'T00:00:00+00:00' as logical_date,
      strftime(slice_start + interval 1 day, '%Y-%m-%dT00:00:00+00:00') as slice_end,
      'raw/slice_id=' || run_id || '.parquet' as payload_key, row_count, 'events' as preset_id
      from days)""",
)
def read_manifests(spark, sf_dir):
    return _bundle_manifests(spark, sf_dir).select(
        "workflow_name",
        "standardize_strategy",
        "planning_mode",
        "standardized_at",
        "input.run_id",
        "input.object_count",
        "input.logical_date",
        "input.slice_end",
        "output.payload_key",
        "output.row_count",
        F.col("output.metadata")["preset_id"].alias("preset_id"),
    )


@query(
    "write_landing",
    """select o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') as year,
      'Q' || quarter(o_orderdate) as quarter from orders""",
)
def write_landing(spark, sf_dir):
    root = scratch_dir(spark, "landing")
    payloads = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.to_json(F.struct("o_orderkey", "o_orderstatus")).alias("payload"),
    )
    path = writers.write_landing(
        payloads, root, "ts", fields=("year", "quarter"), base_prefix="client=a", granularity="day"
    )
    lines = spark.read.schema("value STRING, year STRING, quarter STRING").text(path)
    parsed = F.from_json("value", "o_orderkey BIGINT, o_orderstatus STRING")
    return lines.select(parsed.alias("row"), "year", "quarter").select("row.*", "year", "quarter")


def _order_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a landed object of its month."""
    order = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        order.cast("string").alias("run_id"),
        F.when(order % 2 == 0, "application/vnd.orders+json; charset=utf-8")
        .otherwise("text/csv")
        .alias("content_type"),
        F.create_map(F.lit("preset_id"), F.col("o_orderstatus")).alias("metadata"),
        day.alias("ingested_at"),
        F.when(order % 5 == 0, F.concat(F.lit("order-"), order.cast("string"), F.lit(".csv"))).alias(
            "suggested_object_name"
        ),
        F.date_trunc("month", day).alias("slice_start"),
        F.add_months(F.date_trunc("month", day), 1).cast("timestamp").alias("slice_end"),
    )


def _landing_manifests(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    """One manifest per order, read back from the manifest table."""
    path = scratch_dir(spark, "landing-manifests")
    settings = {
        "selector_mode": "pinned",
        "granularity": "month",
        "fields": ("year", "month"),
        "base_prefix": "client=a",
        "suffix": ("api=orders",),
        **settings,
    }
    manifests = writers.landing_manifests(
        _order_objects(spark, sf_dir), workflow_name="orders", source_adapter="table", **settings
    )
    writers.write_manifests(manifests, path, compression="gzip")
    return tables.read_manifests(spark, path, contracts.LANDING_MANIFEST)


_MANIFEST_SQL = """
with named as (
  select *, case when o_orderkey % 5 = 0 then 'order-' || o_orderkey || '.csv'
      else 'run_id=' || o_orderkey || case when o_orderkey % 2 = 0 then '.json' else '.csv' end
      end as name,
    case when o_orderkey % 5 = 0 then 'order-' || o_orderkey || '.csv'
      else 'run_id=' || o_orderkey end as stem,
    'client=a/year=' || strftime(o_orderdate, '%Y') || '/month=' || strftime(o_orderdate, '%m')
      || '/api=orders/' as folder
  from orders)
"""


_MONTH = "date_trunc('month', o_orderdate)"


def _stamp_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00')"


def _kind_sql(kind: str, mode: str | None, name: str, stem: str, folder: str, **fields: str) -> str:
    """Manifest fields of one kind of request, for every order."""
    dated = mode is not None
    values = {
        "kind": f"'{kind}'",
        "run_id": "cast(o_orderkey as varchar)",
        "payload_key": f"{folder} || {name}",
        "manifest_key": f"{folder} || '_' || {stem} || '.manifest.json'",
        "planning_mode": "'temporal'" if dated else "'manual'",
        "selector": f"'{mode}'" if dated else "null::varchar",
        "logical_date": _stamp_sql(_MONTH) if dated else "null::varchar",
        "slice_end": _stamp_sql(f"{_MONTH} + interval 1 month") if dated else "null::varchar",
        "object_name_override": "null::varchar",
        "resolved_storage_prefix": "null::varchar",
        "adapter_config": "null::varchar",
        "requested_start": "null::varchar",
        "matched_start": "null::varchar",
        "slice_count": "null::bigint",
        "first_start": "null::varchar",
        "last_end": "null::varchar",
        "requested_payload": "null::varchar",
        "preset_id": "o_orderstatus",
        "ingested_at": _stamp_sql("o_orderdate"),
        **fields,
    }
    return "select " + ", ".join(f"{v} as {k}" for k, v in values.items()) + " from named"


_REQUEST_KINDS = {
    "live": {"selector_mode": "current", "adapter_config": {"url": "u", "limit": 5}},
    "slice": {"selector_mode": "pinned"},
    "multi_slice": {"selector_mode": "range", "object_name_override": "all.json"},
    "manual": {
        "selector_mode": None,
        "granularity": None,
        "request_payload": {"since": "x", "a": 1},
        "storage_prefix": "resend/1/",
    },
}


@query(
    "write_landing_manifest",
    _MANIFEST_SQL
    + "\nunion all ".join(
        [
            _kind_sql(
                "live", "current", "name", "stem", "folder",
                adapter_config="""'{"limit": 5, "url": "u"}'""",
            ),
            _kind_sql(
                "slice", "pinned", "name", "stem", "folder", requested_start=_stamp_sql(_MONTH)
            ),
            _kind_sql(
                "multi_slice", "range", "'all.json'", "'all.json'", "folder",
                object_name_override="'all.json'",
                matched_start=_stamp_sql(_MONTH),
                slice_count="108",
                first_start="'1994-01-01T00:00:00+00:00'",
                last_end="'2003-01-01T00:00:00+00:00'",
            ),
            _kind_sql(
                "manual", None, "name", "stem", "'resend/1/'",
                resolved_storage_prefix="'resend/1/'",
                requested_payload="""'{"a": 1, "since": "x"}'""",
            ),
        ]
    ),
)
def write_landing_manifest(spark, sf_dir):
    """Manifests of every order as landed by each kind of request."""
    calendar = slice_calendar(
        spark, SliceSelector("month", range_start="1994-01-01", range_end="2002-12-31")
    )
    settings = {**_REQUEST_KINDS}
    settings["multi_slice"] = {**settings["multi_slice"], "calendar": calendar}
    written = [_landing_manifests(spark, sf_dir, **each) for each in settings.values()]
    fields = [
        frame.select(
            "request.kind",
            "storage.run_id",
            "storage.payload_key",
            "storage.manifest_key",
            "planning_mode",
            F.col("payload.metadata")["slice_selector_mode"].alias("selector"),
            "storage.logical_date",
            "storage.slice_end",
            "storage.object_name_override",
            "storage.resolved_storage_prefix",
            "adapter_config",
            F.col("request.slice.slice_start").alias("requested_start"),
            F.col("request.matched_slice.slice_start").alias("matched_start"),
            "request.slice_count",
            F.col("request.first_slice.slice_start").alias("first_start"),
            F.col("request.last_slice.slice_end").alias("last_end"),
            F.col("request.payload").alias("requested_payload"),
            F.col("payload.metadata")["preset_id"].alias("preset_id"),
            "ingested_at",
        )
        for frame in written
    ]
    return reduce(DataFrame.unionByName, fields)


@query(
    "attach_manifest_metadata",
    _MANIFEST_SQL
    + """select folder || name || case when o_orderkey % 4 = 0 then '.new' else '' end as _landing_key,
      case when o_orderkey % 4 <> 0 then o_orderstatus end as preset_id,
      case when o_orderkey % 4 <> 0 then
        strftime(date_trunc('month', o_orderdate), '%Y-%m-%dT00:00:00+00:00') end as logical_date
    from named""",
)
def attach_metadata(spark, sf_dir):
    """Every order's object, a quarter of them without a manifest."""
    manifests = _landing_manifests(spark, sf_dir)
    renamed = F.col("storage.run_id").cast("bigint") % 4 == 0
    objects = manifests.select(
        F.concat(
            F.col("storage.payload_key"), F.when(renamed, ".new").otherwise("")
        ).alias("_landing_key")
    )
    metadata = F.col("_metadata_map")
    return attach_manifest_metadata(objects, manifests).select(
        "_landing_key",
        metadata["preset_id"].alias("preset_id"),
        metadata["logical_date"].alias("logical_date"),
    )


@query(
    "write_csv_delivery",
    """select cast(conv_id as varchar) as conv_id, cast(turn as varchar) as turn,
      nullif(role, '') as role, nullif(text, '') as text,
      '{"turn":' || turn || ',"role":"' || role || '"}' as nested
    from conversations""",
)
def write_csv_delivery(spark, sf_dir):
    """Free text with quotes, commas and line breaks survives the round trip."""
    root = scratch_dir(spark, "csv")
    fields = ["conv_id", "turn", "role", "text", "nested"]
    rows = table(spark, sf_dir, "conversations").withColumn("nested", F.struct("turn", "role"))
    writers.write_csv_delivery(rows, root, fields)
    return landing.read_csv_delivery(spark, root, fields, root=root).drop("_landing_key")


@query(
    "read_csv_split",
    """select cast(conv_id as varchar) as conv_id, cast(turn as varchar) as turn,
      nullif(role, '') as role, nullif(text, '') as text,
      text || chr(10) || '"' || role || '",' || chr(10) as broken
    from conversations""",
)
def read_csv_split(spark, sf_dir):
    """One large CSV file with line breaks and quotes in its values, read by many tasks."""
    root = scratch_dir(spark, "csv-split")
    broken = F.concat("text", F.lit('\n"'), "role", F.lit('",\n'))
    rows = table(spark, sf_dir, "conversations").withColumn("broken", broken)
    fields = ["conv_id", "turn", "role", "text", "broken"]
    writers.write_csv_delivery(rows.coalesce(1), root, fields)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        return landing.read_csv_delivery(spark, root, fields, root=root).drop("_landing_key")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query("write_model", "select * from evt_events", "evt_events")
def write_model(spark, sf_dir):
    path = scratch_dir(spark, "model")
    frame = evt.int_sensor_events(evt.stg_sensor_events(raw_events(spark, sf_dir)))
    writers.write_model(frame, path, "event_date")
    return spark.read.schema(frame.schema).parquet(path)


# Standardize jobs -------------------------------------------------------------------


@query(
    "standardize_slices",
    f"""select {_TXN_ROW}, 'json_bundle' as _standardize_strategy, 'transactions' as _source_preset_id,
      logical_date as _logical_date, logical_date as _raw_bundle_logical_date,
      'month' as _raw_bundle_granularity, '2026-01-01T00:00:00+00:00' as _raw_standardized_at,
      count(*) over (partition by logical_date) as _raw_bundle_row_count,
      'v1' as _schema_version, year, month
    from (select *,
        strftime(date_trunc('month', _logical_date::timestamp), '%Y-%m-%dT00:00:00+00:00') as logical_date,
        strftime(_logical_date::timestamp, '%Y') as year,
        strftime(_logical_date::timestamp, '%m') as month
      from raw_txn)""",
    "raw_txn",
)
def standardize_slices(spark, sf_dir):
    """Every month of transactions, landed as JSON bundles, in one job."""
    root = land_transactions(spark, sf_dir, fields=("year", "month"))
    out = scratch_dir(spark, "processed")
    job = std.StandardizeJob(
        standardizer="json_bundle",
        preset_id="transactions",
        landing_root=root,
        processed_root=out,
        manifest_root=scratch_dir(spark, "manifests"),
        landing_granularity="month",
        output_granularity="month",
        landing_fields=("year", "month"),
        processed_fields=("year", "month"),
        reader_options={"one_per_line": True},
    )
    selector = SliceSelector("month", range_start="1994-01-01", range_end="2003-01-01")
    std.standardize_slices(
        spark, job, slice_calendar(spark, selector), standardized_at=STAMP
    )
    schema = f"{contracts.RAW_TRANSACTIONS}, year STRING, month STRING"
    return (
        spark.read.schema(schema)
        .parquet(f"{out}/raw")
        .select(
            *_TXN_NAMES,
            "_standardize_strategy",
            "_source_preset_id",
            "_logical_date",
            "_raw_bundle_logical_date",
            "_raw_bundle_granularity",
            "_raw_standardized_at",
            "_raw_bundle_row_count",
            "_schema_version",
            "year",
            "month",
        )
    )


@query(
    "standardize_manual",
    f"""select {_DLV_ROW}, 'deliveries' as _source_preset_id, cast(null as varchar) as _logical_date,
      'resend' as _raw_bundle_id, 'raw/manual/resend.parquet' as _raw_bundle_key,
      'raw/manual/_resend.parquet.manifest.json' as _raw_bundle_manifest_key,
      cast(null as varchar) as _raw_bundle_logical_date, 'manual' as _raw_bundle_granularity,
      (select count(*) from raw_dlv) as _raw_bundle_row_count
    from raw_dlv""",
    "raw_dlv",
)
def standardize_manual(spark, sf_dir):
    """All deliveries resent under one prefix, as one bundle."""
    root = scratch_dir(spark, "landing-manual-csv")
    writers.write_csv_delivery(
        raw_deliveries(spark, sf_dir), f"{root}/client=a/resend", contracts.DELIVERY_FIELDS
    )
    out = scratch_dir(spark, "processed-manual")
    job = std.StandardizeJob(
        standardizer="csv_delivery",
        preset_id="deliveries",
        landing_root=root,
        processed_root=out,
        manifest_root=scratch_dir(spark, "manifests-manual"),
        processed_prefix="raw/manual",
    )
    std.standardize_manual(
        spark,
        job,
        input_prefix="client=a/resend",
        object_name="resend.parquet",
        run_id="resend",
        standardized_at=STAMP,
    )
    return (
        spark.read.schema(contracts.RAW_DELIVERIES)
        .parquet(f"{out}/raw/manual/resend.parquet")
        .select(
            *contracts.DELIVERY_FIELDS,
            "_source_preset_id",
            "_logical_date",
            "_raw_bundle_id",
            "_raw_bundle_key",
            "_raw_bundle_manifest_key",
            "_raw_bundle_logical_date",
            "_raw_bundle_granularity",
            "_raw_bundle_row_count",
        )
    )


def _read_conversations(spark, paths, *, root, only):
    lines = landing.read_manual_lines(spark, paths, root=root)
    return lines.select("_landing_key", F.from_json("line", _CONVERSATION).alias("row"))


CONVERSATION_LINES = std.Standardizer(
    read=_read_conversations,
    to_rows=lambda df: df.select("*", "row.*").drop("row"),
    columns=["conv_id", "turn", "role", "text", "_standardize_strategy", "_source_preset_id"],
)


@query(
    "standardizer_registry",
    """select conv_id, turn, role, text, 'conversation_lines' as _standardize_strategy,
      'conversations' as _source_preset_id, 'lines' as _raw_bundle_id,
      (select count(*) from conversations) as _raw_bundle_row_count
    from conversations""",
)
def standardizer_registry(spark, sf_dir):
    """A standardizer of the user's own, found by its key."""
    std.register_standardizer("conversation_lines", CONVERSATION_LINES)
    root = scratch_dir(spark, "landing-lines")
    payloads = table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("payload")
    )
    writers.write_landing(payloads, root, None, base_prefix="lines")
    out = scratch_dir(spark, "processed-lines")
    job = std.StandardizeJob(
        standardizer="conversation_lines",
        preset_id="conversations",
        landing_root=root,
        processed_root=out,
        manifest_root=scratch_dir(spark, "manifests-lines"),
    )
    std.standardize_manual(spark, job, input_prefix="lines", object_name="lines", run_id="lines")
    schema = f"{_CONVERSATION}, _standardize_strategy STRING, _source_preset_id STRING"
    return spark.read.schema(f"{schema}, {contracts.BUNDLE_LINEAGE}").parquet(
        f"{out}/raw/lines"
    ).select(
        "conv_id",
        "turn",
        "role",
        "text",
        "_standardize_strategy",
        "_source_preset_id",
        "_raw_bundle_id",
        "_raw_bundle_row_count",
    )
