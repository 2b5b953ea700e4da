"""Data-quality checks, build and backfill jobs, and streams as queries."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway import contracts
from sluiceway.operators import quality
from sluiceway.operators.calendar import SliceSelector
from sluiceway.plans import build, transactions as txn
from sluiceway.plans.backfill import backfill
from sluiceway.plans.standardize import StandardizeJob
from sluiceway.registry import adapters
from sluiceway.registry.adapters import raw_events, raw_transactions
from sluiceway.registry.files import land_deliveries
from sluiceway.registry.models import txn_summary
from sluiceway.registry.oracle import full_date, with_ctes
from sluiceway.session import scratch_dir
from sluiceway.sources import tables
from sluiceway.streaming import intake, marts

QUERIES = {}
SQL = {}


def query(name: str, sql: str, *ctes: str):
    def register(function):
        QUERIES[name] = function
        SQL[name] = with_ctes(sql, *ctes) if ctes else sql
        return function

    return register


# Quality ----------------------------------------------------------------------------

query("check_not_null", "select * from raw_txn where card_region is null", "raw_txn")(
    lambda s, d: quality.check_not_null(raw_transactions(s, d), "card_region")
)
query(
    "check_unique",
    """select transaction_id, count(*) as n_records from txn_typed
    where transaction_id is not null group by 1 having count(*) > 1""",
    "txn_typed",
)(lambda s, d: quality.check_unique(txn.typed_events(raw_transactions(s, d)), "transaction_id"))


@query(
    "quality_report",
    """select 'transactions' as table_name, 'card_region' as column_name, 'not_null' as check_name,
      count(*) filter (card_region is null) as failures from raw_txn
    union all select 'transactions', 'amount', 'not_null', count(*) filter (amount is null) from raw_txn
    union all select 'transactions', '_landing_key', 'unique', count(*)
      from (select 1 from raw_txn group by _landing_key having count(*) > 1)
    union all select 'events', 'emitter_event_id', 'not_null',
      count(*) filter (emitter_event_id is null) from raw_evt
    union all select 'events', 'emitter_event_id', 'unique', count(*)
      from (select 1 from raw_evt where emitter_event_id is not null
        group by emitter_event_id having count(*) > 1)""",
    "raw_txn",
    "raw_evt",
)
def quality_report(spark, sf_dir):
    frames = {"transactions": raw_transactions(spark, sf_dir), "events": raw_events(spark, sf_dir)}
    checks = {
        "transactions": quality.Checks(["card_region", "amount"], ["_landing_key"]),
        "events": quality.Checks(["emitter_event_id"], ["emitter_event_id"]),
    }
    return quality.quality_report(frames, checks)


# Jobs -------------------------------------------------------------------------------


def _workspace(spark: SparkSession) -> build.Workspace:
    root = scratch_dir(spark, "workspace")
    return build.Workspace(f"{root}/processed", f"{root}/surface")


def _check_sql(name: str, cte: str, checks: quality.Checks) -> list[str]:
    parts = [
        f"select '{name}' as table_name, '{c}' as column_name, 'not_null' as check_name, "
        f"count(*) filter ({c} is null) as failures from {cte}"
        for c in checks.not_null
    ]
    parts += [
        f"select '{name}', '{c}', 'unique', count(*) from (select 1 from {cte} "
        f"where {c} is not null group by {c} having count(*) > 1)"
        for c in checks.unique
    ]
    return parts


# CTE that states each event model.
_EVENT_CTE = {
    "stg_sensor_events": "evt_staged",
    "int_sensor_events": "evt_events",
    "analytics_sensor_events": "evt_published",
    "analytics_site_daily_metrics": "evt_site_daily",
    "analytics_device_latest_status": "evt_devices",
    "management_stream_health_summary": "evt_health",
}


@query(
    "build_models",
    "\nunion all ".join(
        part
        for name, cte in _EVENT_CTE.items()
        for part in _check_sql(name, cte, build.EVENT_MODELS[name].checks)
    ),
    *_EVENT_CTE.values(),
)
def build_models(spark, sf_dir):
    """All event models written, then their declared checks."""
    return build.build_models(
        spark, "events", raw_events(spark, sf_dir), _workspace(spark), mode="build"
    )


# CTE that states each model of the landed workflows that is built and checked. Of the transactions
# the first three, with ten of the thirteen checks: each has some 2,400 dates, so as many files.
_TXN_CTE = {
    "bronze_canonical_raw_bundles": "txn_bundles",
    "bronze_transaction_events": "txn_events",
    "silver_transactions": "txn_silver",
}
_DLV_CTE = {
    "bronze_canonical_raw_bundles": "dlv_bundles",
    "bronze_delivery_records": "dlv_records",
    "silver_delivery_records": "dlv_silver",
    "silver_delivery_batches": "dlv_batches",
    "gold_daily_delivery_metrics": "dlv_daily",
    "gold_source_system_daily_metrics": "dlv_source_daily",
    "analytics_delivery_records": "dlv_silver",
    "analytics_daily_delivery_metrics": "dlv_daily",
    "management_daily_summary": "dlv_daily",
}
_OPTIONS = {
    "transactions": {"bronze_transaction_events": {"tiebreak": adapters.TRANSACTION_TIEBREAK}},
    "deliveries": {"bronze_delivery_records": {"tiebreak": adapters.DELIVERY_TIEBREAK}},
    "events": {},
}
_RAW = {
    "transactions": raw_transactions,
    "deliveries": adapters.raw_deliveries,
    "events": raw_events,
}


def _checks_sql(models, ctes: dict[str, str]) -> str:
    return "\nunion all ".join(
        part for name, cte in ctes.items() for part in _check_sql(name, cte, models[name].checks)
    )


def _checked_build(workflow: str, select=None):
    def run(spark, sf_dir):
        return build.build_models(
            spark,
            workflow,
            _RAW[workflow](spark, sf_dir),
            _workspace(spark),
            mode="build",
            select=select,
            options=_OPTIONS[workflow],
        )

    return run


query(
    "build_transactions", _checks_sql(build.TRANSACTION_MODELS, _TXN_CTE), *_TXN_CTE.values()
)(_checked_build("transactions", list(_TXN_CTE)))
query("build_deliveries", _checks_sql(build.DELIVERY_MODELS, _DLV_CTE), *_DLV_CTE.values())(
    _checked_build("deliveries")
)


# Late rows: versions of events that come last, some of a later date; bundles of a rerun that win
# over the bundles of their slice, and some that do not.
_LATE = {
    "events": "emission_index = 2",
    "transactions": "_raw_bundle_id like '%run2'",
    "deliveries": "_raw_bundle_id like '%run2'",
}


def _built_in_two_steps(spark, sf_dir, workflow: str, name: str) -> DataFrame:
    """A model after a build without the late rows, and one with them added."""
    raw = _RAW[workflow](spark, sf_dir)
    workspace = _workspace(spark)
    late = F.coalesce(F.expr(_LATE[workflow]), F.lit(False))
    settings = {"options": _OPTIONS[workflow], "select": [f"+{name}"]}
    build.build_models(spark, workflow, raw.where(~late), workspace, **settings)
    build.build_models(spark, workflow, raw, workspace, added=raw.where(late), **settings)
    return workspace.read(spark, workflow, name)


for _name, _workflow, _model, _cte_name in (
    ("build_added_events_health", "events", "management_stream_health_summary", "evt_health"),
    ("build_added_events_devices", "events", "analytics_device_latest_status", "evt_devices"),
    ("build_added_transactions", "transactions", "bronze_transaction_events", "txn_events"),
    ("build_added_deliveries", "deliveries", "silver_delivery_records", "dlv_silver"),
    ("build_added_deliveries_batches", "deliveries", "silver_delivery_batches", "dlv_batches"),
):
    query(_name, f"select * from {_cte_name}", _cte_name)(
        lambda s, d, w=_workflow, m=_model: _built_in_two_steps(s, d, w, m)
    )


@query("register_table", "select * from evt_site_daily", "evt_site_daily")
def register_table(spark, sf_dir):
    """A mart read by its name in Spark's catalog, after partitions have come and gone."""
    workspace, raw = _workspace(spark), raw_events(spark, sf_dir)
    early = F.coalesce(F.col("emission_index") == 0, F.lit(False))
    database = f"marts_{uuid4().hex}"
    for rows in (raw.where(early), raw):
        build.build_models(spark, "events", rows, workspace, database=database)
    return spark.table(f"{database}.analytics_site_daily_metrics")


@query("publish_marts", "select * from evt_published", "evt_published")
def publish_marts(spark, sf_dir):
    workspace = _workspace(spark)
    layers = ["staging", "intermediate"]
    build.build_models(spark, "events", raw_events(spark, sf_dir), workspace, select=layers)
    build.publish_marts(spark, "events", workspace)
    name = "analytics_sensor_events"
    return workspace.read(spark, "events", name)


@query(
    "backfill",
    f"""select count(*) as record_count, count(distinct delivery_id) as delivery_count,
      count(distinct source_system_id) as location_count,
      sum(amount) as total_allowed_amount, avg(amount) as average_allowed_amount, event_date
    from (
      select *, coalesce(day, cast(month_start as date)) as event_date
      from (select *, cast(allowed_amount as double) as amount, {full_date("delivery_date")} as day,
          date_trunc('month', _logical_date::timestamp) as month_start from raw_dlv)
      qualify row_number() over (partition by delivery_id, record_number
        order by day desc nulls last, amount desc nulls last, month_start desc nulls last,
          feed_type desc nulls last) = 1)
    group by event_date""",
    "raw_dlv",
)
def backfill_deliveries(spark, sf_dir):
    """Every month of deliveries, landed as CSV, standardized and built up to the marts."""
    root = land_deliveries(spark, sf_dir)
    out = scratch_dir(spark, "backfill")
    workspace = _workspace(spark)
    job = StandardizeJob(
        standardizer="csv_delivery",
        preset_id="deliveries",
        landing_root=root,
        processed_root=out,
        manifest_root=f"{out}/manifests",
        landing_granularity="month",
        output_granularity="month",
        landing_fields=("year", "month"),
        processed_fields=("year", "month"),
    )
    backfill(
        spark,
        "deliveries",
        job,
        SliceSelector("month", range_start="1994-01-01", range_end="2003-01-01"),
        workspace,
        select=["+gold_daily_delivery_metrics", "management_daily_summary"],
        options={"bronze_delivery_records": {"tiebreak": adapters.DELIVERY_TIEBREAK}},
    )
    name = "management_daily_summary"
    return workspace.read(spark, "deliveries", name)


query("sanity_count", "select count(*) as row_count from txn_summary", "txn_summary")(
    lambda s, d: tables.sanity_count(txn_summary(s, d))
)
# Streams ----------------------------------------------------------------------------

NOW = {"availableNow": True}
FILES_PER_BATCH = 4


_BROKEN = '{"broken": '


def _event_of(text: Column) -> Column:
    """The event of a text that :func:`_drop_events` wrote, broken or not."""
    return F.from_json(F.replace(text, F.lit(_BROKEN), F.lit("")), contracts.RAW_EVENTS)


def _drop_events(spark: SparkSession, sf_dir: str) -> str:
    """All events as text files in a drop folder, in no particular order.

    Events without an id arrive as broken text.
    """
    path = scratch_dir(spark, "drop")
    whole = F.to_json(F.struct(*contracts.names(contracts.RAW_EVENTS)))
    has_id = F.col("emitter_event_id").isNotNull()
    text = F.when(has_id, whole).otherwise(F.concat(F.lit(_BROKEN), whole))
    raw_events(spark, sf_dir).select(text.alias("value")).write.text(path)
    return path


def _finish(writer) -> None:
    writer.start().awaitTermination()


def _drain(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything waiting, into Parquet, and read that back."""
    spark = stream.sparkSession
    path = scratch_dir(spark, label)
    _finish(
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_dir(spark, f"{label}-checkpoint"))
        .trigger(**NOW)
    )
    return spark.read.schema(stream.schema).parquet(path)


def _delivered(spark: SparkSession, sf_dir: str, writer=intake.deliver_events) -> str:
    source = intake.text_event_source(spark, _drop_events(spark, sf_dir), FILES_PER_BATCH)
    path = scratch_dir(spark, "delivered")
    _finish(writer(source, path, scratch_dir(spark, "delivered-checkpoint"), NOW))
    return path


def _staged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events as a stream over a plain folder of event files."""
    drop = _drop_events(spark, sf_dir)
    return intake.stage_events_stream(
        intake.delivered_event_stream(spark, drop, FILES_PER_BATCH)
    )


@query(
    "stream_source",
    "select *, emitter_event_id is not null as is_whole from raw_evt",
    "raw_evt",
)
def stream_source(spark, sf_dir):
    """Every text that the stream delivers, with the event it holds, whole or broken."""
    stream = intake.text_event_source(spark, _drop_events(spark, sf_dir), FILES_PER_BATCH)
    texts = _drain(stream, "source")
    whole = ~F.col("value").startswith(_BROKEN)
    return texts.select(_event_of(F.col("value")).alias("event"), whole.alias("is_whole")).select(
        "event.*", "is_whole"
    )


@query("deliver_events", "select * from raw_evt where emitter_event_id is not null", "raw_evt")
def deliver_events(spark, sf_dir):
    path = _delivered(spark, sf_dir)
    return tables.read_stream_events(spark, path).drop("year", "month", "day")


@query("deliver_events_once", "select * from raw_evt where emitter_event_id is not null", "raw_evt")
def deliver_events_once(spark, sf_dir):
    """A drop folder that holds each file twice: exact repeats are delivered once."""
    drop = _drop_events(spark, sf_dir)
    # Files of about the size of the first ones: as many again as there are splits of 16 MB would
    # be many times as many batches.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    try:
        spark.read.text(drop).write.mode("append").text(drop)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    source = intake.text_event_source(spark, drop, FILES_PER_BATCH)
    path = scratch_dir(spark, "delivered-once")
    writer = intake.deliver_events(
        source, path, scratch_dir(spark, "once-checkpoint"), NOW, repeats_within="2 hours"
    )
    _finish(writer)
    return tables.read_stream_events(spark, path).drop("year", "month", "day")


@query(
    "quarantine_bad_events",
    "select *, 'malformed' as type from raw_evt where emitter_event_id is null",
    "raw_evt",
)
def quarantine_bad_events(spark, sf_dir):
    """The texts that are kept, with the events they would have been."""
    path = _delivered(spark, sf_dir, intake.quarantine_bad_events)
    texts = spark.read.schema("value STRING, type STRING").text(path)
    return texts.select(_event_of(F.col("value")).alias("event"), "type").select("event.*", "type")


query("stage_events_stream", "select * from evt_staged", "evt_staged")(
    lambda s, d: _drain(_staged_stream(s, d), "staged")
)


def _streamed_marts(spark: SparkSession, sf_dir: str) -> marts.EventMarts:
    built = marts.EventMarts(scratch_dir(spark, "marts"))
    built.drain(_staged_stream(spark, sf_dir), scratch_dir(spark, "marts-checkpoint"))
    return built


query("upsert_latest_events", "select * from evt_events", "evt_events")(
    lambda s, d: _streamed_marts(s, d).events.read(s)
)
query("site_daily_stream", "select * from evt_site_daily", "evt_site_daily")(
    lambda s, d: _streamed_marts(s, d).site_daily.read(s)
)
query("health_stream", "select * from evt_health", "evt_health")(
    lambda s, d: _streamed_marts(s, d).health.read(s)
)


query("device_state_stream", "select * from evt_devices", "evt_devices")(
    lambda s, d: _streamed_marts(s, d).device_status(s)
)


def _stream_build(spark: SparkSession, sf_dir: str) -> marts.EventMarts:
    root = scratch_dir(spark, "stream-build")
    return marts.stream_build(
        spark, _drop_events(spark, sf_dir), root, f"{root}/checkpoint", FILES_PER_BATCH
    )


query("stream_build", "select * from evt_health", "evt_health")(
    lambda s, d: _stream_build(s, d).health.read(s)
)
query("stream_build_site_daily", "select * from evt_site_daily", "evt_site_daily")(
    lambda s, d: _stream_build(s, d).site_daily.read(s)
)
query("stream_build_sensor_events", "select * from evt_published", "evt_published")(
    lambda s, d: _stream_build(s, d).sensor_events.read(s)
)
query("stream_build_device_status", "select * from evt_devices", "evt_devices")(
    lambda s, d: _stream_build(s, d).device_status(s)
)
