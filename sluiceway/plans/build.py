"""Materialise the models of a workflow, run their checks, publish the marts.

Models run in dependency order and read what the previous ones wrote, so every join and
aggregate sees real table sizes and pruned Parquet columns. A build is full, or redoes the dates
that rows added to the source have changed (``incremental``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession, types as T

from sluiceway import contracts
from sluiceway.operators.projection import partition_last
from sluiceway.operators.quality import (
    Checks,
    null_measures,
    observed_report,
    quality_report,
    write_failures,
)
from sluiceway.plans import deliveries as dlv, events as evt, transactions as txn
from sluiceway.plans.incremental import (
    BY_BUNDLE,
    BY_DATE,
    BY_DIFFERENCE,
    BY_KEY,
    BY_ROW,
    Added,
    Keyed,
    refresh,
)
from sluiceway.session import configure
from sluiceway.sinks import partitions
from sluiceway.sinks.writers import (
    AS_READ,
    BY_PARTITION,
    GROUPED,
    model_location,
    write_model,
)
from sluiceway.sources.tables import event_schema, register_table

RAW = "raw"


@dataclass(frozen=True)
class Model:
    layer: str
    inputs: Sequence[str]
    build: Callable[..., DataFrame]
    partition: str = "event_date"
    checks: Checks = Checks()
    # GROUPED: a few aggregate rows per partition value, never a share of the source rows.
    # AS_READ: a projection of its input, stored by the same column, so no shuffle.
    arrange: str = BY_PARTITION
    # How added rows reach the model; BY_KEY and BY_BUNDLE need to know its selection.
    refresh: str = BY_DATE
    keyed: Keyed | None = None

    @property
    def is_mart(self) -> bool:
        return self.layer in MART_LAYERS


# Layers whose tables are published under the surface root.
MART_LAYERS = ("analytics", "model_evaluator", "management")

TRANSACTION_MODELS: dict[str, Model] = {
    "bronze_canonical_raw_bundles": Model(
        "bronze",
        [RAW],
        txn.bronze_canonical_raw_bundles,
        partition="bundle_event_date",
        checks=Checks(["raw_bundle_id", "bundle_event_date"], ["raw_bundle_id"]),
        arrange=GROUPED,
        refresh=BY_DIFFERENCE,
    ),
    "bronze_transaction_events": Model(
        "bronze",
        [RAW, "bronze_canonical_raw_bundles"],
        txn.bronze_transaction_events,
        checks=Checks(["transaction_id", "raw_bundle_id", "event_date"], ["transaction_id"]),
        refresh=BY_BUNDLE,
        keyed=Keyed("transaction_id", txn.typed_events, txn.dedupe_transactions),
    ),
    "silver_transactions": Model(
        "silver",
        ["bronze_transaction_events"],
        txn.silver_transactions,
        checks=Checks(["transaction_id", "event_date"], ["transaction_id"]),
        arrange=AS_READ,
    ),
    "silver_transaction_answer_keys": Model(
        "silver",
        ["bronze_transaction_events"],
        txn.silver_transaction_answer_keys,
        checks=Checks(["transaction_id"]),
    ),
    "gold_transactions": Model(
        "gold",
        ["silver_transactions"],
        txn.gold_transactions,
        checks=Checks(["transaction_id"], ["transaction_id"]),
        arrange=AS_READ,
    ),
    "gold_transaction_answer_keys": Model(
        "gold",
        ["silver_transaction_answer_keys"],
        txn.gold_transaction_answer_keys,
        arrange=AS_READ,
    ),
    "gold_daily_transaction_metrics": Model(
        "gold",
        ["gold_transactions"],
        txn.gold_daily_transaction_metrics,
        arrange=GROUPED,
    ),
    # Straight from the events: no join of the two gold tables.
    "gold_daily_anomaly_metrics": Model(
        "gold",
        ["bronze_transaction_events"],
        txn.anomaly_metrics_from_events,
        arrange=GROUPED,
    ),
    "analytics_transactions": Model(
        "analytics",
        ["gold_transactions"],
        txn.analytics_transactions,
        arrange=AS_READ,
    ),
    "analytics_daily_transaction_metrics": Model(
        "analytics",
        ["gold_daily_transaction_metrics"],
        txn.analytics_daily_transaction_metrics,
        arrange=AS_READ,
    ),
    "model_evaluator_transaction_outcomes": Model(
        "model_evaluator",
        ["bronze_transaction_events"],
        txn.outcomes_from_events,
        arrange=AS_READ,
    ),
    "model_evaluator_daily_metrics": Model(
        "model_evaluator",
        ["gold_daily_transaction_metrics", "gold_daily_anomaly_metrics"],
        txn.model_evaluator_daily_metrics,
        arrange=GROUPED,
    ),
    "management_daily_summary": Model(
        "management",
        ["model_evaluator_daily_metrics"],
        txn.management_daily_summary,
        arrange=GROUPED,
    ),
}

DELIVERY_MODELS: dict[str, Model] = {
    "bronze_canonical_raw_bundles": Model(
        "bronze",
        [RAW],
        dlv.bronze_canonical_raw_bundles,
        partition="bundle_event_date",
        checks=Checks(["raw_bundle_id", "bundle_event_date"], ["raw_bundle_id"]),
        arrange=GROUPED,
        refresh=BY_DIFFERENCE,
    ),
    "bronze_delivery_records": Model(
        "bronze",
        [RAW, "bronze_canonical_raw_bundles"],
        dlv.bronze_delivery_records,
        checks=Checks(
            ["delivery_record_id", "raw_bundle_id", "event_date"], ["delivery_record_id"]
        ),
        refresh=BY_BUNDLE,
        keyed=Keyed("delivery_record_id", dlv.typed_records, dlv.dedupe_delivery_records),
    ),
    "silver_delivery_records": Model(
        "silver",
        ["bronze_delivery_records"],
        dlv.silver_delivery_records,
        checks=Checks(
            ["delivery_record_id", "location_code", "location_label"], ["delivery_record_id"]
        ),
        arrange=AS_READ,
    ),
    "silver_delivery_batches": Model(
        "silver",
        ["silver_delivery_records"],
        dlv.silver_delivery_batches,
        partition="delivery_date",
        checks=Checks(["delivery_id"]),
        arrange=GROUPED,
        refresh=BY_DIFFERENCE,
    ),
    "gold_daily_delivery_metrics": Model(
        "gold",
        ["silver_delivery_records"],
        dlv.gold_daily_delivery_metrics,
        checks=Checks(["event_date"]),
        arrange=GROUPED,
    ),
    "gold_source_system_daily_metrics": Model(
        "gold",
        ["silver_delivery_records"],
        dlv.gold_source_system_daily_metrics,
        checks=Checks(["location_code"]),
        arrange=GROUPED,
    ),
    "analytics_delivery_records": Model(
        "analytics",
        ["silver_delivery_records"],
        dlv.analytics_delivery_records,
        checks=Checks(["delivery_record_id"]),
        arrange=AS_READ,
    ),
    "analytics_daily_delivery_metrics": Model(
        "analytics",
        ["gold_daily_delivery_metrics"],
        dlv.analytics_daily_delivery_metrics,
        checks=Checks(["event_date"]),
        arrange=AS_READ,
    ),
    "management_daily_summary": Model(
        "management",
        ["gold_daily_delivery_metrics"],
        dlv.management_daily_summary,
        checks=Checks(["event_date"]),
        arrange=AS_READ,
    ),
}

EVENT_MODELS: dict[str, Model] = {
    "stg_sensor_events": Model(
        "staging",
        [RAW],
        evt.stg_sensor_events,
        checks=Checks(["emitter_event_id", "emitted_at"]),
        refresh=BY_ROW,
    ),
    "int_sensor_events": Model(
        "intermediate",
        ["stg_sensor_events"],
        evt.int_sensor_events,
        checks=Checks(["emitter_event_id", "device_id"], ["emitter_event_id"]),
        refresh=BY_KEY,
        keyed=Keyed("emitter_event_id", evt.stg_sensor_events, evt.int_sensor_events),
    ),
    "analytics_sensor_events": Model(
        "analytics",
        ["int_sensor_events"],
        evt.analytics_sensor_events,
        checks=Checks(["emitter_event_id"], ["emitter_event_id"]),
        arrange=AS_READ,
    ),
    "analytics_site_daily_metrics": Model(
        "analytics",
        ["int_sensor_events"],
        evt.analytics_site_daily_metrics,
        checks=Checks(["event_date", "site_id"]),
        arrange=GROUPED,
    ),
    "analytics_device_latest_status": Model(
        "analytics",
        ["int_sensor_events"],
        evt.analytics_device_latest_status,
        checks=Checks(["device_id"], ["device_id"]),
        refresh=BY_DIFFERENCE,
    ),
    "management_stream_health_summary": Model(
        "management",
        ["int_sensor_events"],
        evt.management_stream_health_summary,
        checks=Checks(["event_date"], ["event_date"]),
        arrange=GROUPED,
    ),
}

WORKFLOWS: dict[str, Mapping[str, Model]] = {
    "transactions": TRANSACTION_MODELS,
    "deliveries": DELIVERY_MODELS,
    "events": EVENT_MODELS,
}


@dataclass(frozen=True)
class Workspace:
    """Where a workflow's tables live: layers under one root, marts under another."""

    processed_root: str
    surface_root: str

    def path(self, name: str, model: Model) -> str:
        root = self.surface_root if model.is_mart else self.processed_root
        return model_location(root, model.layer, name)

    def read(self, spark: SparkSession, workflow: str, name: str) -> DataFrame:
        """A table that was built before, with its declared columns."""
        path = self.path(name, WORKFLOWS[workflow][name])
        return partitions.read_table(spark, path, model_schema(workflow, name))


# Columns of the source of each workflow.
RAW_SCHEMAS = {
    "transactions": f"{contracts.RAW_TRANSACTIONS}, {contracts.DATE_PARTITIONS}",
    "deliveries": f"{contracts.RAW_DELIVERIES}, {contracts.DATE_PARTITIONS}",
    "events": event_schema(),
}


@cache
def model_schema(workflow: str, name: str) -> T.StructType:
    """Columns of a model as it is stored, told by its definition alone; nothing runs."""
    spark = SparkSession.active()
    inputs = [
        RAW_SCHEMAS[workflow] if source == RAW else model_schema(workflow, source)
        for source in WORKFLOWS[workflow][name].inputs
    ]
    model = WORKFLOWS[workflow][name]
    frame = model.build(*[spark.createDataFrame([], schema) for schema in inputs])
    return partition_last(frame, model.partition).schema


def _expand(models: Mapping[str, Model], term: str) -> set[str]:
    """Names a selection term stands for: a model, a layer, ``+name`` or ``name+``."""
    name = term.strip("+")
    if name in models:
        names = {name}
    else:
        names = {key for key, model in models.items() if model.layer == name}
    if not names:
        raise ValueError(f"nothing is called {name!r}; models: {sorted(models)}")
    above, below = set(names), set(names)
    if term.startswith("+"):
        for key in reversed(models):
            if key in above:
                above |= {up for up in models[key].inputs if up != RAW}
    if term.endswith("+"):
        for key, model in models.items():
            if below & set(model.inputs):
                below.add(key)
    return above | below


def select_models(
    models: Mapping[str, Model],
    select: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
) -> list[str]:
    """Chosen model names in build order."""
    chosen = set(models) if not select else set().union(*[_expand(models, t) for t in select])
    for term in exclude or ():
        chosen -= _expand(models, term)
    return [name for name in models if name in chosen]


def build_models(
    spark: SparkSession,
    workflow: str,
    raw: DataFrame | None,
    workspace: Workspace,
    *,
    mode: str = "run",
    select: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
    added: DataFrame | None = None,
    full_refresh: bool = False,
    database: str | None = None,
    failures: str | None = None,
) -> DataFrame | None:
    """Rebuild the chosen models.

    ``mode`` is ``run`` (no checks), ``build`` (models, then checks) or ``test`` (checks
    on existing tables). ``options`` passes keyword arguments to single models, such as a
    ``tiebreak``. Returns the quality report where checks ran; ``failures`` names a folder that
    rows failing a check are written to.

    ``added`` are the rows of ``raw`` that the last build has not seen: only dates they change
    are redone, of the chosen models and all they depend on, which must be chosen too. The
    build is full nevertheless with ``full_refresh``, on the first time, and where a model is
    marked: a build marks what it writes and all that depends on it, and takes the marks off
    what it has finished.

    With a ``database`` each model is also an external table of Spark's catalog there, whose
    partitions are brought up to date.
    """
    if mode not in ("run", "build", "test"):
        raise ValueError(f"mode must be run, build or test, not {mode!r}")
    models = WORKFLOWS[workflow]
    chosen = select_models(models, select, exclude)
    missing = {up for name in chosen for up in models[name].inputs} - {*chosen, RAW}
    if added is not None and missing:
        raise ValueError(f"added rows come through models that are not chosen: {sorted(missing)}")
    configure(spark)
    measured: dict[str, Observation] = {}
    if mode != "test":
        change = None
        marks = {
            name: f"{workspace.processed_root}/_unfinished_{workflow}/{name}" for name in models
        }
        if added is not None and not full_refresh:
            usable = all(
                partitions.exists(spark, workspace.path(name, models[name]))
                and not partitions.exists(spark, marks[name])
                for name in chosen
            )
            change = Added(added) if usable else None
        for name in set().union(*[_expand(models, f"{name}+") for name in chosen]):
            partitions.make_folder(spark, marks[name])
        measured = _write_models(
            spark, workflow, raw, workspace, chosen, options or {}, change, mode == "build"
        )
        for name in chosen:
            partitions.remove(spark, marks[name])
        if database is not None:
            for name in chosen:
                register_table(
                    spark,
                    f"{database}.{name}",
                    workspace.path(name, models[name]),
                    model_schema(workflow, name),
                    models[name].partition,
                )
    if mode == "run":
        return None
    checked = {name: models[name].checks for name in chosen}
    declared = {k: c for k, c in checked.items() if c.not_null or c.unique}
    tables = {name: workspace.read(spark, workflow, name) for name in declared}
    if failures is not None:
        write_failures(tables, declared, failures)
    return quality_report(tables, declared, observed_report(measured, declared))


def _write_models(
    spark, workflow, raw, workspace, chosen, options, change: Added | None, measure: bool
) -> dict[str, Observation]:
    """Write the models in turn; returns what was measured of each while it was written."""
    models, measured = WORKFLOWS[workflow], {}
    # Every table is listed once, however many models read it.
    frames: dict[str, DataFrame] = {RAW: raw}

    def frame_of(name: str) -> DataFrame:
        if name not in frames:
            frames[name] = workspace.read(spark, workflow, name)
        return frames[name]

    for name in chosen:
        model = models[name]
        inputs = {source: frame_of(source) for source in model.inputs}
        given, dates = options.get(name, {}), None
        if change is None:
            frame = model.build(*inputs.values(), **given)
        else:
            current = workspace.read(spark, workflow, name)
            frame, dates = refresh(name, model, inputs, change, current, given)
            if not dates:
                continue
        # Of a model that is written in part, only whole tables tell all failures.
        measures = null_measures(model.checks) if measure and change is None else []
        if measures:
            measured[name] = Observation(f"{workflow}-{name}")
        write_model(
            frame,
            workspace.path(name, model),
            model.partition,
            model.arrange,
            dates,
            measured.get(name),
            measures,
        )
    return measured


def publish_marts(
    spark: SparkSession, workflow: str, workspace: Workspace, raw: DataFrame | None = None
) -> list[str]:
    """Rebuild only the audience tables from the existing layers; returns their names."""
    marts = [name for name, model in WORKFLOWS[workflow].items() if model.is_mart]
    build_models(spark, workflow, raw, workspace, select=marts)
    return marts
