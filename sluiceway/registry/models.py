"""The 28 models as registered queries over the test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluiceway.plans import deliveries as dlv, events as evt, transactions as txn
from sluiceway.registry import adapters
from sluiceway.registry.oracle import with_ctes
from sluiceway.session import materialize

Query = Callable[[SparkSession, str], DataFrame]


def txn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated transactions; the small bundle table is written first."""
    raw = adapters.raw_transactions(spark, sf_dir)
    bundles = materialize(txn.bronze_canonical_raw_bundles(raw), "txn-bundles")
    return txn.bronze_transaction_events(raw, bundles, adapters.TRANSACTION_TIEBREAK)


def txn_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn.gold_transactions(txn.silver_transactions(txn_events(spark, sf_dir)))


def txn_silver_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn.silver_transaction_answer_keys(txn_events(spark, sf_dir))


def txn_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn.gold_daily_transaction_metrics(txn_gold(spark, sf_dir))


def txn_evaluator_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn.evaluator_daily_from_events(txn_events(spark, sf_dir))


def txn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn.management_daily_summary(txn_evaluator_daily(spark, sf_dir))


def dlv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.raw_deliveries(spark, sf_dir)
    bundles = materialize(dlv.bronze_canonical_raw_bundles(raw), "dlv-bundles")
    return dlv.bronze_delivery_records(raw, bundles, adapters.DELIVERY_TIEBREAK)


def dlv_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlv.silver_delivery_records(dlv_records(spark, sf_dir))


def dlv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlv.gold_daily_delivery_metrics(dlv_silver(spark, sf_dir))


def evt_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evt.stg_sensor_events(adapters.raw_events(spark, sf_dir))


def evt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evt.int_sensor_events(evt_staged(spark, sf_dir))


MODELS: dict[str, Query] = {
    "txn_bronze_canonical_raw_bundles": lambda s, d: txn.bronze_canonical_raw_bundles(
        adapters.raw_transactions(s, d)
    ),
    "txn_bronze_transaction_events": txn_events,
    "txn_silver_transactions": lambda s, d: txn.silver_transactions(txn_events(s, d)),
    "txn_silver_answer_keys": txn_silver_keys,
    "txn_gold_transactions": txn_gold,
    "txn_gold_answer_keys": lambda s, d: txn.gold_transaction_answer_keys(txn_silver_keys(s, d)),
    "txn_gold_daily_transaction_metrics": txn_daily,
    "txn_gold_daily_anomaly_metrics": lambda s, d: txn.anomaly_metrics_from_events(
        txn_events(s, d)
    ),
    "txn_analytics_transactions": lambda s, d: txn.analytics_transactions(txn_gold(s, d)),
    "txn_analytics_daily_metrics": lambda s, d: txn.analytics_daily_transaction_metrics(
        txn_daily(s, d)
    ),
    "txn_evaluator_outcomes": lambda s, d: txn.outcomes_from_events(txn_events(s, d)),
    "txn_evaluator_daily_metrics": txn_evaluator_daily,
    "txn_management_daily_summary": txn_summary,
    "dlv_bronze_canonical_raw_bundles": lambda s, d: dlv.bronze_canonical_raw_bundles(
        adapters.raw_deliveries(s, d)
    ),
    "dlv_bronze_delivery_records": dlv_records,
    "dlv_silver_delivery_records": dlv_silver,
    "dlv_silver_delivery_batches": lambda s, d: dlv.silver_delivery_batches(dlv_silver(s, d)),
    "dlv_gold_daily_delivery_metrics": dlv_daily,
    "dlv_gold_source_system_daily_metrics": lambda s, d: dlv.gold_source_system_daily_metrics(
        dlv_silver(s, d)
    ),
    "dlv_analytics_delivery_records": lambda s, d: dlv.analytics_delivery_records(
        dlv_silver(s, d)
    ),
    "dlv_analytics_daily_metrics": lambda s, d: dlv.analytics_daily_delivery_metrics(
        dlv_daily(s, d)
    ),
    "dlv_management_daily_summary": lambda s, d: dlv.management_daily_summary(dlv_daily(s, d)),
    "evt_stg_sensor_events": evt_staged,
    "evt_int_sensor_events": evt_events,
    "evt_analytics_sensor_events": lambda s, d: evt.analytics_sensor_events(evt_events(s, d)),
    "evt_device_latest_status": lambda s, d: evt.analytics_device_latest_status(evt_events(s, d)),
    "evt_site_daily_metrics": lambda s, d: evt.analytics_site_daily_metrics(evt_events(s, d)),
    "evt_stream_health_summary": lambda s, d: evt.management_stream_health_summary(
        evt_events(s, d)
    ),
}

_ANALYTICS_TXN = """
select transaction_id, event_ts, event_hour, card_id, card_region, card_segment, merchant_id,
  merchant_category, merchant_region, merchant_risk_tier, amount, amount_band, channel,
  is_declined, is_high_risk_merchant, event_date
from txn_gold
"""

# Query name to the CTE that states the same model.
_CTE_OF = {
    "txn_bronze_canonical_raw_bundles": "txn_bundles",
    "txn_bronze_transaction_events": "txn_events",
    "txn_silver_transactions": "txn_silver",
    "txn_silver_answer_keys": "txn_silver_keys",
    "txn_gold_transactions": "txn_gold",
    "txn_gold_answer_keys": "txn_gold_keys",
    "txn_gold_daily_transaction_metrics": "txn_daily",
    "txn_gold_daily_anomaly_metrics": "txn_anomalies",
    "txn_analytics_daily_metrics": "txn_daily",
    "txn_evaluator_outcomes": "txn_outcomes",
    "txn_evaluator_daily_metrics": "txn_evaluator",
    "txn_management_daily_summary": "txn_summary",
    "dlv_bronze_canonical_raw_bundles": "dlv_bundles",
    "dlv_bronze_delivery_records": "dlv_records",
    "dlv_silver_delivery_records": "dlv_silver",
    "dlv_silver_delivery_batches": "dlv_batches",
    "dlv_gold_daily_delivery_metrics": "dlv_daily",
    "dlv_gold_source_system_daily_metrics": "dlv_source_daily",
    "dlv_analytics_delivery_records": "dlv_silver",
    "dlv_analytics_daily_metrics": "dlv_daily",
    "dlv_management_daily_summary": "dlv_daily",
    "evt_stg_sensor_events": "evt_staged",
    "evt_int_sensor_events": "evt_events",
    "evt_analytics_sensor_events": "evt_published",
    "evt_device_latest_status": "evt_devices",
    "evt_site_daily_metrics": "evt_site_daily",
    "evt_stream_health_summary": "evt_health",
}

MODEL_SQL: dict[str, str] = {
    **{name: with_ctes(f"select * from {cte}", cte) for name, cte in _CTE_OF.items()},
    "txn_analytics_transactions": with_ctes(_ANALYTICS_TXN, "txn_gold"),
}
