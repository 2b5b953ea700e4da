"""Card-transaction models, from raw rows to audience marts.

Each function is one model: DataFrames in, DataFrame out. An answer key is a filtered
copy of columns of the same deduplicated event, so :func:`scored_transactions` attaches
it row by row; models that take both tables separately join them. Both routes give the
same rows, and the first needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sluiceway.functions.aggregates import (
    avg_as_double,
    conditional_avg,
    conditional_count,
    conditional_sum,
    count_all,
    mean_of_means,
    safe_ratio,
    sum_as_double,
)
from sluiceway.functions.columns import (
    below_bands,
    coalesce_default,
    concat_key,
    count_to_flag,
    in_list_ci,
    int_flag_to_bool,
    iso_to_ts,
    json_label_count,
    trunc_day,
    trunc_hour,
    try_iso_to_ts,
)
from sluiceway.operators.bundles import canonical_bundles, keep_canonical_rows
from sluiceway.operators.joins import (
    DAILY_DIMENSIONS,
    left_join_answer_keys,
    left_join_daily_dimensions,
)
from sluiceway.operators.latest import latest_by
from sluiceway.operators.projection import select_columns, typed_projection

# Amount bands by upper bound, and the tiers that count as high risk.
AMOUNT_BANDS = ((25, "micro"), (100, "small"), (250, "medium"))
AMOUNT_ABOVE = "large"
HIGH_RISK_TIERS = ("high", "critical")

_CARD_AND_MERCHANT = (
    "card_id",
    "card_region",
    "card_segment",
    "merchant_id",
    "merchant_category",
    "merchant_region",
    "merchant_risk_tier",
)

# Published columns of each table, in order.
EVENT_COLUMNS = (
    "transaction_id",
    "source_row_index",
    "event_ts",
    "event_hour",
    *_CARD_AND_MERCHANT,
    "amount",
    "channel",
    "is_declined",
    "is_answer_key_anomaly",
    "answer_key_labels_json",
    "answer_key_label_count",
    "landing_key",
    "standardize_strategy",
    "source_preset_id",
    "ingested_ts",
    "schema_version",
    "scenario_name",
    "response_row_count",
    "raw_bundle_id",
    "raw_bundle_key",
    "raw_bundle_manifest_key",
    "raw_standardized_ts",
    "raw_bundle_granularity",
    "raw_input_object_count",
    "raw_bundle_row_count",
    "event_date",
)
SILVER_COLUMNS = (
    *EVENT_COLUMNS[:14],
    "landing_key",
    "standardize_strategy",
    "source_preset_id",
    "ingested_ts",
    "schema_version",
    "scenario_name",
    "response_row_count",
    "event_date",
)
ANSWER_KEY_COLUMNS = (
    "is_answer_key_anomaly",
    "answer_key_labels_json",
    "answer_key_label_count",
)
DAILY_COLUMNS = (
    "channel",
    "card_region",
    "merchant_category",
    "transaction_count",
    "gross_amount",
    "average_amount",
    "declined_transaction_count",
    "declined_amount",
    "decline_rate",
    "event_date",
)
ANOMALY_MEASURES = (
    "anomaly_transaction_count",
    "anomalous_amount",
    "anomaly_rate",
    "average_anomalous_amount",
)


def bronze_canonical_raw_bundles(raw: DataFrame) -> DataFrame:
    return canonical_bundles(raw)


def typed_events(raw: DataFrame) -> DataFrame:
    """Raw rows with their final names and types; nothing is dropped yet."""
    # Parsed once, used three times.
    stamped = raw.withColumn("event_ts", iso_to_ts("_logical_date"))
    return typed_projection(
        stamped,
        {
            "transaction_id": concat_key("_landing_key", "__row_index"),
            "source_row_index": "__row_index:bigint",
            "event_ts": "event_ts",
            "event_hour": trunc_hour("event_ts"),
            **{name: f"{name}:string" for name in _CARD_AND_MERCHANT},
            "amount": "amount:double",
            "channel": "channel:string",
            "is_declined": int_flag_to_bool("is_declined"),
            "is_answer_key_anomaly": "__is_anomaly:boolean",
            "answer_key_labels_json": "__labels:string",
            "answer_key_label_count": json_label_count("__labels"),
            "landing_key": "_landing_key:string",
            "standardize_strategy": "_standardize_strategy:string",
            "source_preset_id": "_source_preset_id:string",
            "ingested_ts": try_iso_to_ts("_ingested_at"),
            "schema_version": "_schema_version:string",
            "scenario_name": "_scenario_name:string",
            "response_row_count": "_response_row_count:bigint",
            "raw_bundle_id": "_raw_bundle_id:string",
            "raw_bundle_key": "_raw_bundle_key:string",
            "raw_bundle_manifest_key": "_raw_bundle_manifest_key:string",
            "raw_standardized_ts": try_iso_to_ts("_raw_standardized_at"),
            "raw_bundle_granularity": "_raw_bundle_granularity:string",
            "raw_input_object_count": "_raw_input_object_count:bigint",
            "raw_bundle_row_count": "_raw_bundle_row_count:bigint",
            "event_date": F.to_date("event_ts"),
        },
    )


def dedupe_transactions(events: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest version of each transaction."""
    return latest_by(
        events,
        keys=["transaction_id"],
        newest_first=["ingested_ts", "event_ts", "source_row_index"],
        tiebreak=tiebreak,
    )


def bronze_transaction_events(
    raw: DataFrame, bundles: DataFrame, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Rows of canonical bundles, one per transaction."""
    rows = keep_canonical_rows(typed_events(raw), bundles)
    return dedupe_transactions(rows, tiebreak).select(*EVENT_COLUMNS)


def silver_transactions(events: DataFrame) -> DataFrame:
    """Transactions without any answer-key column."""
    return select_columns(events, SILVER_COLUMNS)


def silver_transaction_answer_keys(events: DataFrame) -> DataFrame:
    """Events that are anomalies or carry labels."""
    return events.where(
        F.col("is_answer_key_anomaly") | (F.col("answer_key_label_count") > 0)
    ).select(
        "transaction_id",
        "event_ts",
        "event_hour",
        *ANSWER_KEY_COLUMNS,
        "landing_key",
        "event_date",
    )


def gold_transactions(silver: DataFrame) -> DataFrame:
    derived = silver.withColumns(
        {
            "amount_band": below_bands("amount", AMOUNT_BANDS, AMOUNT_ABOVE),
            "is_high_risk_merchant": in_list_ci("merchant_risk_tier", HIGH_RISK_TIERS),
            "event_day_ts": trunc_day("event_ts"),
        }
    )
    return derived.select(
        *SILVER_COLUMNS[:14],
        "amount_band",
        "is_high_risk_merchant",
        "event_day_ts",
        "source_preset_id",
        "ingested_ts",
        "schema_version",
        "scenario_name",
        "response_row_count",
        "landing_key",
        "event_date",
    )


def gold_transaction_answer_keys(silver_keys: DataFrame) -> DataFrame:
    return silver_keys.select(
        "transaction_id",
        "event_ts",
        "event_hour",
        "is_answer_key_anomaly",
        "answer_key_label_count",
        "answer_key_labels_json",
        count_to_flag("answer_key_label_count").alias("has_answer_key_labels"),
        "landing_key",
        "event_date",
    )


def _daily_measures() -> list:
    declined = F.col("is_declined")
    return [
        count_all().alias("transaction_count"),
        sum_as_double("amount").alias("gross_amount"),
        avg_as_double("amount").alias("average_amount"),
        conditional_count(declined).alias("declined_transaction_count"),
        conditional_sum(declined, "amount").alias("declined_amount"),
        safe_ratio(conditional_count(declined), count_all()).alias("decline_rate"),
    ]


def _anomaly_measures() -> list:
    anomaly = F.coalesce("is_answer_key_anomaly", F.lit(False))
    return [
        conditional_count(anomaly).alias("anomaly_transaction_count"),
        conditional_sum(anomaly, "amount").alias("anomalous_amount"),
        safe_ratio(conditional_count(anomaly), count_all()).alias("anomaly_rate"),
        conditional_avg(anomaly, "amount").alias("average_anomalous_amount"),
    ]


def gold_daily_transaction_metrics(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy(*DAILY_DIMENSIONS).agg(*_daily_measures()).select(*DAILY_COLUMNS)
    )


def _anomaly_metrics(transactions_with_keys: DataFrame) -> DataFrame:
    return (
        transactions_with_keys.groupBy(*DAILY_DIMENSIONS)
        .agg(*_anomaly_measures())
        .select("channel", "card_region", "merchant_category", *ANOMALY_MEASURES, "event_date")
    )


def gold_daily_anomaly_metrics(transactions: DataFrame, answer_keys: DataFrame) -> DataFrame:
    """Anomaly metrics from two separate tables, joined on the transaction."""
    return _anomaly_metrics(
        left_join_answer_keys(transactions, answer_keys, ["is_answer_key_anomaly"])
    )


def analytics_transactions(gold: DataFrame) -> DataFrame:
    return select_columns(
        gold,
        (
            "transaction_id",
            "event_ts",
            "event_hour",
            *_CARD_AND_MERCHANT,
            "amount",
            "amount_band",
            "channel",
            "is_declined",
            "is_high_risk_merchant",
            "event_date",
        ),
    )


def analytics_daily_transaction_metrics(daily: DataFrame) -> DataFrame:
    return select_columns(daily, DAILY_COLUMNS)


def _outcome_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "transaction_id",
        "event_ts",
        "event_hour",
        "card_region",
        "card_segment",
        "merchant_category",
        "merchant_region",
        "merchant_risk_tier",
        "amount",
        "amount_band",
        "channel",
        "is_declined",
        coalesce_default("is_answer_key_anomaly", False).alias("is_answer_key_anomaly"),
        coalesce_default("answer_key_label_count", 0).alias("answer_key_label_count"),
        "answer_key_labels_json",
        "event_date",
    )


def model_evaluator_transaction_outcomes(
    transactions: DataFrame, answer_keys: DataFrame
) -> DataFrame:
    """Outcomes from two separate tables, joined on the transaction."""
    return _outcome_columns(
        left_join_answer_keys(transactions, answer_keys, ANSWER_KEY_COLUMNS)
    )


def _evaluator_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        *DAILY_COLUMNS[:7],
        "decline_rate",
        coalesce_default("anomaly_transaction_count", 0).alias("anomaly_transaction_count"),
        coalesce_default("anomalous_amount", 0.0).alias("anomalous_amount"),
        coalesce_default("anomaly_rate", 0.0).alias("anomaly_rate"),
        "average_anomalous_amount",
        "event_date",
    )


def model_evaluator_daily_metrics(daily: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Daily metrics of two separate tables, joined on the four dimensions."""
    return _evaluator_columns(left_join_daily_dimensions(daily, anomalies, ANOMALY_MEASURES))


def management_daily_summary(evaluator_daily: DataFrame) -> DataFrame:
    """One row per day. The average is the unweighted mean of the group means."""
    transactions = F.sum("transaction_count")
    anomalies = F.sum(coalesce_default("anomaly_transaction_count", 0))
    return (
        evaluator_daily.groupBy("event_date")
        .agg(
            transactions.alias("transaction_count"),
            sum_as_double("gross_amount").alias("gross_amount"),
            mean_of_means("average_amount").alias("average_transaction_amount"),
            F.sum("declined_transaction_count").alias("declined_transaction_count"),
            safe_ratio(F.sum("declined_transaction_count"), transactions).alias("decline_rate"),
            anomalies.alias("anomaly_transaction_count"),
            safe_ratio(anomalies, transactions).alias("anomaly_rate"),
        )
        .select(
            "transaction_count",
            "gross_amount",
            "average_transaction_amount",
            "declined_transaction_count",
            "decline_rate",
            "anomaly_transaction_count",
            "anomaly_rate",
            "event_date",
        )
    )


# The same marts straight from the deduplicated events. -----------------------------


def scored_transactions(events: DataFrame) -> DataFrame:
    """Transactions with their amount band and answer-key columns, without a join.

    Equals the left join of gold transactions to gold answer keys on the transaction id,
    which is unique in ``events``: a row has a key where it is an anomaly or labelled,
    and a NULL id matches nothing.
    """
    has_key = F.col("transaction_id").isNotNull() & F.coalesce(
        F.col("is_answer_key_anomaly") | (F.col("answer_key_label_count") > 0), F.lit(False)
    )
    keys = [F.when(has_key, F.col(name)).alias(name) for name in ANSWER_KEY_COLUMNS]
    kept = [name for name in events.columns if name not in ANSWER_KEY_COLUMNS]
    band = below_bands("amount", AMOUNT_BANDS, AMOUNT_ABOVE)
    return events.select(*kept, band.alias("amount_band"), *keys)


def anomaly_metrics_from_events(events: DataFrame) -> DataFrame:
    return _anomaly_metrics(scored_transactions(events))


def outcomes_from_events(events: DataFrame) -> DataFrame:
    return _outcome_columns(scored_transactions(events))


def evaluator_daily_from_events(events: DataFrame) -> DataFrame:
    """Both sets of daily metrics in one aggregation.

    The two daily tables have the same groups, so joining them only drops the anomaly
    side of groups with a NULL dimension.
    """
    both = (
        scored_transactions(events)
        .groupBy(*DAILY_DIMENSIONS)
        .agg(*_daily_measures(), *_anomaly_measures())
    )
    joinable = F.lit(True)
    for name in DAILY_DIMENSIONS:
        joinable = joinable & F.col(name).isNotNull()
    return _evaluator_columns(
        both.withColumns({name: F.when(joinable, F.col(name)) for name in ANOMALY_MEASURES})
    )
