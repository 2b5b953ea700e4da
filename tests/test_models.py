from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluiceway import contracts
from sluiceway.plans import deliveries as dlv, events as evt, transactions as txn
from sluiceway.registry import adapters, models
from sluiceway.session import materialize

RAW = {
    "__row_index": 0,
    "__is_anomaly": False,
    "__labels": None,
    "card_region": "r",
    "merchant_category": "c",
    "merchant_risk_tier": None,
    "amount": 10.0,
    "channel": "online",
    "is_declined": 0,
    "_landing_key": "k",
    "_logical_date": "2026-03-12T05:30:00+00:00",
    "_ingested_at": "2026-03-12T06:00:00+00:00",
    "_raw_bundle_id": "b",
    "_raw_bundle_key": "raw/b",
    "_raw_standardized_at": "2026-03-13T00:00:00+00:00",
    "_raw_bundle_logical_date": "2026-03-12T00:00:00+00:00",
    "_raw_bundle_granularity": "day",
    "_raw_input_object_count": 1,
    "_raw_bundle_row_count": 1,
}


def events_of(spark, *changes):
    names = contracts.names(contracts.RAW_TRANSACTIONS)
    data = [tuple({**RAW, "__row_index": i, **c}.get(n) for n in names) for i, c in enumerate(changes)]
    raw = spark.createDataFrame(data, contracts.RAW_TRANSACTIONS)
    return txn.bronze_transaction_events(raw, txn.bronze_canonical_raw_bundles(raw))


def test_newest_ingestion_wins_and_unknown_times_lose(spark):
    same = {"__row_index": 1}
    events = events_of(
        spark,
        {**same, "amount": 1.0, "_ingested_at": "bad"},
        {**same, "amount": 2.0, "_ingested_at": "2026-03-12T07:00:00Z"},
        {**same, "amount": 3.0},
    )
    (row,) = events.collect()
    assert (row.transaction_id, row.amount) == ("k:1", 2.0)
    assert str(row.event_hour) == "2026-03-12 05:00:00"


def test_bad_logical_date_fails_the_model(spark):
    with pytest.raises(Exception, match="not an ISO 8601"):
        events_of(spark, {"_logical_date": "yesterday"}).collect()


def test_bands_risk_and_declines(spark):
    gold = txn.gold_transactions(
        txn.silver_transactions(
            events_of(
                spark,
                {"amount": None, "merchant_risk_tier": "High", "is_declined": 1},
                {"amount": 25.0, "is_declined": None},
            )
        )
    )
    found = [
        (r.amount_band, r.is_high_risk_merchant, r.is_declined)
        for r in gold.orderBy("source_row_index").collect()
    ]
    assert found == [("large", True, True), ("small", False, False)]
    assert not set(gold.columns) & set(txn.ANSWER_KEY_COLUMNS)


def both_routes(spark, events):
    """Each answer-key mart by joining tables and straight from the events."""
    gold = txn.gold_transactions(txn.silver_transactions(events))
    keys = txn.gold_transaction_answer_keys(txn.silver_transaction_answer_keys(events))
    daily = txn.gold_daily_transaction_metrics(gold)
    anomalies = txn.gold_daily_anomaly_metrics(gold, keys)
    return [
        (anomalies, txn.anomaly_metrics_from_events(events)),
        (
            txn.model_evaluator_transaction_outcomes(gold, keys),
            txn.outcomes_from_events(events),
        ),
        (
            txn.model_evaluator_daily_metrics(daily, anomalies),
            txn.evaluator_daily_from_events(events),
        ),
    ]


def assert_same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_join_free_marts_equal_the_joined_ones(spark):
    events = events_of(
        spark,
        {"__is_anomaly": True},
        {"__is_anomaly": None, "__labels": '["x"]'},
        {"__is_anomaly": None, "__labels": "[]"},
        {"__labels": '["x", "y"]', "amount": None},
        {"__is_anomaly": True, "channel": None},
        {"__is_anomaly": True, "__labels": '["n"]', "_landing_key": None},
        {"__is_anomaly": True, "card_region": "other", "__labels": '["x"]'},
    )
    for joined, direct in both_routes(spark, events):
        assert_same(joined, direct)


def test_join_free_marts_equal_the_joined_ones_on_test_data(spark, sf_dir):
    events = materialize(models.txn_events(spark, sf_dir), "events")
    for joined, direct in both_routes(spark, events):
        assert_same(joined, direct)


def test_null_dimensions_do_not_match_in_the_daily_join(spark):
    events = events_of(spark, {"__is_anomaly": True, "channel": None}, {"__is_anomaly": True})
    found = {r.channel: r for r in txn.evaluator_daily_from_events(events).collect()}
    assert found[None].anomaly_transaction_count == 0
    assert found[None].average_anomalous_amount is None
    assert found["online"].anomaly_transaction_count == 1


def test_summary_is_the_mean_of_group_means(spark):
    events = events_of(
        spark, {"amount": 10.0}, {"amount": 20.0}, {"amount": 100.0, "channel": "phone"}
    )
    (row,) = txn.management_daily_summary(txn.evaluator_daily_from_events(events)).collect()
    assert row.average_transaction_amount == (15.0 + 100.0) / 2
    assert (row.transaction_count, row.gross_amount) == (3, 130.0)


def test_the_flagship_plan_shuffles_rows_once(spark, sf_dir):
    """Rows move for the dedupe only; what follows are shuffles of partial aggregates."""
    summary = models.txn_summary(spark, sf_dir)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(transaction_id" in plan
    assert plan.count("row_number(), 1, Partial") == 1
    # The dedupe, the daily groups and the days.
    assert plan.count("Exchange hashpartitioning") == 3


def test_delivery_labels_and_file_names(spark):
    names = contracts.names(contracts.RAW_DELIVERIES)
    base = {
        **{n: RAW.get(n) for n in names},
        "record_number": "1",
        "member_id": "7",
        "allowed_amount": "1.5",
        "delivery_date": "2026-03",
        "delivery_id": "d",
    }
    data = [
        tuple({**base, "source_system_id": f"location_{i}", "record_number": str(i), "_landing_key": key}[n] for n in names)
        for i, key in ((1, "a/l1.csv"), (3, "a/l3.txt"))
    ]
    raw = spark.createDataFrame(data, contracts.RAW_DELIVERIES)
    records = dlv.bronze_delivery_records(raw, dlv.bronze_canonical_raw_bundles(raw))
    found = [
        (r.location_label, r.source_file_name, r.delivery_date, str(r.event_date))
        for r in dlv.silver_delivery_records(records).orderBy("location_code").collect()
    ]
    assert found == [
        ("Location 1", "l1.csv", None, "2026-03-12"),
        ("location_3", None, None, "2026-03-12"),
    ]


def test_latest_device_status_spans_dates(spark, sf_dir):
    staged = evt.stg_sensor_events(adapters.raw_events(spark, sf_dir))
    events = evt.int_sensor_events(staged)
    latest = evt.analytics_device_latest_status(events)
    assert latest.count() == events.select("device_id").distinct().count()
    newest = events.groupBy("device_id").agg(F.max("emitted_at").alias("emitted_at"))
    assert latest.join(newest, ["device_id", "emitted_at"]).count() == latest.count()


def test_tables_are_read_in_splits_whose_typed_rows_fit_a_task(spark, tmp_path):
    """Newest-per-key sorts the rows of a split: the splits stay small however large the table."""
    wide = spark.range(600_000).selectExpr("id", "sha2(cast(id as string), 256) as text")
    path = f"{tmp_path}/lineitem.parquet"
    wide.coalesce(1).write.option("parquet.block.size", 4 << 20).parquet(path)
    read = adapters.table(spark, str(tmp_path), "lineitem")
    size = sum(file.stat().st_size for file in Path(path).glob("*.parquet"))
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert size > 32 << 20 and read.select("*").rdd.getNumPartitions() > size >> 24
    finally:
        if before is None:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        else:
            spark.conf.set("spark.sql.files.minPartitionNum", before)
