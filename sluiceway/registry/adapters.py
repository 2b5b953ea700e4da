"""Raw contracts projected from the star-schema test tables, one row per source row.

The mapping makes the cases the models must handle: several versions of a record,
competing and manual bundles, unparsable stamps and labels, NULL dimensions. Amounts are
whole multiples of a power of two, so sums do not depend on the order of addition.
``oracle.py`` states the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluiceway import session

# Total orders for the newest-row selections over these tables.
TRANSACTION_TIEBREAK = ("card_id", "merchant_id", "amount")
DELIVERY_TIEBREAK = ("delivery_date", "allowed_amount", "logical_ts", "feed_type")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, straight from its files."""
    session.configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    """Concatenation; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _iso(ts: Column, fraction: bool = False) -> Column:
    return F.date_format(ts, f"yyyy-MM-dd'T'HH:mm:ss{'.SSSSSS' if fraction else ''}'+00:00'")


def _stamp(date: Column, hours: Column | int = 0, seconds: Column | None = None) -> Column:
    """ISO text of a date plus less than a day. Cheaper than formatting a timestamp."""
    if seconds is None:
        clock = [_two(F.lit(hours) if isinstance(hours, int) else hours), F.lit(":00:00+00:00")]
    else:
        minutes = F.floor(seconds / 60)
        clock = [
            _two(F.floor(minutes / 60)),
            F.lit(":"),
            _two(minutes % 60),
            F.lit(":"),
            _two(seconds % 60),
            F.lit("+00:00"),
        ]
    return F.concat(date.cast("string"), F.lit("T"), *clock)


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_TRANSACTIONS from ``lineitem``: an order line is a transaction, its repeats are
    later deliveries of it."""
    line = table(spark, sf_dir, "lineitem")
    order, number = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    day = F.to_date("l_shipdate")
    year = F.year(day).cast("string")
    day_of_month = F.dayofmonth(day)
    manual = supplier % 50 == 0
    run = F.when(F.col("l_quantity") <= 5, 1).otherwise(2)
    bundle = F.when(manual, _text("manual-", year)).otherwise(_text(day, "-run", run))
    hours = (
        F.when(day_of_month == 10, 6 - run).when(day_of_month == 15, 2).otherwise(1 + run)
    )
    labels = (
        F.when(part % 40 == 0, '["velocity", "geo"]')
        .when(part % 40 == 1, '["amount"]')
        .when(part % 40 == 2, "not json")
        .when(part % 40 == 3, "null")
        .when(part % 40 == 4, '{"a": 1}')
        .when(part % 40 < 20, "[]")
    )
    tier = (
        F.when(supplier % 6 == 0, "High")
        .when(supplier % 6 == 1, "CRITICAL")
        .when(supplier % 6 == 2, "low")
        .when(supplier % 6 == 3, "medium")
        .when(supplier % 6 == 5, "high")
    )
    channel = (
        F.when(F.col("l_returnflag") == "A", "online")
        .when(F.col("l_returnflag") == "N", "in_store")
        .otherwise("phone")
    )
    # Whole cents over a power of two: sums are exact in any order.
    amount = F.when(
        F.col("l_quantity") < 50, F.round(F.col("l_extendedprice") * 100) / F.lit(16384.0)
    )
    declined = F.when(F.col("l_tax") < 0.005, F.lit(None)).when(
        (F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.045), 1
    )
    standardized = (
        F.when(manual, _stamp(F.date_add(F.trunc(day, "year"), 400)))
        .when((run == 1) & (day_of_month == 20), "pending")
        .otherwise(_stamp(F.date_add(day, 1), hours))
    )
    values = {
        "__row_index": number.cast("bigint"),
        "__is_anomaly": F.when(F.col("l_discount") > 0.005, F.col("l_discount") > 0.085),
        "__labels": labels,
        "card_id": _text("card_", part),
        "card_region": F.when(supplier % 11 != 0, _text("region_", supplier % 5)),
        "card_segment": _text("segment_", F.col("l_linestatus")),
        "merchant_id": _text("merchant_", supplier),
        "merchant_category": _text("category_", part % 6),
        "merchant_region": _text("region_", supplier % 5),
        "merchant_risk_tier": tier,
        "amount": amount,
        "channel": channel,
        "is_declined": F.when(F.col("l_tax") >= 0.005, F.coalesce(declined, F.lit(0))).cast(
            "bigint"
        ),
        "_landing_key": _text("transactions/order=", order, ".json"),
        "_standardize_strategy": F.lit("json_bundle"),
        "_source_preset_id": F.lit("transactions"),
        "_logical_date": _stamp(day, part % 24),
        "_ingested_at": F.when(part % 97 == 0, "unknown").otherwise(
            _stamp(day, seconds=part % 86400)
        ),
        "_schema_version": _text("v", number % 2 + 1),
        "_scenario_name": F.lit("lineitem"),
        "_response_row_count": F.lit(250).cast("bigint"),
        "_raw_bundle_id": bundle,
        "_raw_bundle_key": _text("raw/", bundle, "/part=", number % 2, ".parquet"),
        "_raw_bundle_manifest_key": _text("raw/_", bundle, ".manifest.json"),
        "_raw_standardized_at": standardized,
        "_raw_bundle_logical_date": F.when(~manual, _stamp(day)),
        "_raw_bundle_granularity": F.when(manual, "manual").otherwise("day"),
        "_raw_input_object_count": F.lit(24).cast("bigint"),
        "_raw_bundle_row_count": (1000 + F.when(manual, 0).otherwise(day_of_month) + number % 2).cast(
            "bigint"
        ),
    }
    return line.select(*[column.alias(name) for name, column in values.items()])


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_DELIVERIES from ``orders``: a customer is a record of its location's yearly
    delivery, each order a version of it."""
    orders = table(spark, sf_dir, "orders")
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    day = F.to_date("o_orderdate")
    month = F.trunc(day, "month")
    year_month = F.substring(day.cast("string"), 1, 7)
    location = _text("location_", customer % 3 + 1)
    delivery = _text(location, "-", F.year(day).cast("string"))
    run = F.when(order % 10 == 0, 1).otherwise(2)
    bundle = _text(year_month, "-run", run)
    delivery_date = (
        F.when(order % 20 == 0, F.lit(None))
        .when(order % 20 == 1, year_month)
        .when(order % 20 == 2, "not-a-date")
        .when(order % 20 == 3, _stamp(day))
        .otherwise(day.cast("string"))
    )
    amount = (F.floor("o_totalprice") + F.lit(0.25)).cast("decimal(18,2)").cast("string")
    key = _text("deliveries/", delivery, "/", location, F.when(order % 13 == 0, ".txt").otherwise(".csv"))
    hours = F.when(F.month(day) == 6, 2).when(F.month(day) == 7, 6 - run).otherwise(run)
    values = {
        "source_system_id": location,
        "delivery_id": delivery,
        "delivery_date": delivery_date,
        "record_number": customer.cast("string"),
        "member_id": (100000 + customer).cast("string"),
        "facility_id": _text("facility_", customer % 12),
        "facility_region": _text("region_", customer % 5),
        "facility_type": F.when(customer % 2 == 0, "clinic").otherwise("hospital"),
        "feed_type": _text("feed_", F.col("o_orderstatus")),
        "member_status": F.when(customer % 7 != 0, "active"),
        "plan_tier": F.col("o_orderpriority"),
        "age_band": _text(customer % 8 * 10, "s"),
        "postal_prefix": F.lpad((customer % 1000).cast("string"), 3, "0"),
        "allowed_amount": F.when(order % 31 != 0, amount),
        "_landing_key": key,
        "_standardize_strategy": F.lit("csv_delivery"),
        "_source_preset_id": F.lit("deliveries"),
        "_logical_date": _stamp(day),
        "_ingested_at": F.when(order % 17 == 0, "late").otherwise(
            _stamp(day, seconds=order % 86400)
        ),
        "_source_system_id": location,
        "_delivery_id": delivery,
        "_delivery_date": day.cast("string"),
        "_feed_type": _text("feed_", F.col("o_orderstatus")),
        "_response_row_count": F.lit("2500"),
        "_raw_bundle_id": bundle,
        "_raw_bundle_key": _text("raw/", bundle, ".parquet"),
        "_raw_bundle_manifest_key": _text("raw/_", bundle, ".parquet.manifest.json"),
        "_raw_standardized_at": _stamp(F.date_add(month, 32), hours),
        "_raw_bundle_logical_date": _stamp(month),
        "_raw_bundle_granularity": F.lit("month"),
        "_raw_input_object_count": F.lit(2).cast("bigint"),
        "_raw_bundle_row_count": (2500 + F.month(day)).cast("bigint"),
    }
    return orders.select(*[column.alias(name) for name, column in values.items()])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_EVENTS from ``events``: three consecutive rows are versions of one event."""
    events = table(spark, sf_dir, "events")
    event = F.col("event_id")
    group = F.floor(event / 3)
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    values = {
        "workflow_name": F.lit("events"),
        "source_preset_id": F.lit("sensors"),
        "source_schema_version": F.lit("v1"),
        "source_scenario_name": F.lit("events"),
        "source_seed": event,
        "emitter_event_id": F.when(event % 50 != 0, _text("evt-", group)),
        "emission_batch_started_at": _iso(F.date_trunc("hour", ts)),
        "emitted_at": _iso(ts, fraction=True),
        "emission_index": (event % 3).cast("int"),
        "device_id": _text("device-", group % 97),
        "site_id": _text("site-", group % 3),
        "device_type": F.when(kind.isin("view", "click"), "thermal").otherwise("combo_sensor"),
        "temperature_c": F.when(kind != "signup", F.floor(F.col("value") * 8).cast("double") / 8),
        "pressure_kpa": F.when(kind != "view", 90 + (event % 160).cast("double") / 8),
        "device_status": F.when(kind == "error", "warning").otherwise("normal"),
    }
    return events.select(*[column.alias(name) for name, column in values.items()])
