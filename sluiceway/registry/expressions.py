"""Projections, scalar functions, aggregates, windows and set operations as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluiceway.functions import aggregates as agg, columns as fn
from sluiceway.operators import bundles, latest, projection
from sluiceway.plans import deliveries as dlv, events as evt, transactions as txn
from sluiceway.registry import adapters
from sluiceway.registry.adapters import raw_deliveries, raw_events, raw_transactions, table
from sluiceway.registry.models import txn_events
from sluiceway.registry.oracle import full_date, with_ctes
from sluiceway.session import materialize

QUERIES = {}
SQL = {}


def query(name: str, sql: str, *ctes: str):
    def register(function):
        QUERIES[name] = function
        SQL[name] = with_ctes(sql, *ctes) if ctes else sql
        return function

    return register


# Projections and filters ------------------------------------------------------------

query("typed_projection", "select * from txn_typed", "txn_typed")(
    lambda s, d: txn.typed_events(raw_transactions(s, d))
)
query(
    "select_columns",
    """select * exclude (is_answer_key_anomaly, answer_key_labels_json, answer_key_label_count)
    from txn_typed""",
    "txn_typed",
)(
    lambda s, d: projection.without_columns(
        txn.typed_events(raw_transactions(s, d)), txn.ANSWER_KEY_COLUMNS
    )
)
query("select_all", "select * from dlv_typed", "dlv_typed")(
    lambda s, d: dlv.typed_records(raw_deliveries(s, d)).select("*")
)


@query(
    "rename_column",
    "select source_system_id as location_code, delivery_id, record_number from raw_dlv",
    "raw_dlv",
)
def rename_column(spark, sf_dir):
    return (
        raw_deliveries(spark, sf_dir)
        .select("source_system_id", "delivery_id", "record_number")
        .withColumnRenamed("source_system_id", "location_code")
    )


query(
    "where_boolean_or",
    """select transaction_id, event_ts, event_hour, is_answer_key_anomaly,
      answer_key_labels_json, answer_key_label_count, landing_key, event_date
    from txn_typed where is_answer_key_anomaly or answer_key_label_count > 0""",
    "txn_typed",
)(lambda s, d: txn.silver_transaction_answer_keys(txn.typed_events(raw_transactions(s, d))))
query(
    "where_not_null",
    "select * from raw_evt where emitter_event_id is not null",
    "raw_evt",
)(lambda s, d: raw_events(s, d).where(F.col("emitter_event_id").isNotNull()))


@query(
    "where_rank_eq_1",
    """select o_custkey, o_orderkey, o_orderdate, o_totalprice from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def where_rank_eq_1(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    ranked = orders.withColumn(
        "rank", latest.newest_rank(["o_custkey"], ["o_orderdate", "o_orderkey"])
    )
    return ranked.where("rank = 1").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query(
    "case_searched",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
      case when l_quantity < 10 then 'micro' when l_quantity < 25 then 'small'
        when l_quantity < 40 then 'medium' else 'large' end as quantity_band,
      case l_linestatus when 'O' then 'Open' else l_linestatus end as status_label
    from lineitem""",
)
def case_searched(spark, sf_dir):
    bands = ((10, "micro"), (25, "small"), (40, "medium"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        fn.below_bands("l_quantity", bands, "large").alias("quantity_band"),
        fn.relabel("l_linestatus", {"O": "Open"}).alias("status_label"),
    )


@query(
    "in_list_ci",
    """select merchant_risk_tier,
      coalesce(lower(merchant_risk_tier) in ('high', 'critical'), false) as is_high_risk,
      count(*) as n
    from raw_txn group by all""",
    "raw_txn",
)
def in_list_ci(spark, sf_dir):
    flag = fn.in_list_ci("merchant_risk_tier", txn.HIGH_RISK_TIERS).alias("is_high_risk")
    return (
        raw_transactions(spark, sf_dir)
        .groupBy("merchant_risk_tier", flag)
        .agg(agg.count_all().alias("n"))
    )


@query(
    "int_flag_to_bool",
    """select is_declined as flag, coalesce(is_declined = 1, false) as is_declined,
      count(*) as n from raw_txn group by all""",
    "raw_txn",
)
def int_flag_to_bool(spark, sf_dir):
    return (
        raw_transactions(spark, sf_dir)
        .groupBy(
            F.col("is_declined").alias("flag"),
            fn.int_flag_to_bool("is_declined").alias("is_declined"),
        )
        .agg(agg.count_all().alias("n"))
    )


query(
    "count_to_flag",
    """select transaction_id, event_ts, event_hour, is_answer_key_anomaly,
      answer_key_label_count, answer_key_labels_json,
      answer_key_label_count > 0 as has_answer_key_labels, landing_key, event_date
    from txn_typed""",
    "txn_typed",
)(lambda s, d: txn.gold_transaction_answer_keys(txn.typed_events(raw_transactions(s, d))))
query(
    "is_null_predicate",
    """select site_id, count(*) filter (pressure_kpa is null) as missing_pressure
    from raw_evt group by site_id""",
    "raw_evt",
)(
    lambda s, d: raw_events(s, d)
    .groupBy("site_id")
    .agg(agg.conditional_count(F.col("pressure_kpa").isNull()).alias("missing_pressure"))
)
query(
    "equality_predicate",
    """select site_id, count(*) filter (device_status = 'warning') as warnings
    from raw_evt group by site_id""",
    "raw_evt",
)(
    lambda s, d: raw_events(s, d)
    .groupBy("site_id")
    .agg(agg.conditional_count(F.col("device_status") == "warning").alias("warnings"))
)
query(
    "chained_ctes",
    "select * from dlv_rollup where raw_bundle_file_count > 1",
    "dlv_rollup",
)(
    lambda s, d: bundles.bundle_rollup(
        bundles.bundle_candidates(raw_deliveries(s, d), "delivery_date")
    ).where("raw_bundle_file_count > 1")
)


@query(
    "lineage_columns",
    """select 'orders/' || o_orderkey || '.json' as _landing_key, 'json_bundle' as _standardize_strategy,
      case when o_orderkey % 3 = 0 then 'preset-' || o_orderstatus else 'fallback' end
        as _source_preset_id,
      strftime(case when o_orderkey % 3 = 0 then o_orderdate else date_trunc('month', o_orderdate) end,
        '%Y-%m-%dT%H:%M:%S+00:00') as _logical_date,
      case when o_orderkey % 3 = 0 then 'stamp-' || o_orderkey end as _ingested_at,
      case when o_orderkey % 3 = 0 then o_orderpriority end as _feed_type
    from orders""",
)
def lineage_columns(spark, sf_dir):
    order = F.col("o_orderkey")
    ts = F.col("o_orderdate").cast("timestamp")
    known = F.create_map(
        F.lit("preset_id"),
        F.concat(F.lit("preset-"), "o_orderstatus"),
        F.lit("logical_date"),
        projection.iso_text(ts),
        F.lit("ingested_at"),
        F.concat(F.lit("stamp-"), order.cast("string")),
        F.lit("feed_type"),
        F.col("o_orderpriority"),
    )
    empty = F.create_map().cast("map<string,string>")
    landed = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("orders/"), order.cast("string"), F.lit(".json")).alias("_landing_key"),
        F.date_trunc("month", ts).alias("slice_start"),
        F.when(order % 3 == 0, known).otherwise(empty).alias("meta"),
    )
    return projection.lineage_columns(
        landed,
        "meta",
        label="json_bundle",
        preset_id="fallback",
        extra_keys={"_feed_type": "feed_type"},
    ).drop("slice_start", "meta")


@query(
    "nested_to_json",
    """select event_id,
      '{"a": [' || event_id || ', "x, y: z"], "z": ' || props || '}' as nested,
      event_type as scalar
    from events""",
)
def nested_to_json(spark, sf_dir):
    text = F.concat(
        F.lit('{"z":'),
        F.col("props"),
        F.lit(',"a":['),
        F.col("event_id").cast("string"),
        F.lit(',"x, y: z"]}'),
    )
    quoted = F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.nested_to_json(F.parse_json(text)).alias("nested"),
        fn.nested_to_json(F.parse_json(quoted)).alias("scalar"),
    )


@query(
    "nested_numbers_to_json",
    r"""select l_orderkey, l_linenumber,
      '{"a b": {"k": -' || l_linenumber || '.5, "l": "' || l_orderkey || '.0, 1e3"}, "z\u00e9": ['
      || l_orderkey || '.0, ' || l_linenumber || '000.0, ' || l_orderkey
      || '00000000000000000000000000000000000000001, ' || l_linenumber || 'e-05]}' as nested
    from lineitem""",
)
def nested_numbers_to_json(spark, sf_dir):
    """Numbers with a point, an exponent or more digits than a long has, as landed text has them."""
    order, line = [F.col(name).cast("string") for name in ("l_orderkey", "l_linenumber")]
    text = F.concat(
        F.lit('{"zé":['), order, F.lit(".0,"), line, F.lit("e3,"), order, F.lit("0" * 40 + "1,"),
        F.lit("0.0000"), line, F.lit('],"a b":{"l":"'), order, F.lit('.0, 1e3","k":-'), line,
        F.lit(".50}}"),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.nested_text_to_json(text).alias("nested")
    )


# Scalar functions -------------------------------------------------------------------

query(
    "iso_to_ts",
    "select source_seed, try_cast(emitted_at as timestamp) as emitted_ts from raw_evt",
    "raw_evt",
)(lambda s, d: raw_events(s, d).select("source_seed", fn.iso_to_ts("emitted_at").alias("emitted_ts")))
query(
    "try_iso_to_ts",
    """select _ingested_at, try_cast(_ingested_at as timestamp) as ingested_ts, count(*) as n
    from raw_txn group by all""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d)
    .groupBy("_ingested_at")
    .agg(agg.count_all().alias("n"))
    .select("_ingested_at", fn.try_iso_to_ts("_ingested_at").alias("ingested_ts"), "n")
)
query(
    "iso_to_date",
    """select source_seed, cast(try_cast(emitted_at as timestamp) as date) as event_date
    from raw_evt""",
    "raw_evt",
)(
    lambda s, d: raw_events(s, d).select(
        "source_seed", fn.iso_to_date("emitted_at").alias("event_date")
    )
)
query(
    "try_cast_date",
    f"""select delivery_date as text, {full_date("delivery_date")} as delivery_date,
      count(*) as n from raw_dlv group by all""",
    "raw_dlv",
)(
    lambda s, d: raw_deliveries(s, d)
    .groupBy(F.col("delivery_date").alias("text"))
    .agg(agg.count_all().alias("n"))
    .select("text", fn.try_cast_date("text").alias("delivery_date"), "n")
)
query("trunc_hour", "select event_id, date_trunc('hour', ts) as event_hour from events")(
    lambda s, d: table(s, d, "events").select("event_id", fn.trunc_hour("ts").alias("event_hour"))
)
query(
    "trunc_day", "select event_id, date_trunc('day', ts)::timestamp as event_day from events"
)(lambda s, d: table(s, d, "events").select("event_id", fn.trunc_day("ts").alias("event_day")))
query(
    "coalesce_n",
    """select o_orderkey, coalesce(case when o_orderkey % 2 = 0 then o_orderstatus end,
      case when o_orderkey % 3 = 0 then o_orderpriority end, 'none') as first_known
    from orders""",
)(
    lambda s, d: table(s, d, "orders").select(
        "o_orderkey",
        F.coalesce(
            F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")),
            F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")),
            F.lit("none"),
        ).alias("first_known"),
    )
)
query(
    "nullif_zero",
    "select l_orderkey, l_linenumber, l_partkey, nullif(l_tax, 0) as tax from lineitem",
)(
    lambda s, d: table(s, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
    )
)
query(
    "concat_key",
    """select _landing_key || ':' || __row_index as transaction_id,
      card_region || ':' || merchant_id as region_key
    from raw_txn""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d).select(
        fn.concat_key("_landing_key", "__row_index").alias("transaction_id"),
        fn.concat_key("card_region", "merchant_id").alias("region_key"),
    )
)
query("lower_text", "select c_custkey, lower(c_mktsegment) as segment from customer")(
    lambda s, d: table(s, d, "customer").select(
        "c_custkey", F.lower("c_mktsegment").alias("segment")
    )
)
query(
    "file_name_from_key",
    """select _landing_key, nullif(regexp_extract(_landing_key, '([^/]+[.]csv)$', 1), '')
      as file_name from raw_dlv""",
    "raw_dlv",
)(
    lambda s, d: raw_deliveries(s, d).select(
        "_landing_key", fn.file_name_from_key("_landing_key").alias("file_name")
    )
)
query(
    "json_label_count",
    """select __labels as labels,
      case when json_valid(__labels) and json_type(__labels) = 'ARRAY'
        then cast(json_array_length(__labels) as integer) else 0 end as label_count,
      count(*) as n
    from raw_txn group by all""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d)
    .groupBy(F.col("__labels").alias("labels"))
    .agg(agg.count_all().alias("n"))
    .select("labels", fn.json_label_count("labels").alias("label_count"), "n")
)
query(
    "cast_scalar",
    """select cast(record_number as bigint) as record_number, cast(member_id as bigint) as member_id,
      cast(allowed_amount as double) as allowed_amount,
      cast(_response_row_count as integer) as response_row_count,
      cast(_delivery_date as date) as delivery_date
    from raw_dlv""",
    "raw_dlv",
)(
    lambda s, d: projection.typed_projection(
        raw_deliveries(s, d),
        {
            "record_number": "record_number:bigint",
            "member_id": "member_id:bigint",
            "allowed_amount": "allowed_amount:double",
            "response_row_count": "_response_row_count:int",
            "delivery_date": "_delivery_date:date",
        },
    )
)
query(
    "coalesce_default",
    """select card_id, merchant_id, _ingested_at, coalesce(__is_anomaly, false) as is_anomaly,
      coalesce(is_declined, 0) as is_declined, coalesce(amount, 0.0::double) as amount
    from raw_txn""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d).select(
        "card_id",
        "merchant_id",
        "_ingested_at",
        fn.coalesce_default("__is_anomaly", False).alias("is_anomaly"),
        fn.coalesce_default("is_declined", 0).alias("is_declined"),
        fn.coalesce_default("amount", 0.0).alias("amount"),
    )
)

# Aggregates -------------------------------------------------------------------------

query("count_all", "select merchant_id, count(*) as n from raw_txn group by 1", "raw_txn")(
    lambda s, d: raw_transactions(s, d).groupBy("merchant_id").agg(agg.count_all().alias("n"))
)
query(
    "count_distinct",
    """select facility_region, count(distinct delivery_id) as deliveries,
      count(distinct member_id) as members, count(*) as records,
      count(distinct feed_type) as feeds
    from raw_dlv group by 1""",
    "raw_dlv",
)(
    lambda s, d: raw_deliveries(s, d)
    .groupBy("facility_region")
    .agg(
        F.count_distinct("delivery_id").alias("deliveries"),
        F.count_distinct("member_id").alias("members"),
        agg.count_all().alias("records"),
        F.count_distinct("feed_type").alias("feeds"),
    )
)
query(
    "sum_as_double",
    "select merchant_id, sum(amount) as gross from raw_txn group by 1",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d)
    .groupBy("merchant_id")
    .agg(agg.sum_as_double("amount").alias("gross"))
)
query(
    "avg_measure",
    """select site_id, avg(temperature_c) as avg_temperature, avg(pressure_kpa) as avg_pressure
    from raw_evt group by 1""",
    "raw_evt",
)(
    lambda s, d: raw_events(s, d)
    .groupBy("site_id")
    .agg(
        F.avg("temperature_c").alias("avg_temperature"),
        agg.avg_as_double("pressure_kpa").alias("avg_pressure"),
    )
)
query(
    "max_measure",
    """select o_orderstatus, max(o_orderdate) as last_order, max(o_orderpriority) as last_priority,
      max(o_orderkey) as last_key, cast(max(o_orderdate) as date) as last_date
    from orders group by 1""",
)(
    lambda s, d: table(s, d, "orders")
    .groupBy("o_orderstatus")
    .agg(
        F.max("o_orderdate").alias("last_order"),
        F.max("o_orderpriority").alias("last_priority"),
        F.max("o_orderkey").alias("last_key"),
        F.max(F.to_date("o_orderdate")).alias("last_date"),
    )
)
query(
    "conditional_count",
    """select channel, count(*) filter (is_declined = 1) as declined,
      count(*) filter (__is_anomaly) as anomalies
    from raw_txn group by 1""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d)
    .groupBy("channel")
    .agg(
        agg.conditional_count(F.col("is_declined") == 1).alias("declined"),
        agg.conditional_count(F.col("__is_anomaly")).alias("anomalies"),
    )
)
query(
    "conditional_sum",
    """select channel, merchant_id,
      sum(case when is_declined = 1 then amount else 0 end) as declined_amount
    from raw_txn group by 1, 2""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d)
    .groupBy("channel", "merchant_id")
    .agg(agg.conditional_sum(F.col("is_declined") == 1, "amount").alias("declined_amount"))
)
query(
    "conditional_avg",
    """select channel, merchant_id, avg(amount) filter (__is_anomaly) as anomaly_average
    from raw_txn group by 1, 2""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d)
    .groupBy("channel", "merchant_id")
    .agg(agg.conditional_avg(F.col("__is_anomaly"), "amount").alias("anomaly_average"))
)
query(
    "safe_ratio",
    """select merchant_id, count(*) filter (is_declined = 1) / nullif(count(is_declined), 0)::double
      as decline_rate
    from raw_txn group by 1""",
    "raw_txn",
)(
    lambda s, d: raw_transactions(s, d)
    .groupBy("merchant_id")
    .agg(
        agg.safe_ratio(
            agg.conditional_count(F.col("is_declined") == 1), F.count("is_declined")
        ).alias("decline_rate")
    )
)


@query(
    "rollup_of_groups",
    """select day, cast(sum(n) as bigint) as n, cast(sum(warnings) as bigint) as warnings,
      count(*) as n_groups
    from (select cast(try_cast(emitted_at as timestamp) as date) as day, site_id, device_type,
        count(*) as n, count(*) filter (device_status = 'warning') as warnings
      from raw_evt group by 1, 2, 3)
    group by day""",
    "raw_evt",
)
def rollup_of_groups(spark, sf_dir):
    groups = (
        raw_events(spark, sf_dir)
        .groupBy(fn.iso_to_date("emitted_at").alias("day"), "site_id", "device_type")
        .agg(
            agg.count_all().alias("n"),
            agg.conditional_count(F.col("device_status") == "warning").alias("warnings"),
        )
    )
    return groups.groupBy("day").agg(
        F.sum("n").alias("n"),
        F.sum("warnings").alias("warnings"),
        agg.count_all().alias("n_groups"),
    )


query(
    "group_by_n",
    """select location_code, location_label, source_file_name, delivery_id, feed_type,
      count(*) as record_count, sum(allowed_amount) as total_allowed_amount,
      avg(allowed_amount) as average_allowed_amount, delivery_date
    from (select source_system_id as location_code,
        case source_system_id when 'location_1' then 'Location 1'
          when 'location_2' then 'Location 2' else source_system_id end as location_label,
        nullif(regexp_extract(landing_key, '([^/]+[.]csv)$', 1), '') as source_file_name, *
      from dlv_typed)
    group by location_code, location_label, source_file_name, delivery_id, feed_type,
      delivery_date""",
    "dlv_typed",
)(
    lambda s, d: dlv.silver_delivery_batches(
        dlv.silver_delivery_records(dlv.typed_records(raw_deliveries(s, d)))
    )
)
query("bundle_rollup", "select * from txn_rollup", "txn_rollup")(
    lambda s, d: bundles.bundle_rollup(bundles.bundle_candidates(raw_transactions(s, d)))
)

# Windows, top-k, set operations -----------------------------------------------------

query(
    "canonical_bundle_rank",
    """select raw_bundle_id, bundle_granularity, bundle_selector_key, raw_standardized_ts,
      row_number() over (partition by bundle_granularity, bundle_selector_key
        order by raw_standardized_ts desc nulls last, raw_bundle_id desc) as bundle_rank
    from txn_rollup""",
    "txn_rollup",
)(
    lambda s, d: bundles.bundle_rollup(bundles.bundle_candidates(raw_transactions(s, d))).select(
        "raw_bundle_id",
        "bundle_granularity",
        "bundle_selector_key",
        "raw_standardized_ts",
        latest.newest_rank(
            ["bundle_granularity", "bundle_selector_key"],
            ["raw_standardized_ts", "raw_bundle_id"],
        )
        .cast("bigint")
        .alias("bundle_rank"),
    )
)
query(
    "dedupe_transactions",
    """select * from txn_typed qualify row_number() over (
      partition by transaction_id order by ingested_ts desc nulls last,
      event_ts desc nulls last, source_row_index desc nulls last, card_id desc nulls last,
      merchant_id desc nulls last, amount desc nulls last) = 1""",
    "txn_typed",
)(
    lambda s, d: txn.dedupe_transactions(
        txn.typed_events(raw_transactions(s, d)), adapters.TRANSACTION_TIEBREAK
    )
)
query(
    "dedupe_delivery_records",
    """select * from dlv_typed qualify row_number() over (
      partition by delivery_record_id order by ingested_ts desc nulls last,
      raw_standardized_ts desc nulls last, record_number desc nulls last,
      delivery_date desc nulls last, allowed_amount desc nulls last,
      logical_ts desc nulls last, feed_type desc nulls last) = 1""",
    "dlv_typed",
)(
    lambda s, d: dlv.dedupe_delivery_records(
        dlv.typed_records(raw_deliveries(s, d)), adapters.DELIVERY_TIEBREAK
    )
)
query("dedupe_sensor_events", "select * from evt_events", "evt_events")(
    lambda s, d: evt.int_sensor_events(evt.stg_sensor_events(raw_events(s, d)))
)
query(
    "latest_per_device",
    """select device_id, site_id, device_type, device_status, temperature_c, pressure_kpa,
      emitted_at, event_date from evt_staged
    qualify row_number() over (partition by device_id
      order by emitted_at desc, emission_index desc) = 1""",
    "evt_staged",
)(lambda s, d: evt.analytics_device_latest_status(evt.stg_sensor_events(raw_events(s, d))))
query(
    "top_1_per_key",
    """select * from events
    qualify row_number() over (partition by user_id order by value desc, event_id desc) = 1""",
)(lambda s, d: latest.latest_by(table(s, d, "events"), ["user_id"], ["value"], ["event_id"]))
query(
    "location_counts",
    "select source_system_id as location_code, count(*) as record_count from raw_dlv group by 1",
    "raw_dlv",
)(lambda s, d: dlv.location_counts(dlv.silver_delivery_records(dlv.typed_records(raw_deliveries(s, d)))))
query("select_distinct", "select * from dlv_candidates", "dlv_candidates")(
    lambda s, d: bundles.bundle_candidates(raw_deliveries(s, d), "delivery_date")
)


@query(
    "concat_inputs",
    """select doc_id as id, 'document' as kind, lang as label from documents
    union all by name select page_id as id, 'page' as kind, null as label from pages""",
)
def concat_inputs(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.lit("document").alias("kind"), F.col("lang").alias("label")
    )
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.lit("page").alias("kind")
    )
    return documents.unionByName(pages, allowMissingColumns=True)


# Joins of models --------------------------------------------------------------------


def _written_events(spark, sf_dir):
    """Deduplicated transactions as a written table, as the joined models would read it."""
    return materialize(txn_events(spark, sf_dir), "txn-events")


def _gold_and_keys(spark, sf_dir):
    events = _written_events(spark, sf_dir)
    gold = txn.gold_transactions(txn.silver_transactions(events))
    keys = txn.gold_transaction_answer_keys(txn.silver_transaction_answer_keys(events))
    return gold, keys


@query("keep_canonical_rows", "select * from txn_canonical_rows", "txn_canonical_rows")
def keep_canonical_rows(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    winners = materialize(txn.bronze_canonical_raw_bundles(raw), "txn-bundles")
    return bundles.keep_canonical_rows(txn.typed_events(raw), winners)


query("left_join_answer_keys", "select * from txn_outcomes", "txn_outcomes")(
    lambda s, d: txn.model_evaluator_transaction_outcomes(*_gold_and_keys(s, d))
)
query("left_join_then_group", "select * from txn_anomalies", "txn_anomalies")(
    lambda s, d: txn.gold_daily_anomaly_metrics(*_gold_and_keys(s, d))
)


@query("left_join_daily_dims", "select * from txn_evaluator", "txn_evaluator")
def left_join_daily_dims(spark, sf_dir):
    gold, keys = _gold_and_keys(spark, sf_dir)
    return txn.model_evaluator_daily_metrics(
        txn.gold_daily_transaction_metrics(gold), txn.gold_daily_anomaly_metrics(gold, keys)
    )
