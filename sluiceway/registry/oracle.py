"""SQL building blocks of the checks: the raw mappings and the models, as DuckDB CTEs."""

from __future__ import annotations


def _iso(ts: str, fraction: bool = False) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S{'.%f' if fraction else ''}+00:00')"


def _ts(text: str) -> str:
    return f"try_cast({text} as timestamp)"


def _day(text: str) -> str:
    return f"cast({_ts(text)} as date)"


def full_date(text: str) -> str:
    return (
        f"case when regexp_full_match({text}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
        f"then try_cast({text} as date) end"
    )


CTES: dict[str, str] = {}
NEEDS: dict[str, tuple[str, ...]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = sql
    NEEDS[name] = needs


def with_ctes(select: str, *names: str) -> str:
    """``WITH`` the named CTEs and all they need, then the select."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS[name]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    body = ",\n".join(f"{name} as (\n{CTES[name]}\n)" for name in order)
    return f"with {body}\n{select}"


# Raw contracts ----------------------------------------------------------------------

_cte(
    "raw_txn",
    f"""
    select
      cast(l_linenumber as bigint) as __row_index,
      case when l_discount > 0.005 then l_discount > 0.085 end as __is_anomaly,
      case
        when l_partkey % 40 = 0 then '["velocity", "geo"]'
        when l_partkey % 40 = 1 then '["amount"]'
        when l_partkey % 40 = 2 then 'not json'
        when l_partkey % 40 = 3 then 'null'
        when l_partkey % 40 = 4 then '{{"a": 1}}'
        when l_partkey % 40 < 20 then '[]'
      end as __labels,
      'card_' || l_partkey as card_id,
      case when l_suppkey % 11 <> 0 then 'region_' || (l_suppkey % 5) end as card_region,
      'segment_' || l_linestatus as card_segment,
      'merchant_' || l_suppkey as merchant_id,
      'category_' || (l_partkey % 6) as merchant_category,
      'region_' || (l_suppkey % 5) as merchant_region,
      case l_suppkey % 6
        when 0 then 'High' when 1 then 'CRITICAL' when 2 then 'low' when 3 then 'medium'
        when 5 then 'high'
      end as merchant_risk_tier,
      case when l_quantity < 50 then round(l_extendedprice * 100) / 16384.0::double end as amount,
      case l_returnflag when 'A' then 'online' when 'N' then 'in_store' else 'phone' end
        as channel,
      cast(case
        when l_tax < 0.005 then null
        when l_returnflag = 'R' and l_tax > 0.045 then 1
        else 0
      end as bigint) as is_declined,
      'transactions/order=' || l_orderkey || '.json' as _landing_key,
      'json_bundle' as _standardize_strategy,
      'transactions' as _source_preset_id,
      {_iso("ship_day + to_hours(l_partkey % 24)")} as _logical_date,
      case when l_partkey % 97 = 0 then 'unknown'
        else {_iso("ship_day + to_seconds(l_partkey % 86400)")} end as _ingested_at,
      'v' || (l_linenumber % 2 + 1) as _schema_version,
      'lineitem' as _scenario_name,
      cast(250 as bigint) as _response_row_count,
      bundle as _raw_bundle_id,
      'raw/' || bundle || '/part=' || (l_linenumber % 2) || '.parquet' as _raw_bundle_key,
      'raw/_' || bundle || '.manifest.json' as _raw_bundle_manifest_key,
      case
        when is_manual then {_iso("date_trunc('year', ship_day)::timestamp + interval 400 day")}
        when run = 1 and dom = 20 then 'pending'
        else {_iso("ship_day + interval 1 day + to_hours(case dom when 10 then 6 - run when 15 then 2 else 1 + run end)")}
      end as _raw_standardized_at,
      case when not is_manual then {_iso("ship_day")} end as _raw_bundle_logical_date,
      case when is_manual then 'manual' else 'day' end as _raw_bundle_granularity,
      cast(24 as bigint) as _raw_input_object_count,
      cast(1000 + case when is_manual then 0 else dom end + l_linenumber % 2 as bigint)
        as _raw_bundle_row_count
    from (
      select *, case when is_manual then 'manual-' || strftime(ship_day, '%Y')
          else strftime(ship_day, '%Y-%m-%d') || '-run' || run end as bundle
      from (
        select *, date_trunc('day', l_shipdate)::timestamp as ship_day,
          cast(day(l_shipdate) as integer) as dom,
          l_suppkey % 50 = 0 as is_manual,
          case when l_quantity <= 5 then 1 else 2 end as run
        from lineitem
      )
    )
    """,
)

_cte(
    "raw_dlv",
    f"""
    select
      location as source_system_id,
      delivery as delivery_id,
      case o_orderkey % 20
        when 0 then null
        when 1 then strftime(order_day, '%Y-%m')
        when 2 then 'not-a-date'
        when 3 then {_iso("order_day")}
        else strftime(order_day, '%Y-%m-%d')
      end as delivery_date,
      cast(o_custkey as varchar) as record_number,
      cast(100000 + o_custkey as varchar) as member_id,
      'facility_' || (o_custkey % 12) as facility_id,
      'region_' || (o_custkey % 5) as facility_region,
      case when o_custkey % 2 = 0 then 'clinic' else 'hospital' end as facility_type,
      'feed_' || o_orderstatus as feed_type,
      case when o_custkey % 7 <> 0 then 'active' end as member_status,
      o_orderpriority as plan_tier,
      (o_custkey % 8 * 10) || 's' as age_band,
      lpad(cast(o_custkey % 1000 as varchar), 3, '0') as postal_prefix,
      case when o_orderkey % 31 <> 0
        then cast(cast(floor(o_totalprice) as bigint) as varchar) || '.25' end as allowed_amount,
      'deliveries/' || delivery || '/' || location
        || case when o_orderkey % 13 = 0 then '.txt' else '.csv' end as _landing_key,
      'csv_delivery' as _standardize_strategy,
      'deliveries' as _source_preset_id,
      {_iso("order_day")} as _logical_date,
      case when o_orderkey % 17 = 0 then 'late'
        else {_iso("order_day + to_seconds(o_orderkey % 86400)")} end as _ingested_at,
      location as _source_system_id,
      delivery as _delivery_id,
      strftime(order_day, '%Y-%m-%d') as _delivery_date,
      'feed_' || o_orderstatus as _feed_type,
      '2500' as _response_row_count,
      bundle as _raw_bundle_id,
      'raw/' || bundle || '.parquet' as _raw_bundle_key,
      'raw/_' || bundle || '.parquet.manifest.json' as _raw_bundle_manifest_key,
      {_iso("month_start + interval 32 day + to_hours(case month(order_day) when 6 then 2 when 7 then 6 - run else run end)")}
        as _raw_standardized_at,
      {_iso("month_start")} as _raw_bundle_logical_date,
      'month' as _raw_bundle_granularity,
      cast(2 as bigint) as _raw_input_object_count,
      cast(2500 + month(order_day) as bigint) as _raw_bundle_row_count
    from (
      select *, location || '-' || strftime(order_day, '%Y') as delivery,
        strftime(order_day, '%Y-%m') || '-run' || run as bundle
      from (
        select *, date_trunc('day', o_orderdate)::timestamp as order_day,
          date_trunc('month', o_orderdate)::timestamp as month_start,
          'location_' || (o_custkey % 3 + 1) as location,
          case when o_orderkey % 10 = 0 then 1 else 2 end as run
        from orders
      )
    )
    """,
)

_cte(
    "raw_evt",
    f"""
    select
      'events' as workflow_name,
      'sensors' as source_preset_id,
      'v1' as source_schema_version,
      'events' as source_scenario_name,
      event_id as source_seed,
      case when event_id % 50 <> 0 then 'evt-' || (event_id // 3) end as emitter_event_id,
      {_iso("date_trunc('hour', ts)")} as emission_batch_started_at,
      {_iso("ts", fraction=True)} as emitted_at,
      cast(event_id % 3 as integer) as emission_index,
      'device-' || ((event_id // 3) % 97) as device_id,
      'site-' || ((event_id // 3) % 3) as site_id,
      case when event_type in ('view', 'click') then 'thermal' else 'combo_sensor' end
        as device_type,
      case when event_type <> 'signup' then floor(value * 8) / 8 end as temperature_c,
      case when event_type <> 'view' then 90 + (event_id % 160)::double / 8 end as pressure_kpa,
      case when event_type = 'error' then 'warning' else 'normal' end as device_status
    from events
    """,
)


# Bundles ----------------------------------------------------------------------------


def _bundle_ctes(prefix: str, raw: str, first_date: str | None) -> None:
    dates = [first_date] if first_date else []
    dates += [_day("_raw_bundle_logical_date"), _day("_raw_standardized_at")]
    _cte(
        f"{prefix}_candidates",
        f"""
        select distinct _raw_bundle_id as raw_bundle_id, _raw_bundle_key as raw_bundle_key,
          {_ts("_raw_standardized_at")} as raw_standardized_ts,
          {_ts("_raw_bundle_logical_date")} as bundle_logical_ts,
          _raw_bundle_granularity as bundle_granularity,
          coalesce(_raw_bundle_logical_date, _raw_bundle_id) as bundle_selector_key,
          _raw_input_object_count as raw_input_object_count,
          _raw_bundle_row_count as raw_bundle_row_count,
          coalesce({", ".join(dates)}) as bundle_event_date
        from {raw}
        """,
        raw,
    )
    _cte(
        f"{prefix}_rollup",
        f"""
        select raw_bundle_id, max(raw_standardized_ts) as raw_standardized_ts,
          max(bundle_logical_ts) as bundle_logical_ts,
          max(bundle_granularity) as bundle_granularity,
          max(bundle_selector_key) as bundle_selector_key,
          max(raw_input_object_count) as raw_input_object_count,
          cast(sum(raw_bundle_row_count) as bigint) as raw_bundle_row_count,
          count(*) as raw_bundle_file_count,
          max(bundle_event_date) as bundle_event_date
        from {prefix}_candidates group by raw_bundle_id
        """,
        f"{prefix}_candidates",
    )
    _cte(
        f"{prefix}_bundles",
        f"""
        select * from {prefix}_rollup
        qualify row_number() over (
          partition by bundle_granularity, bundle_selector_key
          order by raw_standardized_ts desc nulls last, raw_bundle_id desc nulls last) = 1
        """,
        f"{prefix}_rollup",
    )


_bundle_ctes("txn", "raw_txn", None)
_bundle_ctes("dlv", "raw_dlv", full_date("delivery_date"))

# Transactions -----------------------------------------------------------------------

_cte(
    "txn_typed",
    f"""
    select _landing_key || ':' || __row_index as transaction_id,
      __row_index as source_row_index,
      {_ts("_logical_date")} as event_ts,
      date_trunc('hour', {_ts("_logical_date")}) as event_hour,
      card_id, card_region, card_segment, merchant_id, merchant_category, merchant_region,
      merchant_risk_tier, amount, channel,
      coalesce(is_declined = 1, false) as is_declined,
      __is_anomaly as is_answer_key_anomaly,
      __labels as answer_key_labels_json,
      case when json_valid(__labels) and json_type(__labels) = 'ARRAY'
        then cast(json_array_length(__labels) as integer) else 0 end as answer_key_label_count,
      _landing_key as landing_key, _standardize_strategy as standardize_strategy,
      _source_preset_id as source_preset_id, {_ts("_ingested_at")} as ingested_ts,
      _schema_version as schema_version, _scenario_name as scenario_name,
      _response_row_count as response_row_count, _raw_bundle_id as raw_bundle_id,
      _raw_bundle_key as raw_bundle_key, _raw_bundle_manifest_key as raw_bundle_manifest_key,
      {_ts("_raw_standardized_at")} as raw_standardized_ts,
      _raw_bundle_granularity as raw_bundle_granularity,
      _raw_input_object_count as raw_input_object_count,
      _raw_bundle_row_count as raw_bundle_row_count,
      {_day("_logical_date")} as event_date
    from raw_txn
    """,
    "raw_txn",
)
_cte(
    "txn_canonical_rows",
    "select * from txn_typed where raw_bundle_id in (select raw_bundle_id from txn_bundles)",
    "txn_typed",
    "txn_bundles",
)
_cte(
    "txn_events",
    """
    select * from txn_canonical_rows
    qualify row_number() over (
      partition by transaction_id
      order by ingested_ts desc nulls last, event_ts desc nulls last,
        source_row_index desc nulls last, card_id desc nulls last,
        merchant_id desc nulls last, amount desc nulls last) = 1
    """,
    "txn_canonical_rows",
)
_cte(
    "txn_silver",
    """
    select * exclude (is_answer_key_anomaly, answer_key_labels_json, answer_key_label_count,
      raw_bundle_id, raw_bundle_key, raw_bundle_manifest_key, raw_standardized_ts,
      raw_bundle_granularity, raw_input_object_count, raw_bundle_row_count)
    from txn_events
    """,
    "txn_events",
)
_cte(
    "txn_silver_keys",
    """
    select transaction_id, event_ts, event_hour, is_answer_key_anomaly,
      answer_key_labels_json, answer_key_label_count, landing_key, event_date
    from txn_events where is_answer_key_anomaly or answer_key_label_count > 0
    """,
    "txn_events",
)
_cte(
    "txn_gold",
    """
    select * exclude (standardize_strategy),
      case when amount < 25 then 'micro' when amount < 100 then 'small'
        when amount < 250 then 'medium' else 'large' end as amount_band,
      coalesce(lower(merchant_risk_tier) in ('high', 'critical'), false)
        as is_high_risk_merchant,
      date_trunc('day', event_ts)::timestamp as event_day_ts
    from txn_silver
    """,
    "txn_silver",
)
_cte(
    "txn_gold_keys",
    "select *, answer_key_label_count > 0 as has_answer_key_labels from txn_silver_keys",
    "txn_silver_keys",
)
_cte(
    "txn_daily",
    """
    select channel, card_region, merchant_category, count(*) as transaction_count,
      sum(amount) as gross_amount, avg(amount) as average_amount,
      count(*) filter (is_declined) as declined_transaction_count,
      sum(case when is_declined then amount else 0 end) as declined_amount,
      count(*) filter (is_declined) / count(*)::double as decline_rate,
      event_date
    from txn_gold group by channel, card_region, merchant_category, event_date
    """,
    "txn_gold",
)
_cte(
    "txn_anomalies",
    """
    select channel, card_region, merchant_category,
      count(*) filter (k.is_answer_key_anomaly) as anomaly_transaction_count,
      sum(case when k.is_answer_key_anomaly then amount else 0 end) as anomalous_amount,
      count(*) filter (k.is_answer_key_anomaly) / count(*)::double as anomaly_rate,
      avg(amount) filter (k.is_answer_key_anomaly) as average_anomalous_amount,
      t.event_date
    from txn_gold t left join txn_gold_keys k using (transaction_id)
    group by channel, card_region, merchant_category, t.event_date
    """,
    "txn_gold",
    "txn_gold_keys",
)
_cte(
    "txn_outcomes",
    """
    select transaction_id, t.event_ts, t.event_hour, card_region, card_segment,
      merchant_category, merchant_region, merchant_risk_tier, amount, amount_band, channel,
      is_declined, coalesce(k.is_answer_key_anomaly, false) as is_answer_key_anomaly,
      coalesce(k.answer_key_label_count, 0) as answer_key_label_count,
      k.answer_key_labels_json, t.event_date
    from txn_gold t left join txn_gold_keys k using (transaction_id)
    """,
    "txn_gold",
    "txn_gold_keys",
)
_cte(
    "txn_evaluator",
    """
    select d.channel, d.card_region, d.merchant_category, d.transaction_count, d.gross_amount,
      d.average_amount, d.declined_transaction_count, d.decline_rate,
      coalesce(a.anomaly_transaction_count, 0) as anomaly_transaction_count,
      coalesce(a.anomalous_amount, 0.0::double) as anomalous_amount,
      coalesce(a.anomaly_rate, 0.0::double) as anomaly_rate,
      a.average_anomalous_amount, d.event_date
    from txn_daily d left join txn_anomalies a
      on d.event_date = a.event_date and d.channel = a.channel
      and d.card_region = a.card_region and d.merchant_category = a.merchant_category
    """,
    "txn_daily",
    "txn_anomalies",
)
# The mean of group means adds quotients, whose sum depends on the order of addition. It is
# cut to six digits at an offset that none of these quotients falls on.
_cte(
    "txn_summary",
    """
    select cast(sum(transaction_count) as bigint) as transaction_count,
      sum(gross_amount) as gross_amount,
      sum(average_amount::decimal(38,9))::double / count(average_amount)
        as average_transaction_amount,
      cast(sum(declined_transaction_count) as bigint) as declined_transaction_count,
      sum(declined_transaction_count)::double / sum(transaction_count)::double as decline_rate,
      cast(sum(anomaly_transaction_count) as bigint) as anomaly_transaction_count,
      sum(anomaly_transaction_count)::double / sum(transaction_count)::double as anomaly_rate,
      event_date
    from txn_evaluator group by event_date
    """,
    "txn_evaluator",
)

# Deliveries -------------------------------------------------------------------------

_cte(
    "dlv_typed",
    f"""
    select delivery_id || ':' || record_number as delivery_record_id,
      source_system_id, delivery_id, {full_date("delivery_date")} as delivery_date,
      cast(record_number as bigint) as record_number, cast(member_id as bigint) as member_id,
      facility_id, facility_region, facility_type, feed_type, member_status, plan_tier,
      age_band, postal_prefix, cast(allowed_amount as double) as allowed_amount,
      _landing_key as landing_key, _standardize_strategy as standardize_strategy,
      _source_preset_id as source_preset_id, {_ts("_logical_date")} as logical_ts,
      {_ts("_ingested_at")} as ingested_ts, _raw_bundle_id as raw_bundle_id,
      _raw_bundle_key as raw_bundle_key, _raw_bundle_manifest_key as raw_bundle_manifest_key,
      {_ts("_raw_standardized_at")} as raw_standardized_ts,
      _raw_bundle_granularity as raw_bundle_granularity,
      _raw_input_object_count as raw_input_object_count,
      _raw_bundle_row_count as raw_bundle_row_count,
      coalesce({full_date("delivery_date")}, {_day("_logical_date")},
        {_day("_raw_standardized_at")}) as event_date
    from raw_dlv
    """,
    "raw_dlv",
)
_cte(
    "dlv_records",
    """
    select * from dlv_typed where raw_bundle_id in (select raw_bundle_id from dlv_bundles)
    qualify row_number() over (
      partition by delivery_record_id
      order by ingested_ts desc nulls last, raw_standardized_ts desc nulls last,
        record_number desc nulls last, delivery_date desc nulls last,
        allowed_amount desc nulls last, logical_ts desc nulls last,
        feed_type desc nulls last) = 1
    """,
    "dlv_typed",
    "dlv_bundles",
)
_cte(
    "dlv_silver",
    """
    select delivery_record_id, source_system_id as location_code,
      case source_system_id when 'location_1' then 'Location 1'
        when 'location_2' then 'Location 2' else source_system_id end as location_label,
      delivery_id, delivery_date,
      nullif(regexp_extract(landing_key, '([^/]+[.]csv)$', 1), '') as source_file_name,
      record_number, member_id, facility_id, facility_region, facility_type, feed_type,
      member_status, plan_tier, age_band, postal_prefix, allowed_amount, raw_bundle_id,
      event_date
    from dlv_records
    """,
    "dlv_records",
)
_cte(
    "dlv_batches",
    """
    select location_code, location_label, source_file_name, delivery_id, feed_type,
      count(*) as record_count, sum(allowed_amount) as total_allowed_amount,
      avg(allowed_amount) as average_allowed_amount, delivery_date
    from dlv_silver
    group by location_code, location_label, source_file_name, delivery_id, feed_type,
      delivery_date
    """,
    "dlv_silver",
)
_cte(
    "dlv_daily",
    """
    select count(*) as record_count, count(distinct delivery_id) as delivery_count,
      count(distinct location_code) as location_count,
      sum(allowed_amount) as total_allowed_amount,
      avg(allowed_amount) as average_allowed_amount, event_date
    from dlv_silver group by event_date
    """,
    "dlv_silver",
)
_cte(
    "dlv_source_daily",
    """
    select location_code, location_label, count(*) as record_count,
      count(distinct delivery_id) as delivery_count,
      sum(allowed_amount) as total_allowed_amount,
      avg(allowed_amount) as average_allowed_amount, event_date
    from dlv_silver group by event_date, location_code, location_label
    """,
    "dlv_silver",
)

# Events -----------------------------------------------------------------------------

_cte(
    "evt_staged",
    f"""
    select workflow_name, source_preset_id, source_schema_version, source_scenario_name,
      source_seed, emitter_event_id,
      {_ts("emission_batch_started_at")} as emission_batch_started_at,
      {_ts("emitted_at")} as emitted_at, emission_index, device_id, site_id, device_type,
      temperature_c, pressure_kpa, device_status, {_day("emitted_at")} as event_date
    from raw_evt where emitter_event_id is not null
    """,
    "raw_evt",
)
_cte(
    "evt_events",
    """
    select * from evt_staged
    qualify row_number() over (
      partition by emitter_event_id
      order by emitted_at desc nulls last, emission_index desc nulls last) = 1
    """,
    "evt_staged",
)
_cte(
    "evt_published",
    """
    select workflow_name, source_preset_id, source_scenario_name, emitter_event_id,
      emitted_at, device_id, site_id, device_type, temperature_c, pressure_kpa,
      device_status, event_date
    from evt_events
    """,
    "evt_events",
)
_cte(
    "evt_devices",
    """
    select device_id, site_id, device_type, device_status, temperature_c, pressure_kpa,
      emitted_at, event_date
    from evt_events
    qualify row_number() over (
      partition by device_id
      order by emitted_at desc nulls last, emission_index desc nulls last) = 1
    """,
    "evt_events",
)
_cte(
    "evt_site_daily",
    """
    select site_id, device_type, count(*) as event_count,
      count(distinct device_id) as device_count, avg(temperature_c) as avg_temperature_c,
      avg(pressure_kpa) as avg_pressure_kpa,
      count(*) filter (device_status = 'warning') as warning_event_count,
      count(*) filter (pressure_kpa is null) as missing_pressure_event_count, event_date
    from evt_events group by site_id, device_type, event_date
    """,
    "evt_events",
)
_cte(
    "evt_health",
    """
    select count(*) as event_count, count(distinct device_id) as distinct_device_count,
      count(distinct site_id) as distinct_site_count,
      count(*) filter (device_status = 'warning') as warning_event_count,
      count(*) filter (pressure_kpa is null) as missing_pressure_event_count, event_date
    from evt_events group by event_date
    """,
    "evt_events",
)
