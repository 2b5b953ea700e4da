"""Schemas of the raw tables, landed payloads and manifests.

Fixed values: names, types and order must equal the data these jobs read. Columns that
start with ``_`` are lineage; ``_raw_bundle_*`` describe the standardized bundle a row
arrived in.
"""

TRANSACTION_ROW = """
    __row_index BIGINT, __is_anomaly BOOLEAN, __labels STRING,
    card_id STRING, card_region STRING, card_segment STRING,
    merchant_id STRING, merchant_category STRING, merchant_region STRING,
    merchant_risk_tier STRING, amount DOUBLE, channel STRING, is_declined BIGINT
"""

# Columns of TRANSACTION_ROW whose landed value may be a nested JSON array or object.
TRANSACTION_JSON_COLUMNS = ("__labels",)

DELIVERY_ROW = """
    source_system_id STRING, delivery_id STRING, delivery_date STRING, record_number STRING,
    member_id STRING, facility_id STRING, facility_region STRING, facility_type STRING,
    feed_type STRING, member_status STRING, plan_tier STRING, age_band STRING,
    postal_prefix STRING, allowed_amount STRING
"""


def names(flat_schema: str) -> tuple[str, ...]:
    """Column names of a schema without nested types."""
    return tuple(part.split()[0] for part in flat_schema.split(","))


DELIVERY_FIELDS = names(DELIVERY_ROW)

COMMON_LINEAGE = """
    _landing_key STRING, _standardize_strategy STRING, _source_preset_id STRING,
    _logical_date STRING, _ingested_at STRING
"""

BUNDLE_LINEAGE = """
    _raw_bundle_id STRING, _raw_bundle_key STRING, _raw_bundle_manifest_key STRING,
    _raw_standardized_at STRING, _raw_bundle_logical_date STRING,
    _raw_bundle_granularity STRING, _raw_input_object_count BIGINT,
    _raw_bundle_row_count BIGINT
"""

DATE_PARTITIONS = "year STRING, month STRING, day STRING"

RAW_TRANSACTIONS = (
    f"{TRANSACTION_ROW}, {COMMON_LINEAGE}, _schema_version STRING, _scenario_name STRING, "
    f"_response_row_count BIGINT, {BUNDLE_LINEAGE}"
)

RAW_DELIVERIES = (
    f"{DELIVERY_ROW}, {COMMON_LINEAGE}, _source_system_id STRING, _delivery_id STRING, "
    f"_delivery_date STRING, _feed_type STRING, _response_row_count STRING, {BUNDLE_LINEAGE}"
)

RAW_EVENTS = """
    workflow_name STRING, source_preset_id STRING, source_schema_version STRING,
    source_scenario_name STRING, source_seed BIGINT, emitter_event_id STRING,
    emission_batch_started_at STRING, emitted_at STRING, emission_index INT,
    device_id STRING, site_id STRING, device_type STRING, temperature_c DOUBLE,
    pressure_kpa DOUBLE, device_status STRING
"""

SLICE = "STRUCT<logical_date: STRING, slice_start: STRING, slice_end: STRING, granularity: STRING>"

LANDING_MANIFEST = f"""
    schema_version STRING, workflow_name STRING, source_adapter STRING, planning_mode STRING,
    ingested_at STRING,
    request STRUCT<kind: STRING, payload: STRING, slice: {SLICE}, slice_count: BIGINT,
        first_slice: {SLICE}, last_slice: {SLICE}, matched_slice: {SLICE}>,
    storage STRUCT<payload_key: STRING, manifest_key: STRING, object_name_override: STRING,
        resolved_storage_prefix: STRING, mode: STRING,
        slice_selector_mode: STRING, base_prefix: STRING, partition_fields: ARRAY<STRING>,
        path_suffix: ARRAY<STRING>,
        partition_components: ARRAY<STRUCT<key: STRING, value: STRING>>,
        logical_date: STRING, slice_start: STRING, slice_end: STRING,
        slice_granularity: STRING, run_id: STRING, object_stem: STRING>,
    payload STRUCT<content_type: STRING, metadata: MAP<STRING, STRING>,
        suggested_object_name: STRING>,
    adapter_config STRING
"""

BUNDLE_MANIFEST = """
    schema_version STRING, workflow_name STRING, standardize_strategy STRING,
    planning_mode STRING, standardized_at STRING,
    input STRUCT<mode: STRING, input_prefix: STRING, object_count: BIGINT,
        slice_selector_mode: STRING, landing_slice_granularity: STRING, logical_date: STRING,
        slice_start: STRING, slice_end: STRING, slice_granularity: STRING, run_id: STRING>,
    output STRUCT<mode: STRING, payload_key: STRING, manifest_key: STRING,
        output_prefix: STRING, base_prefix: STRING, partition_fields: ARRAY<STRING>,
        path_suffix: ARRAY<STRING>, row_count: BIGINT, metadata: MAP<STRING, STRING>,
        content_type: STRING>
"""

# One row per (bundle, landed object). Kept apart from the manifest itself: a bundle can
# have any number of inputs and an array of them would have to fit one row.
BUNDLE_INPUTS = "run_id STRING, slice_start TIMESTAMP, landing_key STRING"
