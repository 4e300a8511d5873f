"""One explicit schema per stored table, in stored column order."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType


def _table(**columns: str | DataType) -> StructType:
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


TEXT_MAP = MapType(StringType(), StringType())
TEXT_LIST = ArrayType(StringType())
ORIGIN = _table(pipeline_id="string", pipeline_name="string", update_id="string")
AUTOSCALE = _table(min_workers="integer", max_workers="integer")
RESULT = _table(
    name="string",
    dataset="string",
    constraint="string",
    action="string",
    passed_records="long",
    failed_records="long",
)
RESULTS = _table(expectations=ArrayType(RESULT))

# Raw sources read by the collectors.
BILLING_USAGE = _table(
    usage_date="date",
    workspace_id="string",
    sku_name="string",
    cloud="string",
    usage_unit="string",
    usage_quantity="decimal(18,2)",
    list_price="decimal(18,2)",
    billing_origin_product="string",
    usage_metadata=TEXT_MAP,
)
JOB_RUNS = _table(
    job_id="long",
    job_name="string",
    run_id="long",
    run_name="string",
    workspace_id="string",
    start_time="timestamp_ntz",
    end_time="timestamp_ntz",
    result_state="string",
    task_type="string",
    cluster_id="string",
    error_message="string",
)
CLUSTERS = _table(
    timestamp="timestamp_ntz",
    workspace_id="string",
    cluster_id="string",
    cluster_name="string",
    cluster_source="string",
    driver_node_type_id="string",
    node_type_id="string",
    autoscale=AUTOSCALE,
    num_workers="integer",
    state="string",
    uptime_in_seconds="long",
)
QUERY_HISTORY = _table(
    query_id="string",
    workspace_id="string",
    query_text="string",
    query_start_time="timestamp_ntz",
    query_end_time="timestamp_ntz",
    duration_ms="long",
    rows_produced="long",
    bytes_scanned="long",
    executed_as_user_name="string",
    executed_by_user_name="string",
    warehouse_id="string",
    error_message="string",
)
EVENT_LOG = _table(
    id="string",
    origin=ORIGIN,
    timestamp="timestamp_ntz",
    event_type="string",
    level="string",
    message="string",
    details="string",
    error="string",
)
EVENT_DETAILS = _table(
    state="string",
    flow_name="string",
    data_quality=RESULTS,
)
TABLE_LINEAGE = _table(
    source_table_full_name="string",
    source_table_catalog="string",
    source_table_schema="string",
    source_table_name="string",
    target_table_full_name="string",
    target_table_catalog="string",
    target_table_schema="string",
    target_table_name="string",
    source_type="string",
    event_time="timestamp_ntz",
    entity_id="string",
    notebook_id="string",
    job_id="string",
    run_id="string",
)
COLUMN_LINEAGE = _table(
    source_table_full_name="string",
    source_column_name="string",
    target_table_full_name="string",
    target_column_name="string",
    event_time="timestamp_ntz",
    source_type="string",
    entity_id="string",
)

# Stored tables.
# What a rule's constraint text cannot say safely: the columns it is about, the referenced
# table and key, the greatest age in days.
RULE_ARGUMENTS = _table(
    columns=TEXT_LIST, reference_table="string", reference_key="string", max_age_days="integer"
)
RULES = _table(
    rule_id="string",
    pipeline_name="string",
    dataset_name="string",
    expectation_name="string",
    expectation_type="string",
    constraint_expression="string",
    action="string",
    description="string",
    severity="string",
    is_enabled="boolean",
    created_by="string",
    created_at="timestamp_ntz",
    updated_at="timestamp_ntz",
    tags=TEXT_MAP,
    arguments=RULE_ARGUMENTS,
)
COST_METRICS = _table(
    usage_date="date",
    workspace_id="string",
    sku_name="string",
    cloud="string",
    usage_unit="string",
    usage_quantity="decimal(18,2)",
    list_price="decimal(18,2)",
    cost="decimal(18,4)",
    billing_origin_product="string",
    usage_metadata=TEXT_MAP,
    ingestion_timestamp="timestamp_ntz",
)
JOB_METRICS = _table(
    job_id="long",
    job_name="string",
    run_id="long",
    run_name="string",
    workspace_id="string",
    start_time="timestamp_ntz",
    end_time="timestamp_ntz",
    duration_seconds="long",
    result_state="string",
    task_type="string",
    cluster_id="string",
    total_dbu_usage="decimal(18,6)",
    total_cost="decimal(18,6)",
    error_message="string",
    ingestion_timestamp="timestamp_ntz",
)
CLUSTER_METRICS = _table(
    timestamp="timestamp_ntz",
    workspace_id="string",
    cluster_id="string",
    cluster_name="string",
    cluster_source="string",
    driver_node_type="string",
    worker_node_type="string",
    autoscale_min_workers="integer",
    autoscale_max_workers="integer",
    num_workers="integer",
    state="string",
    uptime_seconds="long",
    dbu_rate="decimal(10,1)",
    ingestion_timestamp="timestamp_ntz",
)
QUERY_METRICS = _table(
    query_id="string",
    workspace_id="string",
    query_text="string",
    query_start_time="timestamp_ntz",
    query_end_time="timestamp_ntz",
    duration_ms="long",
    rows_produced="long",
    bytes_scanned="long",
    executed_as_user_name="string",
    executed_by_user_name="string",
    warehouse_id="string",
    error_message="string",
    ingestion_timestamp="timestamp_ntz",
)
EVENTS = _table(
    event_id="string",
    pipeline_id="string",
    pipeline_name="string",
    update_id="string",
    timestamp="timestamp_ntz",
    event_type="string",
    level="string",
    message="string",
    details="string",
    error="string",
    origin=ORIGIN,
    ingestion_timestamp="timestamp_ntz",
)
QUALITY_METRICS = _table(
    pipeline_id="string",
    pipeline_name="string",
    update_id="string",
    timestamp="timestamp_ntz",
    dataset_name="string",
    expectation_name="string",
    expectation_query="string",
    expectation_action="string",
    passed_records="long",
    failed_records="long",
    pass_rate="double",
    ingestion_timestamp="timestamp_ntz",
)
UPDATE_HEALTH = _table(
    pipeline_id="string",
    pipeline_name="string",
    update_id="string",
    start_time="timestamp_ntz",
    end_time="timestamp_ntz",
    duration_seconds="long",
    status="string",
    num_datasets="long",
    total_records_processed="long",
    total_expectations_checked="long",
    total_expectations_failed="long",
    overall_quality_score="double",
    error_count="long",
    warning_count="long",
    ingestion_timestamp="timestamp_ntz",
)
LINEAGE = _table(
    source_table_full_name="string",
    source_table_catalog="string",
    source_table_schema="string",
    source_table_name="string",
    target_table_full_name="string",
    target_table_catalog="string",
    target_table_schema="string",
    target_table_name="string",
    source_type="string",
    event_time="timestamp_ntz",
    entity_id="string",
    notebook_id="string",
    job_id="string",
    run_id="string",
    ingestion_timestamp="timestamp_ntz",
)
LINEAGE_GRAPH = _table(
    node_id="string",
    node_type="string",
    node_name="string",
    upstream_nodes=TEXT_LIST,
    downstream_nodes=TEXT_LIST,
    depth_level="integer",
    last_updated="timestamp_ntz",
)
ALERTS = _table(
    alert_type="string",
    severity="string",
    message="string",
    details=TEXT_MAP,
    triggered_at="timestamp_ntz",
)
ALERT_HISTORY = _table(
    alert_id="string",
    alert_type="string",
    severity="string",
    message="string",
    details=TEXT_MAP,
    triggered_at="timestamp_ntz",
    resolved_at="timestamp_ntz",
    status="string",
    notified_channels=TEXT_LIST,
)
PROFILE = _table(
    column_name="string",
    row_count="long",
    null_count="long",
    null_percentage="double",
    num_distinct="long",
    min="double",
    max="double",
    min_text="string",
    max_text="string",
    avg="double",
    stddev="double",
)
DRIFT = _table(
    column_name="string",
    drift_type="string",
    drift_score="double",
    threshold="double",
)

# Day each stored table is partitioned by: (derived column, source expression).
PARTITION_DAY = {
    "cost_metrics": ("usage_date", "usage_date"),
    "job_metrics": ("start_date", "to_date(start_time)"),
    "cluster_metrics": ("metric_date", "to_date(timestamp)"),
    "query_metrics": ("query_date", "to_date(query_start_time)"),
    "event_logs": ("event_date", "to_date(timestamp)"),
    "quality_metrics": ("metric_date", "to_date(timestamp)"),
    "update_health": ("start_date", "to_date(start_time)"),
    "lineage_metadata": ("event_date", "to_date(event_time)"),
    "alert_history": ("triggered_date", "to_date(triggered_at)"),
}
