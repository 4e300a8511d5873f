"""Maps a warehouse of generic tables onto the raw sources the collectors read.

Each function is a projection (at most one dimension join) of the given tables, so
filters and column selections of the caller reach the Parquet scan.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.exprs import money

# Reference times of the mapped tables.
COST_AS_OF = datetime(2001, 6, 30)
ORDERS_AS_OF = datetime(2001, 8, 2)
QUALITY_AS_OF = datetime(2001, 8, 1)
EVENTS_AS_OF = datetime(2024, 1, 30, 12)

NODES = 150


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _s(text: str, number: Column) -> Column:
    return F.concat(F.lit(text), number.cast("string"))


def _plus_seconds(ts: str, seconds: Column) -> Column:
    zero = F.lit(0)
    return F.col(ts) + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def _customer_email() -> Column:
    local = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    full = F.concat(local, F.lit("@"), F.lower("c_mktsegment"), F.lit(".com"))
    key = F.col("c_custkey")
    return F.when(key % 17 == 0, F.lit(None)).when(key % 23 == 0, local).otherwise(full)


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    group = F.col("c_nationkey") % 5
    status = (
        F.when(group == 0, "inactive")
        .when(group == 1, "suspended")
        .when((group == 2) & (key % 3 == 0), "deleted")
        .when((group == 3) & (key % 7 == 0), F.lit(None))
        .otherwise("active")
    )
    return table(spark, sf_dir, "customer").select(
        key.alias("customer_id"),
        _customer_email().alias("email"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int"))
        .cast("string")
        .alias("created_date"),
        status.alias("status"),
        (F.lit(10) + key % 120).alias("age"),
        F.when(key % 3 == 0, _s("555-", key)).otherwise(_s("555-010-", key)).alias("phone_number"),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    shipped = F.date_add(day, (key % 9 - 1).cast("int"))
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .when(key % 2 == 0, "cancelled")
        .otherwise("lost")
    )
    amount = money("o_totalprice") * F.lit(Decimal("0.0004")) - F.lit(Decimal("2"))
    return table(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day.cast("string").alias("order_date"),
        amount.cast("decimal(18,6)").alias("order_amount"),
        status.alias("order_status"),
        F.when(key % 11 != 0, shipped.cast("string")).alias("shipped_date"),
    )


def billing_usage(spark: SparkSession, sf_dir: str, product: bool = True) -> DataFrame:
    """Usage records; without ``product`` the dimension join is left out."""
    line = F.col("l_linenumber") % 3
    usage = table(spark, sf_dir, "lineitem")
    if product:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        usage = usage.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    else:
        usage = usage.withColumn("p_type", F.lit(None).cast("string"))
    return usage.select(
        F.to_date("l_shipdate").alias("usage_date"),
        F.lit("w0").alias("workspace_id"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("sku_name"),
        F.when(line == 0, "AWS").when(line == 1, "AZURE").otherwise("GCP").alias("cloud"),
        F.lit("DBU").alias("usage_unit"),
        money("l_extendedprice").alias("usage_quantity"),
        money(1 - F.col("l_discount")).alias("list_price"),
        F.col("p_type").alias("billing_origin_product"),
        F.create_map(F.lit("order"), F.col("l_orderkey").cast("string")).alias("usage_metadata"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", _k())


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = F.col("user_id") % 25
    state = (
        F.when(F.col("event_type") == "error", "FAILED")
        .when((F.col("event_type") == "signup") & (F.col("k") < 50), "TIMEDOUT")
        .when(F.col("event_type") == "signup", "CANCELED")
        .otherwise("SUCCESS")
    )
    failed = F.col("event_type").isin("error", "signup")
    return _events(spark, sf_dir).select(
        job.alias("job_id"),
        _s("job_", job).alias("job_name"),
        F.col("event_id").alias("run_id"),
        _s("run_", F.col("event_id")).alias("run_name"),
        F.lit("w0").alias("workspace_id"),
        F.col("ts").alias("start_time"),
        F.when(F.col("k") != 0, _plus_seconds("ts", F.floor(F.col("value") * 10))).alias(
            "end_time"
        ),
        state.alias("result_state"),
        F.lit("NOTEBOOK").alias("task_type"),
        _s("cluster_", F.col("user_id") % 8).alias("cluster_id"),
        F.when(failed, _s("ERR_", F.col("k") % 7)).alias("error_message"),
    )


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = (money("value") * 1000).cast("bigint")
    failed = F.col("event_type").isin("error", "signup")
    return _events(spark, sf_dir).select(
        _s("q_", F.col("event_id")).alias("query_id"),
        F.lit("w0").alias("workspace_id"),
        F.concat(
            F.lit("SELECT * FROM "), F.col("event_type"), F.lit(" WHERE p = "), F.col("props")
        ).alias("query_text"),
        F.col("ts").alias("query_start_time"),
        _plus_seconds("ts", money("value")).alias("query_end_time"),
        millis.alias("duration_ms"),
        (F.col("user_id") * 100).alias("rows_produced"),
        (F.col("k").cast("bigint") * 1048576).alias("bytes_scanned"),
        _s("user_", F.col("user_id")).alias("executed_as_user_name"),
        _s("user_", F.col("user_id")).alias("executed_by_user_name"),
        _s("wh_", F.col("user_id") % 3).alias("warehouse_id"),
        F.when(failed, _s("ERR_", F.col("k") % 7)).alias("error_message"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = (
        F.when(F.col("user_id") % 3 == 0, "m5.xlarge")
        .when(F.col("user_id") % 3 == 1, "m5.large")
        .otherwise("m5.small")
    )
    state = (
        F.when(F.col("event_type").isin("view", "click"), "RUNNING")
        .when(F.col("event_type") == "purchase", "RESIZING")
        .otherwise("TERMINATED")
    )
    cluster = F.col("user_id") % 8
    return _events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"),
        F.lit("w0").alias("workspace_id"),
        _s("cluster_", cluster).alias("cluster_id"),
        _s("pool_", cluster).alias("cluster_name"),
        F.lit("JOB").alias("cluster_source"),
        node.alias("driver_node_type_id"),
        node.alias("node_type_id"),
        F.struct(F.lit(0).alias("min_workers"), F.lit(8).alias("max_workers")).alias("autoscale"),
        (F.col("k") % 9).alias("num_workers"),
        state.alias("state"),
        F.floor(F.col("value") * 10).cast("bigint").alias("uptime_in_seconds"),
    )


def event_details() -> Column:
    """JSON payload: a state for update events, expectation counts for flow events."""
    k = F.col("k")
    state = (
        F.when(k % 10 < 7, "COMPLETED")
        .when(k % 10 == 7, "FAILED")
        .when(k % 10 == 8, "CANCELED")
        .otherwise("RUNNING")
    )
    flow = _s("ds_", k % 5)

    def check(name: str, constraint: str, action: str, passed: Column, failed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            flow.alias("dataset"),
            F.lit(constraint).alias("constraint"),
            F.lit(action).alias("action"),
            passed.cast("bigint").alias("passed_records"),
            failed.cast("bigint").alias("failed_records"),
        )

    checks = F.array(
        check(
            "exp_a",
            "a > 0",
            "warn",
            F.floor(F.col("value") * 10),
            F.when(k % 4 == 0, k).otherwise(0),
        ),
        check("exp_b", "b > 0", "drop", k * 10, F.when(k % 10 == 0, 5).otherwise(0)),
    )
    update = F.to_json(F.struct(state.alias("state")))
    progress = F.to_json(
        F.struct(
            F.lit("RUNNING").alias("state"),
            flow.alias("flow_name"),
            F.struct(checks.alias("expectations")).alias("data_quality"),
        )
    )
    return F.when(F.col("event_type").isin("click", "signup"), update).when(
        k % 50 != 49, progress
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = F.col("user_id") % 6
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "purchase", "WARN")
        .otherwise("INFO")
    )
    origin = F.struct(
        _s("p", flow).alias("pipeline_id"),
        _s("flow_", flow).alias("pipeline_name"),
        F.concat(_s("p", flow), F.lit("-"), F.to_date("ts").cast("string")).alias("update_id"),
    )
    return _events(spark, sf_dir).select(
        _s("e", F.col("event_id")).alias("id"),
        origin.alias("origin"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type").isin("click", "signup"), "update_progress")
        .otherwise("flow_progress")
        .alias("event_type"),
        level.alias("level"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("message"),
        event_details().alias("details"),
        F.when(F.col("event_type") == "error", _s("ERR_", F.col("k") % 7)).alias("error"),
    )


def _full_name(node: Column) -> Column:
    return F.concat(_s("cat_", node % 3), _s(".sch_", node % 5), _s(".t_", node))


def _lineage_ends() -> tuple[Column, Column]:
    """Every event is a read of one table for another: a table per user, three outgoing edges
    each, within neighbourhoods of NODES tables. Tables and edges grow with the users. The
    first ten tables of a neighbourhood are only read, its last ten are only written."""
    inside = F.col("user_id") % NODES
    block = F.col("user_id") - inside
    inside = F.when(inside >= NODES - 10, inside - 10).otherwise(inside)
    target = (inside * 7 + F.col("k") % 3 * 31 + 1) % (NODES - 10) + 10
    return block + inside, block + target


def table_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = _lineage_ends()
    parts = {}
    for side, node in (("source", src), ("target", dst)):
        parts[f"{side}_table_full_name"] = _full_name(node)
        parts[f"{side}_table_catalog"] = _s("cat_", node % 3)
        parts[f"{side}_table_schema"] = _s("sch_", node % 5)
        parts[f"{side}_table_name"] = _s("t_", node)
    return (
        _events(spark, sf_dir)
        .select(
            *[col.alias(name) for name, col in parts.items()],
            F.upper("event_type").alias("source_type"),
            F.col("ts").alias("event_time"),
            F.col("event_id").cast("string").alias("entity_id"),
            _s("nb_", F.col("user_id") % 10).alias("notebook_id"),
            _s("job_", F.col("user_id") % 25).alias("job_id"),
            _s("run_", F.col("event_id")).alias("run_id"),
        )
    )


def column_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = _lineage_ends()
    return (
        _events(spark, sf_dir)
        .select(
            _full_name(src).alias("source_table_full_name"),
            _s("c_", F.col("event_id") % 3).alias("source_column_name"),
            _full_name(dst).alias("target_table_full_name"),
            _s("c_", (F.col("event_id") + F.col("k")) % 3).alias("target_column_name"),
            F.col("ts").alias("event_time"),
            F.upper("event_type").alias("source_type"),
            F.col("event_id").cast("string").alias("entity_id"),
        )
    )


def rules_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per part, so that registry work grows with the warehouse."""
    key = F.col("p_partkey")
    hours = (key % 200).cast("int")
    created = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hours
    )

    def pick(names: tuple[str, ...], by: Column) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in names]), (by % len(names) + 1).cast("int"))

    dataset = F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))
    name = _s("rule_", key)
    kind = pick(("not_null", "valid_values", "range", "regex", "custom"), key)
    return table(spark, sf_dir, "part").select(
        F.sha2(F.concat_ws("|", dataset, name), 256).alias("rule_id"),
        F.when(key % 4 != 0, _s("flow_", key % 3)).alias("pipeline_name"),
        dataset.alias("dataset_name"),
        name.alias("expectation_name"),
        kind.alias("expectation_type"),
        _s("p_size >= ", F.col("p_size")).alias("constraint_expression"),
        pick(("warn", "drop", "fail"), key).alias("action"),
        F.concat(kind, F.lit(" validation for "), dataset).alias("description"),
        pick(("critical", "high", "medium", "low"), F.col("p_size")).alias("severity"),
        (key % 5 != 0).alias("is_enabled"),
        F.lit("seed").alias("created_by"),
        created.alias("created_at"),
        (created + F.make_dt_interval((key % 13).cast("int"))).alias("updated_at"),
        F.create_map(F.lit("p_type"), F.col("p_type")).alias("tags"),
        F.lit(None).cast(schemas.RULE_ARGUMENTS).alias("arguments"),
    )


def classification_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return docs.join(labels, "doc_id", "left").select(
        day.cast("timestamp_ntz").alias("ts"),
        F.col("lang").alias("model_id"),
        (F.col("n_chars") >= 500).cast("int").alias("prediction"),
        F.col("quality").cast("int").alias("label"),
    )


def regression_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_shipdate").alias("ts"),
            F.col("p_brand").alias("model_id"),
            (money("l_quantity") * money("p_retailprice")).cast("decimal(18,2)").alias(
                "prediction"
            ),
            money("l_extendedprice").alias("label"),
        )
    )


def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raised alerts over time: every failed run is an alert of its job family."""
    critical = F.col("event_type") == "error"
    return (
        _events(spark, sf_dir)
        .filter(F.col("event_type").isin("error", "signup"))
        .select(
            _s("a", F.col("event_id")).alias("alert_id"),
            _s("job_failure_", F.col("user_id") % 4).alias("alert_type"),
            F.when(critical, "critical").otherwise("warning").alias("severity"),
            F.concat(_s("job_", F.col("user_id") % 25), _s(" failed with ERR_", F.col("k") % 7))
            .alias("message"),
            F.create_map(
                F.lit("pipeline_name"), _s("flow_", F.col("user_id") % 6),
                F.lit("dataset_name"), _s("ds_", F.col("k") % 5),
            ).alias("details"),
            F.col("ts").alias("triggered_at"),
            F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
            F.lit("active").alias("status"),
            F.array().cast("array<string>").alias("notified_channels"),
        )
    )
