"""Stored tables as the collectors would have written them up to the reference time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.exprs import ts_lit
from vigil.operators import event_log
from vigil.operators.expectations import Expectation, counts
from vigil.sources import collectors, testbed
from vigil.sources.testbed import COST_AS_OF, EVENTS_AS_OF, QUALITY_AS_OF

# Lookback that covers the whole history.
ALL_DAYS = 36_500

ORDER_QUALITY = (
    Expectation("min_price", "o_totalprice >= 5000", "drop"),
    Expectation("known_status", "o_orderstatus IN ('O', 'F')"),
    Expectation(
        "customer_in_credit",
        "o_custkey IN (SELECT c_custkey FROM customers_in_credit)",
        "drop",
        fk=("o_custkey", "customers_in_credit", "c_custkey"),
    ),
)
LINE_QUALITY = (
    Expectation("small_discount", "l_discount <= 0.08"),
    Expectation("min_quantity", "l_quantity >= 3", "drop"),
)

# Day distance between the era of the sales tables and that of the events.
ERA_SHIFT = (EVENTS_AS_OF.date() - COST_AS_OF.date()).days
QUALITY_SHIFT = (EVENTS_AS_OF.date() - QUALITY_AS_OF.date()).days


def cost(
    spark: SparkSession, d: str, days: int = ALL_DAYS, product: bool = False
) -> DataFrame:
    """Cost metrics; only reports by product pay for the join with the product table."""
    return collectors.cost_metrics(testbed.billing_usage(spark, d, product), COST_AS_OF, days)


def jobs(spark: SparkSession, d: str, days: int = ALL_DAYS) -> DataFrame:
    return collectors.job_metrics(testbed.job_runs(spark, d), EVENTS_AS_OF, days)


def clusters(spark: SparkSession, d: str, days: int = ALL_DAYS) -> DataFrame:
    return collectors.cluster_metrics(testbed.clusters(spark, d), EVENTS_AS_OF, days)


def queries(spark: SparkSession, d: str, days: int = ALL_DAYS) -> DataFrame:
    return collectors.query_metrics(testbed.query_history(spark, d), EVENTS_AS_OF, days)


def events(spark: SparkSession, d: str, days: int = ALL_DAYS) -> DataFrame:
    return collectors.event_logs(testbed.event_log(spark, d), EVENTS_AS_OF, days)


def health(spark: SparkSession, d: str) -> DataFrame:
    return event_log.update_health(events(spark, d), EVENTS_AS_OF)


def lineage(spark: SparkSession, d: str) -> DataFrame:
    return testbed.table_lineage(spark, d)


def customers_in_credit(spark: SparkSession, d: str) -> DataFrame:
    return testbed.table(spark, d, "customer").filter("c_acctbal >= 0").select("c_custkey")


def quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality metrics: rule outcomes per day of the sales tables."""
    orders = testbed.table(spark, d, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    lines = testbed.table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_shipdate")
    at = ts_lit(QUALITY_AS_OF)
    per_day = [
        ("orders_flow", "orders", counts(
            orders.filter(F.col("o_orderdate") <= at),
            ORDER_QUALITY,
            {"customers_in_credit": customers_in_credit(spark, d)},
            by={"timestamp": F.col("o_orderdate")},
        )),
        ("sales_flow", "lineitem", counts(
            lines.filter(F.col("l_shipdate") <= at),
            LINE_QUALITY,
            by={"timestamp": F.col("l_shipdate")},
        )),
    ]
    parts = [
        df.select(
            F.lit(flow).alias("pipeline_id"),
            F.lit(flow).alias("pipeline_name"),
            F.concat_ws("-", F.lit(flow), F.to_date("timestamp").cast("string")).alias("update_id"),
            "timestamp",
            F.lit(dataset).alias("dataset_name"),
            "expectation_name",
            "expectation_query",
            "expectation_action",
            "passed_records",
            "failed_records",
            "pass_rate",
            at.alias("ingestion_timestamp"),
        )
        for flow, dataset, df in per_day
    ]
    return parts[0].unionByName(parts[1])


def shifted_cost(spark: SparkSession, d: str) -> DataFrame:
    """Cost moved into the era of the events, for reports over both."""
    return cost(spark, d).withColumn("usage_date", F.date_add("usage_date", ERA_SHIFT))


def shifted_quality(spark: SparkSession, d: str) -> DataFrame:
    days = F.make_dt_interval(F.lit(QUALITY_SHIFT))
    return quality(spark, d).withColumn("timestamp", F.col("timestamp") + days)


EVENTS_DAY_BEFORE = EVENTS_AS_OF.date() - timedelta(days=1)
