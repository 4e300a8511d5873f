"""Bronze -> silver -> gold example: customers and orders with their rules."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.exprs import day_lit, as_day, email_domain, mean, percent, ts_lit
from vigil.plans.lists import Listed, listed
from vigil.operators.expectations import Checked, Expectation, check

# Patterns, value lists and limits of the sample rules.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$"
CUSTOMER_STATUSES = "'active', 'inactive', 'suspended'"
ORDER_STATUSES = "'pending', 'completed', 'cancelled', 'refunded'"
SEGMENTS = ((1000, "VIP"), (500, "High Value"), (100, "Regular"))
SEGMENT_OTHER = "Low Value"

BRONZE_CUSTOMER_RULES = (Expectation("valid_record", "customer_id IS NOT NULL"),)
BRONZE_ORDER_RULES = (Expectation("valid_order", "order_id IS NOT NULL"),)
CUSTOMER_RULES = (
    Expectation("customer_id_not_null", "customer_id IS NOT NULL", "fail"),
    Expectation("email_not_null", "email IS NOT NULL", "drop"),
    Expectation("valid_email_format", f"email RLIKE '{EMAIL_PATTERN}'", "drop"),
    Expectation("valid_status", f"status IN ({CUSTOMER_STATUSES})", "drop"),
    Expectation("valid_age_range", "age BETWEEN 18 AND 120", "drop"),
    Expectation("valid_phone_length", "LENGTH(phone_number) >= 10", "warn"),
)
ORDER_RULES = (
    Expectation("order_id_not_null", "order_id IS NOT NULL", "fail"),
    Expectation("customer_id_not_null", "customer_id IS NOT NULL", "fail"),
    Expectation("valid_order_amount", "order_amount > 0", "drop"),
    Expectation("valid_order_status", f"order_status IN ({ORDER_STATUSES})", "drop"),
    Expectation(
        "shipped_date_after_order", "shipped_date IS NULL OR shipped_date >= order_date", "warn"
    ),
    Expectation(
        "customer_exists",
        "customer_id IN (SELECT customer_id FROM silver_customers)",
        "drop",
        fk=("customer_id", "silver_customers", "customer_id"),
    ),
)
METRIC_RULES = (
    Expectation("has_orders", "total_orders > 0"),
    Expectation("positive_revenue", "total_revenue > 0"),
)
REVENUE_RULES = (
    Expectation("valid_date", "order_date IS NOT NULL"),
    Expectation("positive_revenue", "daily_revenue > 0"),
)


def checked_customers(bronze: DataFrame) -> Checked:
    """Cleaned customers with their rules attached."""
    cleaned = bronze.withColumns(
        {
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "created_date": F.try_to_date("created_date"),
            "email_domain": email_domain(),
        }
    )
    return check(cleaned, CUSTOMER_RULES)


def silver_customers(bronze: DataFrame) -> DataFrame:
    return checked_customers(bronze).valid


def quarantined_customers(bronze: DataFrame, as_of: datetime) -> DataFrame:
    return checked_customers(bronze).quarantine.withColumns(
        {
            "quarantine_reason": F.concat_ws(", ", "quarantine_reasons"),
            "quarantine_timestamp": ts_lit(as_of),
        }
    )


def checked_orders(bronze: DataFrame, customers: DataFrame) -> Checked:
    cleaned = bronze.withColumns(
        {
            "order_date": F.try_to_date("order_date"),
            "shipped_date": F.try_to_date("shipped_date"),
        }
    ).withColumn("days_to_ship", F.datediff("shipped_date", "order_date"))
    return check(cleaned, ORDER_RULES, {"silver_customers": customers})


def silver_orders(bronze: DataFrame, customers: DataFrame) -> DataFrame:
    return checked_orders(bronze, customers).valid


def segment(revenue: str = "total_revenue"):
    label = F.lit(SEGMENT_OTHER)
    for least, name in reversed(SEGMENTS):
        label = F.when(F.col(revenue) >= least, name).otherwise(label)
    return label


def customer_metrics(orders: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """Totals, recency and segment per customer with orders."""
    today = day_lit(as_day(as_of))
    # Aggregated first: the join sees one row per customer on both sides.
    totals = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("order_amount").alias("total_revenue"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.countDistinct(F.year("order_date")).alias("active_years"),
    )
    profile = customers.select(
        "customer_id", "email", "full_name", "status", "created_date", "email_domain"
    )
    return totals.join(profile, "customer_id").withColumns(
        {
            "avg_order_value": mean(F.col("total_revenue"), F.col("total_orders")),
            "days_since_first_order": F.datediff(today, "first_order_date"),
            "days_since_last_order": F.datediff(today, "last_order_date"),
            "customer_segment": segment(),
        }
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("order_status") == "completed")
        .groupBy("order_date")
        .agg(
            F.sum("order_amount").alias("daily_revenue"),
            F.count("order_id").alias("order_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .withColumn("avg_order_value", mean(F.col("daily_revenue"), F.col("order_count")))
        .orderBy("order_date")
    )


def status_summary(customers: DataFrame) -> Listed:
    """Per status: customers, mean age and share; and its e-mail domains, one row each."""
    pairs = customers.groupBy("status", "email_domain").agg(
        F.count("customer_id").alias("_n"),
        F.sum("age").alias("_age"),
        F.count("age").alias("_ages"),
    )
    totals = {
        "customer_count": F.sum("_n"),
        "avg_age": mean(F.sum("_age"), F.sum("_ages")),
        "email_domains": F.count("email_domain"),
    }
    found = listed(pairs, ["status"], "email_domain", "email_domain", totals)
    # One row per status.
    whole = F.sum("customer_count").over(Window.partitionBy())
    share = percent(F.col("customer_count"), whole)
    return found._replace(totals=found.totals.withColumn("percentage", share))


@dataclass(frozen=True)
class Layers:
    """All datasets of the example, lazily composed."""

    customers: Checked
    orders: Checked
    metrics: DataFrame
    revenue: DataFrame


def build(bronze_customers: DataFrame, bronze_orders: DataFrame, as_of: datetime) -> Layers:
    customers = checked_customers(bronze_customers)
    kept = customers.valid
    orders = checked_orders(bronze_orders, kept)
    kept_orders = orders.valid
    return Layers(
        customers,
        orders,
        customer_metrics(kept_orders, kept, as_of),
        daily_revenue(kept_orders),
    )


def quality_summary(
    bronze_customers: DataFrame, bronze_orders: DataFrame, as_of: datetime
) -> DataFrame:
    """Real passed and failed checks per dataset, from evaluating its rules."""
    layers = build(bronze_customers, bronze_orders, as_of)
    sets = (
        ("bronze_customers", "bronze", check(bronze_customers, BRONZE_CUSTOMER_RULES)),
        ("bronze_orders", "bronze", check(bronze_orders, BRONZE_ORDER_RULES)),
        ("silver_customers", "silver", layers.customers),
        ("silver_orders", "silver", layers.orders),
        ("gold_customer_metrics", "gold", check(layers.metrics, METRIC_RULES)),
        ("gold_daily_revenue", "gold", check(layers.revenue, REVENUE_RULES)),
    )
    parts = [
        checked.counts()
        .agg(
            F.sum("passed_records").alias("records_passed"),
            F.sum("failed_records").alias("records_failed"),
        )
        .select(F.lit(name).alias("table_name"), F.lit(layer).alias("layer"), "*")
        for name, layer, checked in sets
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.withColumn(
        "quality_score",
        percent(F.col("records_passed"), F.col("records_passed") + F.col("records_failed")),
    )
