"""Reports over stored cost metrics."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.exprs import as_day, day_lit, mean, month_start, percent, since_day
from vigil.settings import DEFAULTS, CostThresholds

# Status labels of the day-over-day report.
ALERT_LABEL = "ALERT: >50% increase"
WARNING_LABEL = "WARNING: >25% increase"
NORMAL_LABEL = "NORMAL"


def _totals(df: DataFrame, keys: list[str], usage: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("cost").alias("total_cost"), F.sum("usage_quantity").alias(usage)
    )


def by_date_and_sku(cost: DataFrame) -> DataFrame:
    return _totals(cost, ["usage_date", "sku_name"], "total_usage").orderBy(
        F.desc("usage_date"), F.desc("total_cost"), "sku_name"
    )


def daily_by_cloud(cost: DataFrame) -> DataFrame:
    return _totals(cost, ["usage_date", "cloud"], "total_dbu_usage").orderBy(
        F.desc("usage_date"), "cloud"
    )


def daily_trend(cost: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    recent = cost.filter(since_day("usage_date", as_of, days))
    return _totals(recent, ["usage_date"], "total_dbu_usage").orderBy("usage_date")


def top_drivers(cost: DataFrame, as_of: datetime, days: int = 7, limit: int = 20) -> DataFrame:
    """Most expensive (SKU, product) pairs with their mean cost per active day."""
    # Daily rows first: the distinct count of days becomes a plain count.
    daily = _totals(
        cost.filter(since_day("usage_date", as_of, days)),
        ["sku_name", "billing_origin_product", "usage_date"],
        "usage",
    )
    return (
        daily.groupBy("sku_name", "billing_origin_product")
        .agg(
            F.sum("total_cost").alias("total_cost"),
            F.sum("usage").alias("total_usage"),
            F.count("*").alias("days_active"),
        )
        .withColumn("avg_daily_cost", mean(F.col("total_cost"), F.col("days_active")))
        .orderBy(F.desc("total_cost"), "sku_name", "billing_origin_product")
        .limit(limit)
    )


def month_to_date_by_sku(cost: DataFrame, as_of: datetime, limit: int = 15) -> DataFrame:
    """Month-to-date cost per (SKU, product) and its share of the whole month."""
    month = cost.filter(
        (F.col("usage_date") >= day_lit(month_start(as_of)))
        & (F.col("usage_date") <= day_lit(as_day(as_of)))
    )
    keys = ["sku_name", "billing_origin_product"]
    # Groups and grand total come from one scan. The total sorts first, so the window
    # below sees the reported rows and the total only.
    ranked = (
        month.groupingSets([keys, []], *keys)
        .agg(F.sum("cost").alias("total_cost"), F.grouping_id().alias("_level"))
        .orderBy(F.desc("_level"), F.desc("total_cost"), *keys)
        .limit(limit + 1)
    )
    whole = F.max(F.when(F.col("_level") > 0, F.col("total_cost"))).over(Window.partitionBy())
    return (
        ranked.withColumn("cost_percentage", percent(F.col("total_cost"), whole))
        .filter(F.col("_level") == 0)
        .drop("_level")
        .orderBy(F.desc("total_cost"), *keys)
    )


def daily_with_previous(cost: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Daily cost beside that of the previous day on record."""
    daily = (
        cost.filter(since_day("usage_date", as_of, days))
        .groupBy("usage_date")
        .agg(F.sum("cost").alias("daily_cost"))
    )
    # At most one row per day of the lookback is ordered here.
    previous = F.lag("daily_cost").over(Window.orderBy("usage_date"))
    change = F.col("daily_cost") - F.col("previous_day_cost")
    return (
        daily.withColumn("previous_day_cost", previous)
        .filter(F.col("previous_day_cost").isNotNull())
        .withColumn("percent_change", percent(change, F.col("previous_day_cost")))
    )


def anomalies(
    cost: DataFrame,
    as_of: datetime,
    days: int = 14,
    limits: CostThresholds = DEFAULTS.cost,
) -> DataFrame:
    """Day-over-day change with a status label."""
    days_seen = daily_with_previous(cost, as_of, days)
    change = (F.col("daily_cost") - F.col("previous_day_cost")) * 100

    def above(limit: float):
        return change > F.col("previous_day_cost") * F.lit(limit).cast("decimal(9,2)")

    status = (
        F.when(above(limits.anomaly_alert_percent), ALERT_LABEL)
        .when(above(limits.anomaly_warning_percent), WARNING_LABEL)
        .otherwise(NORMAL_LABEL)
    )
    return days_seen.withColumn("status", status).orderBy(F.desc("usage_date"))


def yesterday_against_average(
    cost: DataFrame,
    as_of: datetime,
    days: int = 14,
    limits: CostThresholds = DEFAULTS.cost,
) -> DataFrame:
    """Cost of the last full day against the mean of the days before ``as_of``."""
    today = as_day(as_of)
    yesterday = today - timedelta(days=1)
    daily = (
        cost.filter(
            (F.col("usage_date") >= day_lit(today - timedelta(days=days)))
            & (F.col("usage_date") < day_lit(today))
        )
        .groupBy("usage_date")
        .agg(F.sum("cost").alias("daily_cost"))
    )
    # Both figures come from the same daily rows: one aggregate, no join.
    is_yesterday = F.col("usage_date") == day_lit(yesterday)
    both = daily.agg(
        F.sum(F.when(is_yesterday, F.col("daily_cost"))).alias("today_cost"),
        F.sum("daily_cost").alias("_sum"),
        F.count("*").alias("_days"),
    )
    # (today - sum/days) / (sum/days) without an intermediate quotient.
    excess = F.col("today_cost") * F.col("_days") - F.col("_sum")
    above = percent(excess, F.col("_sum"))
    flag = excess * 100 > F.col("_sum") * F.lit(limits.above_average_percent).cast("decimal(9,2)")
    return both.select(
        "today_cost",
        mean(F.col("_sum"), F.col("_days")).alias("avg_daily_cost"),
        above.alias("percent_above_average"),
        F.when(flag, 1).otherwise(0).alias("cost_alert"),
    )
