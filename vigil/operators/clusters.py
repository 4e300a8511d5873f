"""Reports over stored cluster metrics."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import mean, percent, ratio, since
from vigil.settings import DEFAULTS


def _usage() -> list[Column]:
    return [
        mean(F.sum("num_workers"), F.count("num_workers")).alias("avg_workers"),
        F.max("num_workers").alias("max_workers"),
        F.sum("uptime_seconds").alias("_uptime"),
        F.sum("dbu_rate").alias("_rates"),
        F.count("dbu_rate").alias("_n"),
    ]


def summary(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_name", "state")
        .agg(
            mean(F.sum("num_workers"), F.count("num_workers")).alias("avg_workers"),
            F.sum("uptime_seconds").alias("total_uptime_seconds"),
            mean(F.sum("dbu_rate"), F.count("dbu_rate")).alias("avg_dbu_rate"),
        )
        .orderBy(F.desc("total_uptime_seconds"), "cluster_name", "state")
    )


def utilization_by_state(clusters: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    hours = F.col("_uptime") / F.lit(3600)
    rate = mean(F.col("_rates"), F.col("_n"))
    return (
        clusters.filter(since("timestamp", as_of, days=days))
        .groupBy("cluster_name", "state")
        .agg(*_usage())
        .select(
            "cluster_name",
            "state",
            "avg_workers",
            "max_workers",
            hours.alias("total_uptime_hours"),
            rate.alias("avg_dbu_rate"),
            (hours * rate).alias("estimated_dbu_usage"),
        )
        .orderBy(F.desc("estimated_dbu_usage"), "cluster_name", "state")
    )


def active_cost(
    clusters: DataFrame,
    as_of: datetime,
    days: int = 7,
    cost_per_dbu: str = DEFAULTS.rates.cost_per_dbu,
) -> DataFrame:
    """Active clusters with uptime, estimated usage and cost."""
    active = clusters.filter(
        since("timestamp", as_of, days=days) & F.col("state").isin("RUNNING", "RESIZING")
    )
    work = F.col("_uptime").cast("decimal(16,0)") * F.col("_rates").cast("decimal(14,1)")
    seconds = F.col("_n") * 3600
    return (
        active.groupBy("cluster_name")
        .agg(*_usage())
        .select(
            "cluster_name",
            "avg_workers",
            "max_workers",
            ratio(F.col("_uptime"), F.lit(3600)).alias("total_uptime_hours"),
            ratio(work, seconds).alias("estimated_dbu_usage"),
            ratio(work * F.lit(Decimal(cost_per_dbu)), seconds).alias("estimated_cost"),
        )
        .orderBy(F.desc("total_uptime_hours"), "cluster_name")
    )


def idle(clusters: DataFrame, min_idle_percent: float = 0.0) -> DataFrame:
    """Uptime a cluster spent without workers, most wasteful first."""
    no_workers = F.when(F.col("num_workers") == 0, F.col("uptime_seconds")).otherwise(0)
    return (
        clusters.groupBy("cluster_name")
        .agg(
            F.sum("uptime_seconds").alias("total_uptime_seconds"),
            F.sum(no_workers).alias("idle_seconds"),
        )
        .withColumn("idle_percent", percent(F.col("idle_seconds"), F.col("total_uptime_seconds")))
        .filter(F.col("idle_percent") > min_idle_percent)
        .orderBy(F.desc("idle_percent"), "cluster_name")
    )
