"""Reports over stored query-history metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import percent, preview, ratio, since
from vigil.settings import DEFAULTS, QueryThresholds


def slow_preview(
    queries: DataFrame, limit: int = 20, min_ms: int = DEFAULTS.queries.listed_ms
) -> DataFrame:
    return (
        queries.filter(F.col("duration_ms") > min_ms)
        .select(
            "query_id",
            "query_start_time",
            "duration_ms",
            "rows_produced",
            "bytes_scanned",
            preview("query_text", 100).alias("query_preview"),
        )
        .orderBy(F.desc("duration_ms"), "query_id")
        .limit(limit)
    )


def slowest(queries: DataFrame, as_of: datetime, days: int = 7, limit: int = 25) -> DataFrame:
    return (
        queries.filter(since("query_start_time", as_of, days=days) & F.col("error_message").isNull())
        .orderBy(F.desc("duration_ms"), "query_id")
        .limit(limit)
        .select(
            "query_id",
            "query_start_time",
            (F.col("duration_ms") / 1000).alias("duration_seconds"),
            "rows_produced",
            (F.col("bytes_scanned") / F.lit(1024.0) / F.lit(1024.0)).alias("mb_scanned"),
            "executed_by_user_name",
            preview("query_text", 200).alias("query_preview"),
        )
    )


def slow_last_day(
    queries: DataFrame,
    as_of: datetime,
    hours: int = 24,
    limit: int = 50,
    min_ms: int = DEFAULTS.queries.listed_ms,
) -> DataFrame:
    recent = queries.filter(
        since("query_start_time", as_of, hours=hours)
        & F.col("error_message").isNull()
        & (F.col("duration_ms") > min_ms)
    )
    return (
        recent.orderBy(F.desc("duration_ms"), "query_id")
        .limit(limit)
        .select(
            "query_id",
            "query_start_time",
            (F.col("duration_ms") / 1000).alias("duration_seconds"),
            "rows_produced",
            ratio(F.col("bytes_scanned"), F.lit(1024**3)).alias("gb_scanned"),
            "executed_by_user_name",
            preview("query_text", 200).alias("query_preview"),
        )
    )


def error_patterns(queries: DataFrame, as_of: datetime, days: int = 7, limit: int = 20) -> DataFrame:
    failed = queries.filter(
        since("query_start_time", as_of, days=days) & F.col("error_message").isNotNull()
    )
    return (
        failed.groupBy(preview("error_message", 100).alias("error_pattern"))
        .agg(
            F.count("*").alias("occurrence_count"),
            F.countDistinct("executed_by_user_name").alias("affected_users"),
            F.max("query_start_time").alias("last_occurred"),
        )
        .orderBy(F.desc("occurrence_count"), "error_pattern")
        .limit(limit)
    )


def performance(
    queries: DataFrame, as_of: datetime, hours: int = 24,
    limits: QueryThresholds = DEFAULTS.queries,
) -> DataFrame:
    """Share of failed queries and number of slow ones in the lookback."""
    return (
        queries.filter(since("query_start_time", as_of, hours=hours))
        .agg(
            F.count("*").alias("total_queries"),
            F.count_if(F.col("error_message").isNotNull()).alias("failed_queries"),
            F.count_if(F.col("duration_ms") > limits.slow_seconds * 1000).alias("slow_queries"),
        )
        .withColumn("error_rate", percent(F.col("failed_queries"), F.col("total_queries")))
    )
