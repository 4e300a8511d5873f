"""Reports over stored quality metrics."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import as_day, on_day, percent, severity_rank, since
from vigil.functions.exprs import day_lit
from vigil.settings import DEFAULTS, QualityThresholds


def score() -> Column:
    """Passed records in percent of all checked records."""
    passed = F.sum("passed_records")
    return percent(passed, passed + F.sum("failed_records"))


def avg_rate(digits: int = 10) -> Column:
    """Mean pass rate from exact decimals, so that it does not depend on row order."""
    total = F.sum(F.col("pass_rate").cast(f"decimal(18,{digits})"))
    return total.cast("double") / F.count("pass_rate")


def trend_daily(metrics: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        metrics.filter(since("timestamp", as_of, days=days))
        .groupBy(F.to_date("timestamp").alias("date"), "dataset_name", "expectation_name")
        .agg(
            avg_rate().alias("avg_pass_rate"),
            F.sum("failed_records").alias("total_failed_records"),
            F.sum("passed_records").alias("total_passed_records"),
        )
        .orderBy(F.desc("date"), "dataset_name", "expectation_name")
    )


def failed_report(metrics: DataFrame, as_of: datetime, days: int = 7, limit: int = 50) -> DataFrame:
    return (
        metrics.filter((F.col("pass_rate") < 1.0) & since("timestamp", as_of, days=days))
        .select(
            "pipeline_name",
            "dataset_name",
            "expectation_name",
            "timestamp",
            "passed_records",
            "failed_records",
            "pass_rate",
            "expectation_query",
        )
        .orderBy(
            F.desc("timestamp"),
            "pass_rate",
            "pipeline_name",
            "dataset_name",
            "expectation_name",
        )
        .limit(limit)
    )


def by_pipeline(metrics: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        metrics.filter(since("timestamp", as_of, days=days))
        .groupBy("pipeline_name")
        .agg(
            F.countDistinct("dataset_name").alias("dataset_count"),
            F.sum("passed_records").alias("total_passed"),
            F.sum("failed_records").alias("total_failed"),
            score().alias("overall_quality_score"),
        )
        .orderBy("overall_quality_score", "pipeline_name")
    )


def failures_by_dataset(
    metrics: DataFrame, as_of: datetime, days: int = 7, limit: int = 50
) -> DataFrame:
    return (
        metrics.filter(since("timestamp", as_of, days=days) & (F.col("failed_records") > 0))
        .groupBy("dataset_name", "expectation_name")
        .agg(
            F.count("*").alias("failure_count"),
            F.sum("failed_records").alias("total_failed_records"),
            avg_rate().alias("avg_pass_rate"),
            F.min("pass_rate").alias("min_pass_rate"),
            F.max("timestamp").alias("last_failure"),
        )
        .orderBy(
            F.desc("total_failed_records"),
            F.desc("failure_count"),
            "dataset_name",
            "expectation_name",
        )
        .limit(limit)
    )


def daily_by_pipeline(metrics: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (
        metrics.filter(since("timestamp", as_of, days=days))
        .groupBy(F.to_date("timestamp").alias("quality_date"), "pipeline_name")
        .agg(
            score().alias("daily_quality_score"),
            F.sum(F.col("passed_records") + F.col("failed_records")).alias(
                "total_records_processed"
            ),
        )
        .orderBy(F.desc("quality_date"), "pipeline_name")
    )


def rules_status(
    rules: DataFrame, metrics: DataFrame, as_of: datetime, days: int = 7
) -> DataFrame:
    """Enabled rules with how often they were checked and failed lately."""
    checks = (
        metrics.filter(since("timestamp", as_of, days=days))
        .groupBy("dataset_name", "expectation_name")
        .agg(
            F.count("*").alias("_checks"),
            F.count_if(F.col("failed_records") > 0).alias("_fails"),
        )
    )
    good = percent(F.col("times_checked") - F.col("times_failed"), F.col("times_checked"))
    return (
        rules.filter("is_enabled")
        .join(checks, ["dataset_name", "expectation_name"], "left")
        .select(
            "dataset_name",
            "expectation_name",
            "expectation_type",
            "severity",
            "is_enabled",
            F.coalesce("_checks", F.lit(0)).alias("times_checked"),
            F.coalesce("_fails", F.lit(0)).alias("times_failed"),
        )
        .withColumn("pass_rate", F.coalesce(good, F.lit(100.0)))
        .orderBy("pass_rate", severity_rank(), "dataset_name", "expectation_name")
    )


def low_pass_rate(
    metrics: DataFrame, as_of: datetime, days: int = 7,
    limit_percent: float = DEFAULTS.quality.pass_rate,
) -> DataFrame:
    """Datasets whose mean pass rate is under the threshold."""
    return (
        metrics.filter(since("timestamp", as_of, days=days))
        .groupBy("dataset_name")
        .agg(avg_rate().alias("avg_pass_rate"))
        .filter(F.col("avg_pass_rate") * 100 < limit_percent)
        .orderBy("avg_pass_rate", "dataset_name")
    )


def grade(score_col: str, limits: QualityThresholds = DEFAULTS.quality) -> Column:
    """Health grade of a score on the 0-100 scale."""
    value = F.col(score_col)
    return (
        F.when(value.isNull(), F.lit(None))
        .when(value >= limits.healthy, "healthy")
        .when(value < limits.critical, "critical")
        .when(value < limits.warning, "warning")
        .otherwise("degraded")
    )


def graded(
    metrics: DataFrame, as_of: datetime, days: int = 7,
    limits: QualityThresholds = DEFAULTS.quality,
) -> DataFrame:
    return (
        metrics.filter(since("timestamp", as_of, days=days))
        .groupBy("pipeline_name", "dataset_name")
        .agg(score().alias("quality_score"))
        .withColumn("health", grade("quality_score", limits))
    )


def executive_summary(
    cost: DataFrame, jobs: DataFrame, metrics: DataFrame, events: DataFrame, as_of: datetime
) -> DataFrame:
    """Five figures for the day before ``as_of``; each source is scanned once."""
    day: date = as_day(as_of) - timedelta(days=1)
    zero = F.lit(0).cast("bigint")
    failed = F.col("result_state").isin("FAILED", "TIMEDOUT", "CANCELED")
    figures = [
        cost.filter(F.col("usage_date") == day_lit(day)).agg(
            F.sum("cost").cast("decimal(38,4)").alias("yesterday_cost")
        ),
        jobs.filter(on_day("start_time", day)).agg(
            F.count("*").alias("total_jobs_run"), F.count_if(failed).alias("failed_jobs")
        ),
        metrics.filter(on_day("timestamp", day)).agg(score().alias("overall_quality_score")),
        events.filter(on_day("timestamp", day) & (F.col("level") == "ERROR")).agg(
            F.count("*").alias("total_errors")
        ),
    ]
    # Four one-row relations are stacked and folded into one row.
    stacked = figures[0]
    for part in figures[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(
        F.max("yesterday_cost").alias("yesterday_cost"),
        F.coalesce(F.max("total_jobs_run"), zero).alias("total_jobs_run"),
        F.coalesce(F.max("failed_jobs"), zero).alias("failed_jobs"),
        F.max("overall_quality_score").alias("overall_quality_score"),
        F.coalesce(F.max("total_errors"), zero).alias("total_errors"),
    ).select(day_lit(day).alias("report_date"), "*")
