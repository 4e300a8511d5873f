"""Event-log analytics: expectation results, update health, error reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.exprs import hours_since, mean, percent, preview, since, ts_lit
from vigil.plans.lists import Listed, listed
from vigil.settings import DEFAULTS, FreshnessThresholds

# Labels of the freshness report.
FRESH_CRITICAL = "CRITICAL: >48h"
FRESH_WARNING = "WARNING: >24h"
FRESH_OK = "OK"


UPDATE = ("pipeline_id", "pipeline_name", "update_id")


def parsed(events: DataFrame) -> DataFrame:
    return events.withColumn("_d", F.from_json("details", schemas.EVENT_DETAILS))


def results(details: str) -> Column:
    """One row per expectation result.

    The outer form, with the empty rows dropped afterwards: a plain ``explode`` makes the
    optimizer test the array below the parser, which parses every payload three times.
    """
    return F.explode_outer(f"{details}.data_quality.expectations")


def pass_rate(passed: str = "passed_records", failed: str = "failed_records"):
    checked = F.col(passed) + F.col(failed)
    return F.when(checked > 0, F.col(passed) / checked).otherwise(F.lit(1.0))


def quality_metrics(events: DataFrame, as_of: datetime) -> DataFrame:
    """One row per expectation result found in flow events."""
    flows = events.filter(F.col("event_type") == "flow_progress")
    each = (
        parsed(flows)
        .select(
            "pipeline_id",
            "pipeline_name",
            "update_id",
            "timestamp",
            F.col("_d.flow_name").alias("dataset_name"),
            results("_d").alias("_x"),
        )
        .filter(F.col("_x").isNotNull())
    )
    return each.select(
        "pipeline_id",
        "pipeline_name",
        "update_id",
        "timestamp",
        "dataset_name",
        F.col("_x.name").alias("expectation_name"),
        F.coalesce("_x.constraint", "_x.dataset").alias("expectation_query"),
        F.col("_x.action").alias("expectation_action"),
        F.col("_x.passed_records").alias("passed_records"),
        F.col("_x.failed_records").alias("failed_records"),
    ).select(
        "*", pass_rate().alias("pass_rate"), ts_lit(as_of).alias("ingestion_timestamp")
    )


def _array_sum(field: str):
    return F.aggregate(
        F.coalesce(F.col(f"_x.{field}"), F.array().cast("array<bigint>")),
        F.lit(0).cast("bigint"),
        lambda acc, v: acc + F.coalesce(v, F.lit(0)),
    )


def health_partials(events: DataFrame, *by: Column) -> DataFrame:
    """Mergeable parts of ``update_health``, one row per (``by``, update, dataset, state).

    Expectation arrays are summed inside their row, so nothing is exploded or joined. All
    buffers have a fixed width, so hash aggregation applies; a handful of rows is left per update.
    """
    progress = F.col("event_type") == "update_progress"
    by_names = [f"_by{i}" for i in range(len(by))]
    rows = (
        parsed(events)
        .withColumn("_x", F.col("_d.data_quality.expectations"))
        .select(
            *[column.alias(name) for column, name in zip(by, by_names)],
            *UPDATE,
            "level",
            F.when(progress, F.col("timestamp")).alias("_at"),
            F.when(progress, F.col("_d.state")).alias("_state"),
            F.when(~progress, F.col("_d.flow_name")).alias("_flow"),
            F.greatest(F.size("_x"), F.lit(0)).alias("_size"),
            _array_sum("passed_records").alias("_passed"),
            _array_sum("failed_records").alias("_failed"),
            F.greatest(
                F.size(F.filter("_x", lambda x: x["failed_records"] > 0)), F.lit(0)
            ).alias("_broken"),
        )
    )
    summed = {
        "_size": F.sum("_size"),
        "_passed": F.sum("_passed"),
        "_failed": F.sum("_failed"),
        "_broken": F.sum("_broken"),
        "error_count": F.count_if(F.col("level") == "ERROR"),
        "warning_count": F.count_if(F.col("level") == "WARN"),
    }
    return rows.groupBy(*by_names, *UPDATE, "_flow", "_state").agg(
        F.min("_at").alias("_first"),
        F.max("_at").alias("_last"),
        *[total.alias(name) for name, total in summed.items()],
    )


def merged_health(partials: DataFrame, as_of: datetime) -> DataFrame:
    """``update_health`` from any number of parts per update."""
    latest = F.when(F.col("_last").isNotNull(), F.struct("_last", "_state"))
    grouped = partials.groupBy(*UPDATE).agg(
        F.min("_first").alias("start_time"),
        F.max("_last").alias("end_time"),
        F.max(latest).alias("_latest"),
        F.countDistinct("_flow").alias("num_datasets"),
        F.sum(F.col("_passed") + F.col("_failed")).alias("total_records_processed"),
        F.sum("_size").alias("total_expectations_checked"),
        F.sum("_broken").alias("total_expectations_failed"),
        F.sum("_passed").alias("_good"),
        F.sum("error_count").alias("error_count"),
        F.sum("warning_count").alias("warning_count"),
    )
    span = F.unix_timestamp("end_time") - F.unix_timestamp("start_time")
    return (
        grouped.filter(F.col("start_time").isNotNull())
        .withColumns(
            {
                "duration_seconds": span,
                "status": F.coalesce("_latest._state", F.lit("RUNNING")),
                "overall_quality_score": percent(
                    F.col("_good"), F.col("total_records_processed")
                ),
                "ingestion_timestamp": ts_lit(as_of),
            }
        )
        .select(*schemas.UPDATE_HEALTH.fieldNames())
    )


def update_health(events: DataFrame, as_of: datetime) -> DataFrame:
    """One row per update: span, last state, record and expectation counts, errors."""
    return merged_health(health_partials(events), as_of)


def _avg_duration():
    return mean(F.sum("duration_seconds"), F.count("duration_seconds"))


def executions_by_status(health: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        health.filter(since("start_time", as_of, days=days))
        .groupBy("pipeline_name", "status")
        .agg(
            F.count("*").alias("execution_count"),
            _avg_duration().alias("avg_duration_seconds"),
            F.max("duration_seconds").alias("max_duration_seconds"),
            F.sum("error_count").alias("total_errors"),
            F.sum("warning_count").alias("total_warnings"),
        )
        .orderBy("pipeline_name", "status")
    )


def execution_summary(health: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        health.filter(since("start_time", as_of, days=days))
        .groupBy("pipeline_name")
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(F.col("status") == "COMPLETED").alias("successful_runs"),
            F.count_if(F.col("status").isin("FAILED", "CANCELED")).alias("failed_runs"),
            F.sum("duration_seconds").alias("_sum"),
            F.count("duration_seconds").alias("_n"),
            F.sum("error_count").alias("total_errors"),
            F.sum("warning_count").alias("total_warnings"),
            F.max("start_time").alias("last_run_time"),
        )
        .withColumns(
            {
                # Mean seconds in minutes, as one exact quotient.
                "avg_duration_minutes": percent(
                    F.col("_sum"), F.col("_n") * F.lit(6000)
                ),
                "success_rate": percent(F.col("successful_runs"), F.col("total_runs")),
            }
        )
        .drop("_sum", "_n")
        .orderBy("success_rate", F.desc("total_runs"), "pipeline_name")
    )


def freshness(
    health: DataFrame,
    as_of: datetime,
    limits: FreshnessThresholds = DEFAULTS.freshness,
    listed_hours: int | None = None,
) -> DataFrame:
    """Hours since the last run of each pipeline, for those above ``listed_hours``."""
    shown = limits.listed_hours if listed_hours is None else listed_hours
    hours = F.col("hours_since_last_run")
    return (
        health.filter(F.col("start_time") <= ts_lit(as_of))
        .groupBy("pipeline_name")
        .agg(F.max("start_time").alias("last_run_time"))
        .withColumn("hours_since_last_run", hours_since("last_run_time", as_of))
        .filter(hours > shown)
        .withColumn(
            "freshness_status",
            F.when(hours > limits.critical_hours, FRESH_CRITICAL)
            .when(hours > limits.warning_hours, FRESH_WARNING)
            .otherwise(FRESH_OK),
        )
        .orderBy(F.desc("hours_since_last_run"), "pipeline_name")
    )


def error_analysis(events: DataFrame, as_of: datetime, days: int = 7, limit: int = 25) -> DataFrame:
    return (
        events.filter(since("timestamp", as_of, days=days) & F.col("level").isin("ERROR", "WARN"))
        .groupBy("pipeline_name", "event_type", "level", "error")
        .agg(
            F.count("*").alias("occurrence_count"),
            F.max("timestamp").alias("last_occurred"),
        )
        .orderBy(
            F.desc("occurrence_count"),
            F.desc("last_occurred"),
            "pipeline_name",
            "event_type",
            "level",
            "error",
        )
        .limit(limit)
    )


def error_patterns(events: DataFrame, as_of: datetime, days: int = 7, limit: int = 25) -> Listed:
    """Most frequent error texts: their totals, and the pipelines they occur in one row each."""
    errors = events.filter(
        since("timestamp", as_of, days=days)
        & (F.col("level") == "ERROR")
        & F.col("error").isNotNull()
    )
    pairs = errors.groupBy(preview("error", 100).alias("error_pattern"), "pipeline_name").agg(
        F.count("*").alias("_n"), F.max("timestamp").alias("_last")
    )
    totals = {
        "affected_pipelines": F.count("pipeline_name"),
        "occurrence_count": F.sum("_n"),
        "last_occurred": F.max("_last"),
    }
    order = [F.desc("occurrence_count"), F.col("error_pattern")]
    return listed(pairs, ["error_pattern"], "pipeline_name", "pipeline_name", totals, order, limit)
