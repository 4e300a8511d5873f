"""Reports over stored job-run metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import is_failure, mean, percent, preview, since
from vigil.plans.lists import Listed, listed
from vigil.plans.ordered import running_totals, trailing_mean
from vigil.settings import DEFAULTS


def _avg(col: str):
    return mean(F.sum(col), F.count(col))


def summary(jobs: DataFrame) -> DataFrame:
    return (
        jobs.groupBy("job_name", "result_state")
        .agg(
            F.count("*").alias("run_count"),
            _avg("duration_seconds").alias("avg_duration_seconds"),
            F.sum("total_cost").alias("total_cost"),
        )
        .orderBy(F.desc("total_cost"), "job_name", "result_state")
    )


def by_state(jobs: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        jobs.filter(since("start_time", as_of, days=days))
        .groupBy("job_name", "result_state")
        .agg(
            F.count("*").alias("run_count"),
            _avg("duration_seconds").alias("avg_duration_seconds"),
            F.max("duration_seconds").alias("max_duration_seconds"),
            F.sum("total_cost").alias("total_cost"),
            F.max("start_time").alias("last_run_time"),
        )
        .orderBy("job_name", "result_state")
    )


def _successful(jobs: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return jobs.filter(
        since("start_time", as_of, days=days) & (F.col("result_state") == "SUCCESS")
    )


def most_expensive(jobs: DataFrame, as_of: datetime, days: int = 7, limit: int = 20) -> DataFrame:
    return (
        _successful(jobs, as_of, days)
        .groupBy("job_name")
        .agg(
            F.count("*").alias("run_count"),
            F.sum("total_cost").alias("total_cost"),
            _avg("total_cost").alias("avg_cost_per_run"),
            _avg("duration_seconds").alias("avg_duration_seconds"),
            F.sum("total_dbu_usage").alias("total_dbu_usage"),
        )
        .orderBy(F.desc("total_cost"), "job_name")
        .limit(limit)
    )


def top_by_cost(jobs: DataFrame, as_of: datetime, days: int = 7, limit: int = 10) -> DataFrame:
    """As ``most_expensive``, with durations in hours."""
    ranked = most_expensive(jobs, as_of, days, limit)
    hours = F.col("avg_duration_seconds") / 3600
    return ranked.withColumn("avg_duration_hours", hours).drop("avg_duration_seconds")


def success_rate(jobs: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    return (
        jobs.filter(since("start_time", as_of, days=days))
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(F.col("result_state") == "SUCCESS").alias("successful_runs"),
            F.count_if(is_failure()).alias("failed_runs"),
        )
        .withColumn("success_rate", percent(F.col("successful_runs"), F.col("total_runs")))
    )


def failure_rate(jobs: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    return (
        jobs.filter(since("start_time", as_of, hours=hours))
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(is_failure()).alias("failed_runs"),
        )
        .withColumn("failure_rate", percent(F.col("failed_runs"), F.col("total_runs")))
    )


def failures_with_messages(
    jobs: DataFrame, as_of: datetime, days: int = 7, limit: int = 25
) -> Listed:
    """Failing (job, state) pairs: their totals, and their distinct messages one row each."""
    failed = jobs.filter(since("start_time", as_of, days=days) & is_failure()).withColumn(
        "_message", preview("error_message", 100)
    )
    # Equal messages collapse before the shuffle.
    keys = ["job_name", "result_state"]
    distinct = failed.groupBy(*keys, "_message").agg(
        F.count("*").alias("_n"), F.max("start_time").alias("_last")
    )
    totals = {
        "failure_count": F.sum("_n"),
        "last_failure": F.max("_last"),
        "distinct_messages": F.count("_message"),
    }
    order = [F.desc("failure_count"), *[F.col(k) for k in keys]]
    return listed(distinct, keys, "_message", "error_message", totals, order, limit)


def duration_trend(
    jobs: DataFrame, as_of: datetime, days: int = 30, min_runs: int = 3
) -> DataFrame:
    finished = _successful(jobs, as_of, days).filter(F.col("duration_seconds").isNotNull())
    return (
        finished.groupBy(F.to_date("start_time").alias("execution_date"), "job_name")
        .agg(
            (_avg("duration_seconds") / 60).alias("avg_duration_minutes"),
            (F.min("duration_seconds") / 60).alias("min_duration_minutes"),
            (F.max("duration_seconds") / 60).alias("max_duration_minutes"),
            F.count("*").alias("run_count"),
        )
        .filter(F.col("run_count") >= min_runs)
        .orderBy(F.desc("execution_date"), "job_name")
    )


def failure_streaks(
    jobs: DataFrame,
    minimum: int = DEFAULTS.jobs.consecutive_failures,
    bucket: str = "HOUR",
) -> DataFrame:
    """Runs of at least ``minimum`` failures in a row per job.

    A streak is identified by the number of non-failures before it, so it is a plain
    grouping once that running count is known.
    """
    ok = F.when(is_failure(), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    numbered = running_totals(
        jobs.select("job_id", "job_name", "run_id", "start_time", "result_state"),
        ["job_id"],
        F.date_trunc(bucket, "start_time"),
        ["start_time", "run_id"],
        {"_island": ok},
    )
    return (
        numbered.filter(is_failure())
        .groupBy("job_id", "job_name", "_island")
        .agg(
            F.count("*").alias("consecutive_failures"),
            F.min("start_time").alias("first_failure"),
            F.max("start_time").alias("last_failure"),
        )
        .filter(F.col("consecutive_failures") >= minimum)
        .drop("_island")
    )


def duration_regressions(
    jobs: DataFrame,
    runs: int = DEFAULTS.jobs.baseline_runs,
    increase_percent: float = DEFAULTS.jobs.duration_increase_percent,
    bucket: str = "HOUR",
) -> DataFrame:
    """Finished runs that took longer than the mean of the job's previous ``runs`` runs allows."""
    finished = jobs.filter(F.col("duration_seconds").isNotNull()).select(
        "job_id", "job_name", "run_id", "start_time", "duration_seconds"
    )
    framed = trailing_mean(
        finished,
        ["job_id"],
        F.date_trunc(bucket, "start_time"),
        ["start_time", "run_id"],
        "duration_seconds",
        runs,
    )
    # Only a full frame is a baseline.
    over = (F.col("duration_seconds") * F.col("trailing_n") - F.col("trailing_sum")) * 100
    limit = F.col("trailing_sum") * F.lit(increase_percent).cast("decimal(9,2)")
    return framed.filter((F.col("trailing_n") == runs) & (over > limit)).select(
        "job_id",
        "job_name",
        "run_id",
        "start_time",
        "duration_seconds",
        mean(F.col("trailing_sum"), F.col("trailing_n")).alias("baseline_seconds"),
        percent(over / 100, F.col("trailing_sum")).alias("increase_percent"),
    )


def sla_violations(
    jobs: DataFrame, max_minutes: int = DEFAULTS.jobs.max_duration_minutes
) -> DataFrame:
    return jobs.filter(F.col("duration_seconds") > max_minutes * 60)


def throughput(jobs: DataFrame, granularity: str = "1 day") -> DataFrame:
    """Started and finished runs, mean latency and backlog per window.

    A run adds one start to the window it starts in and one end to the window it ends in.
    """
    marks = F.array(
        F.struct(
            F.col("start_time").alias("at"),
            F.lit(1).alias("s"),
            F.lit(0).alias("e"),
            F.col("duration_seconds").alias("d"),
        ),
        F.struct(
            F.col("end_time").alias("at"),
            F.lit(0).alias("s"),
            F.lit(1).alias("e"),
            F.lit(None).cast("bigint").alias("d"),
        ),
    )
    per_window = (
        jobs.select(F.explode(marks).alias("m"))
        .filter(F.col("m.at").isNotNull())
        .groupBy(F.window("m.at", granularity).alias("w"))
        .agg(
            F.sum("m.s").alias("started"),
            F.sum("m.e").alias("finished"),
            _avg("m.d").alias("avg_latency_seconds"),
        )
        .select(F.col("w.start").alias("window_start"), "started", "finished", "avg_latency_seconds")
    )
    # One row per window from here on.
    return running_totals(
        per_window,
        [],
        F.date_trunc("YEAR", "window_start"),
        ["window_start"],
        {"backlog": F.col("started") - F.col("finished")},
        bucket_rows=None,
    )
