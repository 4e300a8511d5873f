"""Threshold checks as DataFrames of alerts, their history, routing and delivery table.

Nothing is sent from here: critical alerts end as rows of an outbox table.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.exprs import as_day, day_lit, seconds_between, since, ts_lit
from vigil.operators import costs, event_log, jobs, queries, quality
from vigil.plans.scratch import cut, stored
from vigil.settings import DEFAULTS, Delivery, Settings

# Subject lines and priorities of the notification templates.
TEMPLATES = (
    ("pipeline_failure", "[ALERT] Pipeline Failure: {pipeline_name}", "high"),
    ("quality_degradation", "[WARNING] Data Quality Alert: {dataset_name}", "medium"),
    ("cost_anomaly", "[ALERT] Cost Anomaly Detected", "high"),
    ("sla_violation", "[CRITICAL] SLA Violation: {pipeline_name}", "critical"),
)


# Texts of the alerts.
COST_INCREASE = "Daily cost increased by %s%% ($%s → $%s)"
COST_LIMIT = "Daily cost $%s exceeds threshold $%s"
FAILURE_RATE = "Job failure rate is %s%% (%s/%s jobs failed in last hour)"
LOW_QUALITY = "Data quality score for %s is %s%% (%s records failed)"
STALE = "Pipeline %s hasn't run in %s hours (last run: %s)"


def _text(pattern: str, *parts: Column | str) -> Column:
    return F.format_string(
        pattern, *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    )


def _cents(col: str) -> Column:
    return F.format_string("%.2f", F.round(col, 2).cast("double"))


def _details(**values: Column | str) -> Column:
    pairs = [
        part
        for name, col in values.items()
        for part in (F.lit(name), (F.col(col) if isinstance(col, str) else col).cast("string"))
    ]
    return F.create_map(*pairs)


def _alerts(
    df: DataFrame,
    kind: str,
    severity: Column | str,
    message: Column,
    details: Column,
    as_of: datetime,
) -> DataFrame:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(
        F.lit(kind).alias("alert_type"),
        level.alias("severity"),
        message.alias("message"),
        details.alias("details"),
        ts_lit(as_of).alias("triggered_at"),
    )


def _last_full_day(cost: DataFrame, as_of: datetime) -> DataFrame:
    yesterday = as_day(as_of) - timedelta(days=1)
    return costs.daily_with_previous(cost, as_of, 7).filter(
        F.col("usage_date") == day_lit(yesterday)
    )


def cost_alerts(cost: DataFrame, as_of: datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Sharp increase and absolute limit of the last full day, from one pass over the cost."""
    limits = settings.cost
    increase = F.struct(
        F.lit("cost_increase").alias("alert_type"),
        F.lit("warning").alias("severity"),
        _text(
            COST_INCREASE,
            _cents("percent_change"),
            _cents("previous_day_cost"),
            _cents("daily_cost"),
        ).alias("message"),
        _details(
            date="usage_date",
            current_cost="daily_cost",
            previous_cost="previous_day_cost",
            change_percent="percent_change",
        ).alias("details"),
    )
    absolute = F.struct(
        F.lit("cost_threshold").alias("alert_type"),
        F.lit("critical").alias("severity"),
        _text(COST_LIMIT, _cents("daily_cost"), F.lit(f"{limits.absolute_cost:.0f}")).alias(
            "message"
        ),
        _details(date="usage_date", cost="daily_cost").alias("details"),
    )
    raised = F.array_compact(
        F.array(
            F.when(F.col("percent_change") > limits.daily_increase_percent, increase),
            F.when(F.col("daily_cost") > limits.absolute_cost, absolute),
        )
    )
    return (
        _last_full_day(cost, as_of)
        .select(F.inline(raised))
        .withColumn("triggered_at", ts_lit(as_of))
    )


def cost_increase(cost: DataFrame, as_of: datetime, settings: Settings = DEFAULTS) -> DataFrame:
    return cost_alerts(cost, as_of, settings).filter("alert_type = 'cost_increase'")


def cost_absolute(cost: DataFrame, as_of: datetime, settings: Settings = DEFAULTS) -> DataFrame:
    return cost_alerts(cost, as_of, settings).filter("alert_type = 'cost_threshold'")


def job_failure_rate(
    runs: DataFrame, as_of: datetime, settings: Settings = DEFAULTS
) -> DataFrame:
    # The rate is NULL, and the filter false, when nothing ran.
    hit = jobs.failure_rate(runs, as_of).filter(
        F.col("failure_rate") > settings.jobs.failure_rate_percent
    )
    message = _text(FAILURE_RATE, _cents("failure_rate"), "failed_runs", "total_runs")
    details = _details(
        total_runs="total_runs", failed_runs="failed_runs", failure_rate="failure_rate"
    )
    return _alerts(hit, "job_failure_rate", "critical", message, details, as_of)


def quality_score(
    metrics: DataFrame, as_of: datetime, settings: Settings = DEFAULTS, hours: int = 1
) -> DataFrame:
    limits = settings.quality
    hit = (
        metrics.filter(since("timestamp", as_of, hours=hours))
        .groupBy("pipeline_name", "dataset_name")
        .agg(quality.score().alias("quality_score"), F.sum("failed_records").alias("failed_records"))
        .filter(F.col("quality_score") < limits.score)
    )
    message = _text(LOW_QUALITY, "dataset_name", _cents("quality_score"), "failed_records")
    severity = F.when(F.col("quality_score") > limits.critical_score, "warning").otherwise(
        "critical"
    )
    details = _details(
        pipeline="pipeline_name",
        dataset="dataset_name",
        quality_score="quality_score",
        failed_records="failed_records",
    )
    return _alerts(hit, "data_quality", severity, message, details, as_of)


def stale_pipelines(
    health: DataFrame, as_of: datetime, settings: Settings = DEFAULTS
) -> DataFrame:
    limits = settings.freshness
    hit = event_log.freshness(health, as_of, limits, listed_hours=limits.warning_hours)
    hours = F.col("hours_since_last_run")
    last_run = F.date_format("last_run_time", "yyyy-MM-dd HH:mm:ss")
    message = _text(STALE, "pipeline_name", hours, last_run)
    severity = F.when(hours > limits.critical_hours, "critical").otherwise("warning")
    details = _details(
        pipeline="pipeline_name", last_run="last_run_time", hours_stale="hours_since_last_run"
    )
    return _alerts(hit, "pipeline_freshness", severity, message, details, as_of)


def failed_records(
    metrics: DataFrame, as_of: datetime, settings: Settings = DEFAULTS, hours: int = 24
) -> DataFrame:
    hit = (
        metrics.filter(since("timestamp", as_of, hours=hours))
        .groupBy("dataset_name")
        .agg(F.sum("failed_records").alias("failed_records"))
        .filter(F.col("failed_records") > settings.quality.failed_records)
    )
    message = _text("%s records failed in %s", "failed_records", "dataset_name")
    details = _details(dataset="dataset_name", failed_records="failed_records")
    return _alerts(hit, "failed_records", "warning", message, details, as_of)


def query_performance(
    history: DataFrame, as_of: datetime, settings: Settings = DEFAULTS, hours: int = 24
) -> DataFrame:
    """One alert for slow queries and one for a high error rate."""
    figures = queries.performance(history, as_of, hours, settings.queries)
    slow = _alerts(
        figures.filter("slow_queries > 0"),
        "slow_queries",
        "warning",
        _text(
            f"%s queries took more than {settings.queries.slow_seconds} seconds", "slow_queries"
        ),
        _details(slow_queries="slow_queries", total_queries="total_queries"),
        as_of,
    )
    errors = _alerts(
        figures.filter(F.col("error_rate") > settings.queries.error_rate_percent),
        "query_error_rate",
        "warning",
        _text("Query error rate is %s%%", _cents("error_rate")),
        _details(failed_queries="failed_queries", total_queries="total_queries"),
        as_of,
    )
    return slow.unionByName(errors)


def sla(runs: DataFrame, as_of: datetime, settings: Settings = DEFAULTS) -> DataFrame:
    """Runs of the lookback above the longest allowed duration. A run without an end is
    still running and has lasted until ``as_of``."""
    limit = settings.jobs.max_duration_minutes
    recent = runs.filter(since("start_time", as_of, days=settings.lookback_days))
    so_far = seconds_between("start_time", F.coalesce("end_time", ts_lit(as_of)))
    recent = recent.withColumn("duration_seconds", F.coalesce("duration_seconds", so_far))
    hit = jobs.sla_violations(recent, limit)
    minutes = F.floor(F.col("duration_seconds") / 60)
    message = _text(f"%s run %s took %s minutes (limit {limit})", "job_name", "run_id", minutes)
    details = _details(job="job_name", run="run_id", duration_seconds="duration_seconds")
    return _alerts(hit, "sla_violation", "critical", message, details, as_of)


def consecutive_failures(
    runs: DataFrame, as_of: datetime, settings: Settings = DEFAULTS
) -> DataFrame:
    hit = jobs.failure_streaks(
        runs.filter(since("start_time", as_of, days=settings.lookback_days)),
        settings.jobs.consecutive_failures,
    )
    message = _text("%s failed %s times in a row", "job_name", "consecutive_failures")
    details = _details(
        job="job_name", failures="consecutive_failures", last_failure="last_failure"
    )
    return _alerts(hit, "consecutive_failures", "critical", message, details, as_of)


def all_alerts(
    cost: DataFrame,
    runs: DataFrame,
    metrics: DataFrame,
    health: DataFrame,
    as_of: datetime,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Every standard check in one typed DataFrame."""
    checks = [
        cost_alerts(cost, as_of, settings),
        job_failure_rate(runs, as_of, settings),
        quality_score(metrics, as_of, settings),
        stale_pipelines(health, as_of, settings),
    ]
    return reduce(DataFrame.unionByName, checks)


def by_severity(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count("*").alias("alerts"))


def history_rows(alerts: DataFrame, channels: list[str] | None = None) -> DataFrame:
    """Alerts as active history rows; equal alerts get equal ids, so appends can repeat."""
    stamp = F.date_format("triggered_at", "yyyyMMddHHmmssSSSSSS")
    digest = F.substring(F.sha2("message", 256), 1, 8)
    noted = F.array(*[F.lit(c) for c in channels or []]).cast("array<string>")
    return alerts.select(
        F.concat_ws("_", "alert_type", stamp, digest).alias("alert_id"),
        "alert_type",
        "severity",
        "message",
        "details",
        "triggered_at",
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit("active").alias("status"),
        noted.alias("notified_channels"),
    ).select(*schemas.ALERT_HISTORY.fieldNames())


def recent(history: DataFrame, as_of: datetime, days: int = 7, limit: int = 50) -> DataFrame:
    return (
        history.filter(since("triggered_at", as_of, days=days))
        .orderBy(F.desc("triggered_at"), "alert_id")
        .limit(limit)
        .select("alert_id", "alert_type", "severity", "message", "triggered_at", "status")
    )


# Details that say what an alert is about; figures and times differ from run to run.
SUBJECT = ("pipeline", "pipeline_name", "dataset", "dataset_name", "job", "run")


def subject() -> Column:
    """What an alert is about, from its details; alerts of the whole workspace share one."""
    return F.concat_ws("/", *[F.try_element_at("details", F.lit(name)) for name in SUBJECT])


def resolved(history: DataFrame, current: DataFrame, as_of: datetime) -> DataFrame:
    """History after a check run: active alerts whose type no longer fires for their subject
    are resolved."""
    firing = current.select("alert_type", subject().alias("_subject")).distinct()
    firing = firing.withColumn("_firing", F.lit(True))
    over = (F.col("status") == "active") & F.col("_firing").isNull()
    return (
        history.withColumn("_subject", subject())
        .join(firing, ["alert_type", "_subject"], "left")
        .withColumns(
            {
                "resolved_at": F.when(over, ts_lit(as_of)).otherwise(F.col("resolved_at")),
                "status": F.when(over, "resolved").otherwise(F.col("status")),
            }
        )
        .select(*history.columns)
    )


# Seconds walked in one step of the cooldown. A subject has one candidate per second, so a
# task holds at most this many numbers (21 MB), however many alerts were raised.
WALK_SECONDS = 30 * 86_400

_TOPIC = ["alert_type", "subject"]


def _cooled(
    candidates: DataFrame,
    cooldown_seconds: int,
    walk_seconds: int = WALK_SECONDS,
    before: DataFrame | None = None,
) -> DataFrame:
    """Per alert type and subject, the seconds in which an alert may be sent.

    Each send blocks the following ``cooldown_seconds``; the next send is the first
    candidate after that. ``candidates`` holds one row per (type, subject, second). Stretches
    of ``walk_seconds`` are walked one after the other; from one to the next only the last
    send is carried. ``before`` holds the last send (``last``) of earlier runs.
    """
    candidates = stored(candidates, "candidates")
    span = candidates.agg(F.min("second").alias("lo"), F.max("second").alias("hi")).first()
    if span.lo is None:
        return candidates
    free = F.lit(span.lo - cooldown_seconds).cast("bigint")

    def step(acc: Column, second: Column) -> Column:
        send = F.struct(second.alias("last"), F.concat(acc["sent"], F.array(second)).alias("sent"))
        return F.when(second >= acc["last"] + F.lit(cooldown_seconds), send).otherwise(acc)

    nothing = F.array().cast("array<bigint>")
    last_sent, walks = before, []
    for start in range(span.lo, span.hi + 1, walk_seconds):
        stretch = candidates.filter(F.col("second").between(start, start + walk_seconds - 1))
        lists = stretch.groupBy(*_TOPIC).agg(
            F.sort_array(F.collect_list("second")).alias("seconds")
        )
        if last_sent is None:
            entry = lists.withColumn("last", free)
        else:
            entry = lists.join(last_sent, _TOPIC, "full_outer")
        begin = F.struct(F.coalesce("last", free).alias("last"), nothing.alias("sent"))
        walk = F.aggregate(F.coalesce("seconds", nothing), begin, step)
        walked = cut(entry.select(*_TOPIC, walk.alias("walk")).select(*_TOPIC, "walk.*"))
        last_sent = walked.select(*_TOPIC, "last")
        walks.append(walked.select(*_TOPIC, F.explode("sent").alias("second")))
    return reduce(DataFrame.unionByName, walks)


# Parts of an hour that are ranked apart before the hour is.
HOUR_PARTS = 64


def _first_of_hour(free: DataFrame, limit: int, hours: DataFrame | None) -> DataFrame:
    """The first ``limit`` alerts of each hour, fewer where ``hours`` says that ``_already``
    some were sent. Each part of an hour keeps its first ``limit``, so one task ranks at most
    ``HOUR_PARTS * limit`` alerts of an hour, however many subjects raised one."""
    key = [*_TOPIC, "second"]
    order = ["second", "alert_type", "_first.alert_id"]
    ranked = free.withColumns(
        {
            "hour": F.floor(F.col("second") / 3600),
            "_part": F.pmod(F.xxhash64(*key), F.lit(HOUR_PARTS)),
        }
    )
    for group in (["hour", "_part"], ["hour"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        ranked = ranked.withColumn("_place", place).filter(F.col("_place") <= limit)
    if hours is not None:
        ranked = ranked.join(hours, "hour", "left").filter(
            F.col("_place") + F.coalesce("_already", F.lit(0)) <= limit
        )
    return ranked.select(*key, F.lit(True).alias("_allowed"))


def outcomes(
    alerts: DataFrame,
    delivery: Delivery = DEFAULTS.delivery,
    walk_seconds: int = WALK_SECONDS,
    sent: DataFrame | None = None,
) -> DataFrame:
    """What becomes of every critical alert: ``sent``, ``merged`` (into another alert of its
    type, subject and second), ``cooled_down`` or ``over_limit``.

    ``sent`` are alerts sent by earlier runs (alert_type, subject, triggered_at). They block
    their topics for the cooldown and count for the hourly limit.
    """
    # Seconds since 1970 of the zone-less timestamp.
    second = F.unix_timestamp("triggered_at")
    critical = alerts.filter(F.col("severity") == "critical").select(
        *_TOPIC[:1], subject().alias("subject"), second.alias("second"), "triggered_at",
        "alert_id", "message",
    )
    spoken = critical.groupBy(*_TOPIC, "second").agg(
        F.min(F.struct("triggered_at", "alert_id")).alias("_first"),
        F.count("*").alias("merged_alerts"),
    )
    before = hours = None
    if sent is not None:
        past = sent.select(*_TOPIC, second.alias("second"))
        before = past.groupBy(*_TOPIC).agg(F.max("second").alias("last"))
        hours = past.groupBy(F.floor(F.col("second") / 3600).alias("hour")).agg(
            F.count("*").alias("_already")
        )
    free = _cooled(
        spoken.select(*_TOPIC, "second"), delivery.cooldown_minutes * 60, walk_seconds, before
    )
    free = stored(free.join(spoken, [*_TOPIC, "second"]), "free")
    allowed = _first_of_hour(free, delivery.max_per_hour, hours)
    outcome = (
        F.when(F.col("_free").isNull(), "cooled_down")
        .when(F.col("_allowed").isNull(), "over_limit")
        .when(F.col("alert_id") == F.col("_first.alert_id"), "sent")
        .otherwise("merged")
    )
    return (
        critical.join(spoken, [*_TOPIC, "second"])
        .join(free.select(*_TOPIC, "second", F.lit(True).alias("_free")), [*_TOPIC, "second"], "left")
        .join(allowed, [*_TOPIC, "second"], "left")
        .select(
            "alert_id", *_TOPIC, "message", "triggered_at", "merged_alerts",
            outcome.alias("outcome"),
        )
    )


def outbox(
    alerts: DataFrame,
    delivery: Delivery = DEFAULTS.delivery,
    walk_seconds: int = WALK_SECONDS,
    sent: DataFrame | None = None,
) -> DataFrame:
    """Notifications to send: the alerts with outcome ``sent``, once per enabled channel."""
    channels = F.array(*[F.lit(c.name) for c in delivery.channels if c.enabled])
    chosen = outcomes(alerts, delivery, walk_seconds, sent).filter("outcome = 'sent'")
    return chosen.drop("outcome").withColumn(
        "channel", F.explode(channels.cast("array<string>"))
    )


def notifications(alerts: DataFrame, template_of: dict[str, str]) -> DataFrame:
    """Subject and priority of each alert from the template of its type."""
    name = F.lit(None).cast("string")
    for kind, template in template_of.items():
        name = F.when(F.col("alert_type") == kind, F.lit(template)).otherwise(name)
    spark = alerts.sparkSession
    templates = spark.createDataFrame(
        TEMPLATES, "template string, subject_pattern string, priority string"
    )
    filled = F.col("subject_pattern")
    for field in ("pipeline_name", "dataset_name"):
        filled = F.replace(
            filled,
            F.lit("{" + field + "}"),
            F.coalesce(F.try_element_at("details", F.lit(field)), F.lit("?")),
        )
    # Four fixed templates: the broadcast side does not grow.
    return (
        alerts.withColumn("template", name)
        .join(F.broadcast(templates), "template")
        .select(
            "alert_type",
            "severity",
            "priority",
            filled.alias("subject"),
            F.concat(F.lit("["), F.upper("alert_type"), F.lit("] "), F.col("message")).alias(
                "body"
            ),
        )
    )
