"""Alerts: checks, history, routing, delivery; sinks and retention."""

from datetime import datetime, timedelta

from catalogue import inputs
from catalogue.base_sql import COST_DAY, EVENTS_AT, QUALITY_AT, pct, r2
from catalogue.registry import register
from pyspark.sql import functions as F
from vigil.operators import alerts
from vigil.plans.scratch import scratch_path
from vigil.settings import DEFAULTS
from vigil.sources import collectors, sinks, testbed
from vigil.sources.testbed import COST_AS_OF, EVENTS_AS_OF, QUALITY_AS_OF

LATER = datetime(2024, 2, 1, 13, 30)
LATER_SQL = "TIMESTAMP '2024-02-01 13:30:00'"


def _plain(df):
    return df.select("alert_type", "severity", "message")


def _money(cents4: str) -> str:
    """Ten-thousandths rounded half up to two printed digits."""
    return f"printf('%.2f', {r2(cents4, '10000')})"


def _last_day() -> str:
    return f"""SELECT c, p, {pct('c - p', 'p')} AS change FROM (
        SELECT usage_date, c, lag(c) OVER (ORDER BY usage_date) AS p FROM (
          SELECT usage_date, sum(cost4) AS c FROM cost
          WHERE usage_date >= {COST_DAY} - 7 AND usage_date <= {COST_DAY} GROUP BY usage_date))
        WHERE usage_date = {COST_DAY} - 1 AND p IS NOT NULL"""


_INCREASE = f"""SELECT 'cost_increase' AS alert_type, 'warning' AS severity,
    'Daily cost increased by ' || printf('%.2f', change) || '% ($' || {_money('p')} || ' → $'
      || {_money('c')} || ')' AS message FROM ({_last_day()}) WHERE change > 20"""
_ABSOLUTE = f"""SELECT 'cost_threshold' AS alert_type, 'critical' AS severity,
    'Daily cost $' || {_money('c')} || ' exceeds threshold $1000' AS message
    FROM ({_last_day()}) WHERE c > 10000000"""


# A limit every change exceeds, so that the alert text is compared on all tables.
@register("alert_cost_increase", _INCREASE.replace("change > 20", "change > -100"))
def _(spark, d):
    always = DEFAULTS.overlay({"cost": {"daily_increase_percent": -100.0}})
    return _plain(alerts.cost_increase(inputs.cost(spark, d), COST_AS_OF, always))


@register("alert_cost_absolute", _ABSOLUTE)
def _(spark, d):
    return _plain(alerts.cost_absolute(inputs.cost(spark, d), COST_AS_OF))


_RATE = f"""SELECT count(*) AS n, count(*) FILTER (bad) AS f,
    {pct('count(*) FILTER (bad)', 'count(*)')} AS rate FROM jobs_cost
    WHERE start_time >= {EVENTS_AT} - INTERVAL 1 HOUR"""
_FAILING = f"""SELECT 'job_failure_rate' AS alert_type, 'critical' AS severity,
    'Job failure rate is ' || printf('%.2f', rate) || '% (' || f || '/' || n
      || ' jobs failed in last hour)' AS message FROM ({_RATE}) WHERE rate > 10"""


@register("alert_job_failure_rate", _FAILING)
def _(spark, d):
    return _plain(alerts.job_failure_rate(inputs.jobs(spark, d), EVENTS_AS_OF))


_SCORED = f"""SELECT dataset_name, sum(failed) AS f,
    {pct('sum(passed)', 'sum(passed) + sum(failed)')} AS score FROM qm
    WHERE moment >= {QUALITY_AT} - INTERVAL 1 HOUR GROUP BY pipeline_name, dataset_name"""
_QUALITY = f"""SELECT 'data_quality' AS alert_type,
    CASE WHEN score > 90 THEN 'warning' ELSE 'critical' END AS severity,
    'Data quality score for ' || dataset_name || ' is ' || printf('%.2f', score) || '% (' || f
      || ' records failed)' AS message FROM ({_SCORED}) WHERE score < 95"""


@register("alert_quality_score", _QUALITY)
def _(spark, d):
    return _plain(alerts.quality_score(inputs.quality(spark, d), QUALITY_AS_OF))


def _stale(at: str, source: str = "health") -> str:
    return f"""SELECT 'pipeline_freshness' AS alert_type,
        CASE WHEN h > 48 THEN 'critical' ELSE 'warning' END AS severity,
        'Pipeline ' || pipeline_name || ' hasn''t run in ' || h || ' hours (last run: '
          || strftime(t, '%Y-%m-%d %H:%M:%S') || ')' AS message
        FROM (SELECT pipeline_name, t, date_sub('hour', t, {at}) AS h FROM (
          SELECT pipeline_name, max(start_time) AS t FROM {source} GROUP BY pipeline_name))
        WHERE h > 24"""


@register("alert_freshness", _stale(LATER_SQL))
def _(spark, d):
    return _plain(alerts.stale_pipelines(inputs.health(spark, d), LATER))


# All checks at one moment, with the sales tables moved into the era of the events.
_ALL = " UNION ALL ".join((_INCREASE, _ABSOLUTE, _FAILING, _stale(EVENTS_AT)))


def _all(spark, d):
    return alerts.all_alerts(
        inputs.shifted_cost(spark, d),
        inputs.jobs(spark, d),
        inputs.shifted_quality(spark, d),
        inputs.health(spark, d),
        EVENTS_AS_OF,
    )


@register("alerts_all", _ALL)
def _(spark, d):
    return _plain(_all(spark, d))


@register(
    "alert_history",
    f"""SELECT alert_type, severity, message, 'active' AS status, 'email' AS notified_channels,
        {EVENTS_AT} AS triggered_at FROM ({_ALL})""",
)
def _(spark, d):
    """Alerts as stored history; writing them twice stores them once."""
    path = scratch_path(spark, "alert_history")
    rows = alerts.history_rows(_all(spark, d), ["email"])
    for _ in range(2):
        today = EVENTS_AS_OF.date()
        sinks.append_new(
            rows, path, "alert_history", ["alert_id", "triggered_at"], (today, today)
        )
    return spark.read.parquet(path).select(
        "alert_type", "severity", "message", "status", "notified_channels", "triggered_at"
    )


@register("alerts_by_severity", f"SELECT severity, count(*) AS alerts FROM ({_ALL}) GROUP BY 1")
def _(spark, d):
    return alerts.by_severity(_all(spark, d))


@register(
    "alert_failed_records",
    f"""SELECT 'failed_records' AS alert_type, 'warning' AS severity,
        f || ' records failed in ' || dataset_name AS message FROM (
          SELECT dataset_name, sum(failed) AS f FROM qm
          WHERE moment >= {QUALITY_AT} - INTERVAL 8760 HOURS GROUP BY 1) WHERE f > 1000""",
)
def _(spark, d):
    return _plain(alerts.failed_records(inputs.quality(spark, d), QUALITY_AS_OF, hours=8760))


_PERFORMANCE = f"""SELECT count(*) FILTER (ms > 60000) AS slow,
    {pct('count(err)', 'count(*)')} AS rate FROM qry
    WHERE moment >= {EVENTS_AT} - INTERVAL 24 HOURS"""


@register(
    "alert_query_performance",
    f"""SELECT 'slow_queries' AS alert_type, 'warning' AS severity,
        slow || ' queries took more than 60 seconds' AS message FROM ({_PERFORMANCE})
        WHERE slow > 0
        UNION ALL SELECT 'query_error_rate', 'warning',
        'Query error rate is ' || printf('%.2f', rate) || '%' FROM ({_PERFORMANCE})
        WHERE rate > 5""",
)
def _(spark, d):
    return _plain(alerts.query_performance(inputs.queries(spark, d), EVENTS_AS_OF))


@register(
    "alert_sla_violation",
    f"""SELECT 'sla_violation' AS alert_type, 'critical' AS severity,
        job_name || ' run ' || run_id || ' took ' || s // 60 || ' minutes (limit 60)' AS message
        FROM (SELECT *, coalesce(secs, CAST(epoch({EVENTS_AT}) - epoch(date_trunc('second',
          start_time)) AS BIGINT)) AS s FROM jobs_cost
          WHERE start_time >= {EVENTS_AT} - INTERVAL 7 DAYS) WHERE s > 3600""",
)
def _(spark, d):
    strict = DEFAULTS.overlay({"jobs": {"max_duration_minutes": 60}})
    return _plain(alerts.sla(inputs.jobs(spark, d), EVENTS_AS_OF, strict))


@register(
    "alert_consecutive_failures",
    f"""WITH n AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER
          (PARTITION BY job_id ORDER BY start_time, run_id ROWS UNBOUNDED PRECEDING) AS island
          FROM jobs_cost WHERE start_time >= {EVENTS_AT} - INTERVAL 7 DAYS)
        SELECT 'consecutive_failures' AS alert_type, 'critical' AS severity,
        job_name || ' failed ' || count(*) || ' times in a row' AS message
        FROM n WHERE bad GROUP BY job_id, job_name, island HAVING count(*) >= 3""",
)
def _(spark, d):
    return _plain(alerts.consecutive_failures(inputs.jobs(spark, d), EVENTS_AS_OF))


@register(
    "recent_alerts",
    f"""SELECT alert_id, alert_type, severity, message, triggered_at, 'active' AS status
        FROM raised WHERE triggered_at >= {EVENTS_AT} - INTERVAL 7 DAYS
        AND triggered_at <= {EVENTS_AT} ORDER BY triggered_at DESC, alert_id LIMIT 50""",
)
def _(spark, d):
    return alerts.recent(testbed.alert_log(spark, d), EVENTS_AS_OF)


@register(
    "alerts_resolved",
    f"""SELECT alert_id, CASE WHEN alert_type IN ('job_failure_1', 'job_failure_2')
        THEN 'active' ELSE 'resolved' END AS status,
        CASE WHEN alert_type NOT IN ('job_failure_1', 'job_failure_2') THEN {EVENTS_AT} END
          AS resolved_at FROM raised""",
)
def _(spark, d):
    log = testbed.alert_log(spark, d)
    firing = log.filter(F.col("alert_type").isin("job_failure_1", "job_failure_2"))
    return alerts.resolved(log, firing, EVENTS_AS_OF).select("alert_id", "status", "resolved_at")


_OUTCOMES = """c AS (SELECT alert_type, pipeline_name || '/' || dataset_name AS subject,
          CAST(epoch(date_trunc('second', triggered_at)) AS BIGINT) AS sec,
          arg_min(alert_id, (triggered_at, alert_id)) AS alert_id, count(*) AS merged
          FROM raised WHERE severity = 'critical' GROUP BY 1, 2, 3),
        chain AS (SELECT alert_type, subject, min(sec) AS sec FROM c GROUP BY 1, 2
          UNION ALL SELECT ch.alert_type, ch.subject,
            (SELECT min(c.sec) FROM c WHERE c.alert_type = ch.alert_type
               AND c.subject = ch.subject AND c.sec >= ch.sec + 3600) AS sec
          FROM chain ch WHERE ch.sec IS NOT NULL),
        free AS (SELECT c.*, row_number() OVER (PARTITION BY c.sec // 3600
            ORDER BY c.sec, c.alert_type, c.alert_id) AS place
          FROM chain JOIN c USING (alert_type, subject, sec)),
        fate AS (SELECT r.alert_id, r.alert_type, c.subject, r.message, r.triggered_at,
          c.merged AS merged_alerts,
          CASE WHEN place IS NULL THEN 'cooled_down' WHEN place > 10 THEN 'over_limit'
               WHEN r.alert_id = c.alert_id THEN 'sent' ELSE 'merged' END AS outcome
          FROM raised r JOIN c ON c.alert_type = r.alert_type
            AND c.subject = r.pipeline_name || '/' || r.dataset_name
            AND c.sec = CAST(epoch(date_trunc('second', r.triggered_at)) AS BIGINT)
          LEFT JOIN free ON free.alert_type = c.alert_type AND free.subject = c.subject
            AND free.sec = c.sec
          WHERE r.severity = 'critical')"""


@register(
    "alert_outbox",
    f"""WITH RECURSIVE {_OUTCOMES} SELECT alert_id, alert_type, subject, message, triggered_at,
        merged_alerts, 'email' AS channel FROM fate WHERE outcome = 'sent'""",
)
def _(spark, d):
    return alerts.outbox(testbed.alert_log(spark, d))


@register("alert_outcomes", f"WITH RECURSIVE {_OUTCOMES} SELECT * FROM fate")
def _(spark, d):
    return alerts.outcomes(testbed.alert_log(spark, d))


@register(
    "alert_notifications",
    """SELECT alert_type, severity,
        CASE WHEN alert_type = 'job_failure_0' THEN 'high' ELSE 'medium' END AS priority,
        CASE WHEN alert_type = 'job_failure_0' THEN '[ALERT] Pipeline Failure: ' || pipeline_name
          ELSE '[WARNING] Data Quality Alert: ' || dataset_name END AS subject,
        '[' || upper(alert_type) || '] ' || message AS body
        FROM raised WHERE alert_type IN ('job_failure_0', 'job_failure_3')""",
)
def _(spark, d):
    templates = {"job_failure_0": "pipeline_failure", "job_failure_3": "quality_degradation"}
    return alerts.notifications(testbed.alert_log(spark, d), templates)


# ---------------------------------------------------------------- sinks


@register(
    "sink_append_new",
    f"""SELECT event_id, moment AS timestamp, level, CAST(CAST(moment AS DATE) AS VARCHAR)
        AS event_date FROM log_all
        WHERE moment >= {EVENTS_AT} - INTERVAL 9 DAYS AND moment <= {EVENTS_AT}""",
)
def _(spark, d):
    """Two collections whose lookbacks overlap store every event once."""
    path = scratch_path(spark, "event_logs")
    log = testbed.event_log(spark, d)
    for back in (2, 0):
        end = EVENTS_AS_OF - timedelta(days=back)
        span = ((end - timedelta(days=7)).date(), end.date())
        batch = collectors.event_logs(log, end, 7)
        sinks.append_new(batch, path, "event_logs", ["event_id", "timestamp"], span)
    return spark.read.parquet(path).select("event_id", "timestamp", "level", "event_date")


@register(
    "sink_overwrite_days",
    f"""SELECT CAST(usage_date AS VARCHAR) AS usage_date, count(*) AS n,
        CAST(sum(cost4) AS DOUBLE) / 10000 AS cost FROM cost
        WHERE usage_date >= {COST_DAY} - 10 AND usage_date <= {COST_DAY} GROUP BY usage_date""",
)
def _(spark, d):
    """The second collection replaces its own days and keeps the older ones."""
    path = scratch_path(spark, "cost_metrics")
    usage = testbed.billing_usage(spark, d)
    for back in (3, 0):
        batch = collectors.cost_metrics(usage, COST_AS_OF - timedelta(days=back), 7)
        sinks.overwrite_days(batch, path, "cost_metrics", sort=["sku_name"])
    stored = spark.read.parquet(path)
    return stored.groupBy("usage_date").agg(F.count("*").alias("n"), F.sum("cost").alias("cost"))


@register(
    "retention_trim",
    """SELECT run_id, start_time FROM jobs_all
        WHERE start_time >= TIMESTAMP '2024-01-10 00:00:00'""",
)
def _(spark, d):
    runs = testbed.job_runs(spark, d)
    return sinks.retained(runs, "start_time", EVENTS_AS_OF, 20).select("run_id", "start_time")
