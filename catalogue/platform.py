"""Collectors, cost, job, cluster and query reports."""

from catalogue import inputs
from catalogue.base_sql import COST_DAY, EVENTS_AT, pct, r2
from catalogue.registry import register
from vigil.operators import clusters, costs, jobs, queries
from vigil.sources import collectors, testbed
from vigil.sources.testbed import COST_AS_OF, EVENTS_AS_OF

COST_NOW = f"usage_date <= {COST_DAY}"


def _cost_since(days: int) -> str:
    return f"usage_date >= {COST_DAY} - {days} AND usage_date <= {COST_DAY}"


def _since(col: str, amount: str) -> str:
    return f"{col} >= {EVENTS_AT} - INTERVAL {amount} AND {col} <= {EVENTS_AT}"


COST4 = "CAST(sum(cost4) AS DOUBLE) / 10000"
USAGE = "CAST(sum(usage_quantity) AS DOUBLE)"


@register(
    "collect_cost_metrics",
    f"""SELECT CAST(usage_date AS VARCHAR) AS usage_date, 'w0' AS workspace_id, sku_name, cloud,
        'DBU' AS usage_unit, CAST(usage_quantity AS DOUBLE) AS usage_quantity,
        CAST(list_price AS DOUBLE) AS list_price, CAST(cost4 AS DOUBLE) / 10000 AS cost,
        billing_origin_product, TIMESTAMP '2001-06-30 00:00:00' AS ingestion_timestamp
        FROM cost WHERE {_cost_since(7)}""",
)
def _(spark, d):
    return inputs.cost(spark, d, 7, product=True)


@register(
    "collect_job_metrics",
    f"""SELECT job_id, job_name, run_id, 'run_' || run_id AS run_name, 'w0' AS workspace_id,
        start_time, end_time, secs AS duration_seconds, result_state, 'NOTEBOOK' AS task_type,
        'cluster_' || user_id % 8 AS cluster_id, CAST(dbu6 AS DOUBLE) / 1000000 AS total_dbu_usage,
        CAST(cost6 AS DOUBLE) / 1000000 AS total_cost, error_message,
        {EVENTS_AT} AS ingestion_timestamp
        FROM jobs_cost WHERE {_since('start_time', '7 DAYS')}""",
)
def _(spark, d):
    return inputs.jobs(spark, d, 7)


@register(
    "collect_cluster_metrics",
    f"""SELECT moment AS timestamp, 'w0' AS workspace_id, 'cluster_' || cluster AS cluster_id,
        cluster_name, 'JOB' AS cluster_source, node AS driver_node_type, node AS worker_node_type,
        0 AS autoscale_min_workers, 8 AS autoscale_max_workers, workers AS num_workers, state,
        uptime AS uptime_seconds, rate10 / 10.0::DOUBLE AS dbu_rate,
        {EVENTS_AT} AS ingestion_timestamp
        FROM clu WHERE {_since('moment', '7 DAYS')}""",
)
def _(spark, d):
    return inputs.clusters(spark, d, 7)


@register(
    "collect_query_metrics",
    f"""SELECT query_id, 'w0' AS workspace_id, query_text, moment AS query_start_time,
        moment + to_milliseconds(ms) AS query_end_time, ms AS duration_ms, rows_produced,
        bytes AS bytes_scanned, usr AS executed_as_user_name, usr AS executed_by_user_name,
        warehouse_id, err AS error_message, {EVENTS_AT} AS ingestion_timestamp
        FROM qry WHERE {_since('moment', '7 DAYS')}""",
)
def _(spark, d):
    return inputs.queries(spark, d, 7)


@register(
    "collect_table_lineage",
    f"""SELECT src AS source_table_full_name, src_cat AS source_table_catalog,
        src_sch AS source_table_schema, src_t AS source_table_name,
        dst AS target_table_full_name, dst_cat AS target_table_catalog,
        dst_sch AS target_table_schema, dst_t AS target_table_name, source_type,
        moment AS event_time, entity_id, notebook_id, job_id, run_id,
        {EVENTS_AT} AS ingestion_timestamp
        FROM lin WHERE {_since('moment', '30 DAYS')}""",
)
def _(spark, d):
    return collectors.table_lineage(testbed.table_lineage(spark, d), EVENTS_AS_OF)


@register(
    "collect_column_lineage",
    f"""SELECT src AS source_table_full_name, src_col AS source_column_name,
        dst AS target_table_full_name, dst_col AS target_column_name, moment AS event_time,
        source_type, entity_id FROM lin WHERE {_since('moment', '30 DAYS')}""",
)
def _(spark, d):
    return collectors.column_lineage(testbed.column_lineage(spark, d), EVENTS_AS_OF)


@register(
    "cost_by_date_sku",
    f"""SELECT CAST(usage_date AS VARCHAR) AS usage_date, sku_name, {COST4} AS total_cost,
        {USAGE} AS total_usage FROM cost WHERE {COST_NOW} GROUP BY usage_date, sku_name""",
)
def _(spark, d):
    return costs.by_date_and_sku(inputs.cost(spark, d))


@register(
    "daily_cost_by_cloud",
    f"""SELECT CAST(usage_date AS VARCHAR) AS usage_date, cloud, {COST4} AS total_cost,
        {USAGE} AS total_dbu_usage FROM cost WHERE {COST_NOW} GROUP BY usage_date, cloud""",
)
def _(spark, d):
    return costs.daily_by_cloud(inputs.cost(spark, d))


@register(
    "top_cost_drivers",
    f"""SELECT sku_name, billing_origin_product, {COST4} AS total_cost, {USAGE} AS total_usage,
        count(DISTINCT usage_date) AS days_active,
        {COST4} / count(DISTINCT usage_date) AS avg_daily_cost
        FROM cost WHERE {_cost_since(7)} GROUP BY sku_name, billing_origin_product
        ORDER BY sum(cost4) DESC, sku_name, billing_origin_product LIMIT 20""",
)
def _(spark, d):
    return costs.top_drivers(inputs.cost(spark, d, product=True), COST_AS_OF)


@register(
    "dash_daily_cost",
    f"""SELECT CAST(usage_date AS VARCHAR) AS usage_date, {COST4} AS total_cost,
        {USAGE} AS total_dbu_usage FROM cost WHERE {_cost_since(30)} GROUP BY usage_date""",
)
def _(spark, d):
    return costs.daily_trend(inputs.cost(spark, d), COST_AS_OF)


@register(
    "dash_cost_by_sku",
    f"""WITH g AS (SELECT sku_name, billing_origin_product, sum(cost4) AS c FROM cost
          WHERE usage_date >= DATE '2001-06-01' AND {COST_NOW} GROUP BY ALL)
        SELECT sku_name, billing_origin_product, CAST(c AS DOUBLE) / 10000 AS total_cost,
        {pct('c', '(SELECT sum(c) FROM g)')} AS cost_percentage
        FROM g ORDER BY c DESC, sku_name, billing_origin_product LIMIT 15""",
)
def _(spark, d):
    return costs.month_to_date_by_sku(inputs.cost(spark, d, product=True), COST_AS_OF)


@register(
    "dash_cost_anomaly",
    f"""WITH days AS (SELECT usage_date, sum(cost4) AS c FROM cost WHERE {_cost_since(14)}
          GROUP BY usage_date),
        pairs AS (SELECT usage_date, c, lag(c) OVER (ORDER BY usage_date) AS p FROM days)
        SELECT CAST(usage_date AS VARCHAR) AS usage_date, CAST(c AS DOUBLE) / 10000 AS daily_cost,
        CAST(p AS DOUBLE) / 10000 AS previous_day_cost, {pct('c - p', 'p')} AS percent_change,
        CASE WHEN c * 2 > p * 3 THEN 'ALERT: >50% increase'
             WHEN c * 4 > p * 5 THEN 'WARNING: >25% increase' ELSE 'NORMAL' END AS status
        FROM pairs WHERE p IS NOT NULL""",
)
def _(spark, d):
    return costs.anomalies(inputs.cost(spark, d), COST_AS_OF)


@register(
    "alert_cost_vs_average",
    f"""WITH days AS (SELECT usage_date, sum(cost4) AS c FROM cost
          WHERE usage_date >= {COST_DAY} - 14 AND usage_date < {COST_DAY} GROUP BY usage_date),
        f AS (SELECT sum(c) FILTER (usage_date = {COST_DAY} - 1) AS t, sum(c) AS s,
              count(*) AS n FROM days)
        SELECT CAST(t AS DOUBLE) / 10000 AS today_cost,
        CAST(s AS DOUBLE) / 10000 / n AS avg_daily_cost,
        {pct('t * n - s', 's')} AS percent_above_average,
        CASE WHEN t * n * 10 > s * 12 THEN 1 ELSE 0 END AS cost_alert FROM f""",
)
def _(spark, d):
    return costs.yesterday_against_average(inputs.cost(spark, d), COST_AS_OF)


AVG_SECS = "CAST(sum(secs) AS DOUBLE) / nullif(count(secs), 0)"
COST6 = "CAST(sum(cost6) AS DOUBLE) / 1000000"
DBU6 = "CAST(sum(dbu6) AS DOUBLE) / 1000000"


@register(
    "job_summary",
    f"""SELECT job_name, result_state, count(*) AS run_count, {AVG_SECS} AS avg_duration_seconds,
        {COST6} AS total_cost FROM jobs_cost GROUP BY job_name, result_state""",
)
def _(spark, d):
    return jobs.summary(inputs.jobs(spark, d))


@register(
    "job_state_analysis",
    f"""SELECT job_name, result_state, count(*) AS run_count, {AVG_SECS} AS avg_duration_seconds,
        max(secs) AS max_duration_seconds, {COST6} AS total_cost,
        max(start_time) AS last_run_time FROM jobs_cost
        WHERE {_since('start_time', '7 DAYS')} GROUP BY job_name, result_state""",
)
def _(spark, d):
    return jobs.by_state(inputs.jobs(spark, d), EVENTS_AS_OF)


@register(
    "most_expensive_jobs",
    f"""SELECT job_name, count(*) AS run_count, {COST6} AS total_cost,
        {COST6} / count(cost6) AS avg_cost_per_run, {AVG_SECS} AS avg_duration_seconds,
        {DBU6} AS total_dbu_usage FROM jobs_cost
        WHERE {_since('start_time', '7 DAYS')} AND NOT bad
        GROUP BY job_name ORDER BY sum(cost6) DESC, job_name LIMIT 20""",
)
def _(spark, d):
    return jobs.most_expensive(inputs.jobs(spark, d), EVENTS_AS_OF)


@register(
    "dash_top_jobs",
    f"""SELECT job_name, count(*) AS run_count, {COST6} AS total_cost,
        {COST6} / count(cost6) AS avg_cost_per_run, {AVG_SECS} / 3600 AS avg_duration_hours,
        {DBU6} AS total_dbu_usage FROM jobs_cost
        WHERE {_since('start_time', '7 DAYS')} AND NOT bad
        GROUP BY job_name ORDER BY sum(cost6) DESC, job_name LIMIT 10""",
)
def _(spark, d):
    return jobs.top_by_cost(inputs.jobs(spark, d), EVENTS_AS_OF)


@register(
    "dash_job_success_rate",
    f"""SELECT count(*) AS total_runs, count(*) FILTER (NOT bad) AS successful_runs,
        count(*) FILTER (bad) AS failed_runs,
        {pct('count(*) FILTER (NOT bad)', 'count(*)')} AS success_rate
        FROM jobs_cost WHERE {_since('start_time', '7 DAYS')}""",
)
def _(spark, d):
    return jobs.success_rate(inputs.jobs(spark, d), EVENTS_AS_OF)


_FAILING = f"""SELECT job_name, result_state, count(*) AS failure_count,
        max(start_time) AS last_failure,
        count(DISTINCT substring(error_message, 1, 100)) AS distinct_messages
        FROM jobs_cost WHERE {_since('start_time', '7 DAYS')} AND bad
        GROUP BY job_name, result_state
        ORDER BY failure_count DESC, job_name, result_state LIMIT 25"""


@register("dash_job_failures", _FAILING)
def _(spark, d):
    return jobs.failures_with_messages(inputs.jobs(spark, d), EVENTS_AS_OF).totals


@register(
    "dash_job_failure_messages",
    f"""SELECT DISTINCT job_name, result_state, substring(error_message, 1, 100) AS error_message
        FROM jobs_cost JOIN ({_FAILING}) USING (job_name, result_state)
        WHERE {_since('start_time', '7 DAYS')} AND bad AND error_message IS NOT NULL""",
)
def _(spark, d):
    return jobs.failures_with_messages(inputs.jobs(spark, d), EVENTS_AS_OF).values


@register(
    "dash_job_duration_trend",
    f"""SELECT CAST(CAST(start_time AS DATE) AS VARCHAR) AS execution_date, job_name,
        {AVG_SECS} / 60 AS avg_duration_minutes,
        CAST(min(secs) AS DOUBLE) / 60 AS min_duration_minutes,
        CAST(max(secs) AS DOUBLE) / 60 AS max_duration_minutes, count(*) AS run_count
        FROM jobs_cost
        WHERE {_since('start_time', '30 DAYS')} AND NOT bad AND secs IS NOT NULL
        GROUP BY CAST(start_time AS DATE), job_name HAVING count(*) >= 3""",
)
def _(spark, d):
    return jobs.duration_trend(inputs.jobs(spark, d), EVENTS_AS_OF)


@register(
    "failure_streaks",
    """WITH n AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER
          (PARTITION BY job_id ORDER BY start_time, run_id ROWS UNBOUNDED PRECEDING) AS island
          FROM jobs_cost)
        SELECT job_id, job_name, count(*) AS consecutive_failures,
        min(start_time) AS first_failure, max(start_time) AS last_failure
        FROM n WHERE bad GROUP BY job_id, job_name, island HAVING count(*) >= 3""",
)
def _(spark, d):
    return jobs.failure_streaks(inputs.jobs(spark, d))


@register(
    "alert_duration_regression",
    f"""WITH f AS (SELECT *, sum(secs) OVER w AS s, count(secs) OVER w AS n
          FROM jobs_cost WHERE secs IS NOT NULL
          WINDOW w AS (PARTITION BY job_id ORDER BY start_time, run_id
                       ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
        SELECT job_id, job_name, run_id, start_time, secs AS duration_seconds,
        CAST(s AS DOUBLE) / n AS baseline_seconds,
        {pct('secs * n - s', 's')} AS increase_percent
        FROM f WHERE n = 10 AND secs * n * 2 > s * 3""",
)
def _(spark, d):
    return jobs.duration_regressions(inputs.jobs(spark, d))


@register(
    "throughput_latency_backlog",
    """WITH m AS (SELECT start_time AS moment, 1 AS s, 0 AS e, secs AS w FROM jobs_cost
          UNION ALL SELECT end_time, 0, 1, NULL FROM jobs_cost WHERE end_time IS NOT NULL),
        g AS (SELECT date_trunc('day', moment) AS window_start, CAST(sum(s) AS BIGINT) AS started,
              CAST(sum(e) AS BIGINT) AS finished, CAST(sum(w) AS DOUBLE) / nullif(count(w), 0)
              AS avg_latency_seconds FROM m GROUP BY 1)
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, started, finished,
        avg_latency_seconds,
        CAST(sum(started - finished) OVER (ORDER BY window_start) AS BIGINT) AS backlog
        FROM g""",
)
def _(spark, d):
    return jobs.throughput(inputs.jobs(spark, d))


@register(
    "cluster_summary",
    """SELECT cluster_name, state, CAST(sum(workers) AS DOUBLE) / count(*) AS avg_workers,
        CAST(sum(uptime) AS BIGINT) AS total_uptime_seconds,
        CAST(sum(rate10) AS DOUBLE) / 10 / count(*) AS avg_dbu_rate
        FROM clu GROUP BY cluster_name, state""",
)
def _(spark, d):
    return clusters.summary(inputs.clusters(spark, d))


@register(
    "cluster_utilization_by_state",
    f"""SELECT cluster_name, state, CAST(sum(workers) AS DOUBLE) / count(*) AS avg_workers,
        max(workers) AS max_workers, CAST(sum(uptime) AS DOUBLE) / 3600 AS total_uptime_hours,
        CAST(sum(rate10) AS DOUBLE) / 10 / count(*) AS avg_dbu_rate,
        CAST(sum(uptime) AS DOUBLE) / 3600 * (CAST(sum(rate10) AS DOUBLE) / 10 / count(*))
          AS estimated_dbu_usage
        FROM clu WHERE {_since('moment', '7 DAYS')} GROUP BY cluster_name, state""",
)
def _(spark, d):
    return clusters.utilization_by_state(inputs.clusters(spark, d), EVENTS_AS_OF)


@register(
    "dash_cluster_utilization",
    f"""SELECT cluster_name, CAST(sum(workers) AS DOUBLE) / count(*) AS avg_workers,
        max(workers) AS max_workers, {r2('sum(uptime)', '3600')} AS total_uptime_hours,
        {r2('sum(uptime)::HUGEINT * sum(rate10)', '36000 * count(*)')} AS estimated_dbu_usage,
        {r2('sum(uptime)::HUGEINT * sum(rate10) * 15', '3600000 * count(*)')} AS estimated_cost
        FROM clu WHERE {_since('moment', '7 DAYS')} AND state IN ('RUNNING', 'RESIZING')
        GROUP BY cluster_name""",
)
def _(spark, d):
    return clusters.active_cost(inputs.clusters(spark, d), EVENTS_AS_OF)


@register(
    "idle_clusters",
    f"""WITH g AS (SELECT cluster_name, CAST(sum(uptime) AS BIGINT) AS total_uptime_seconds,
          CAST(sum(CASE WHEN workers = 0 THEN uptime ELSE 0 END) AS BIGINT) AS idle_seconds
          FROM clu GROUP BY cluster_name)
        SELECT *, {pct('idle_seconds', 'total_uptime_seconds')} AS idle_percent FROM g
        WHERE {pct('idle_seconds', 'total_uptime_seconds')} > 0""",
)
def _(spark, d):
    return clusters.idle(inputs.clusters(spark, d))


@register(
    "slow_queries_preview",
    """SELECT query_id, moment AS query_start_time, ms AS duration_ms, rows_produced,
        bytes AS bytes_scanned, substring(query_text, 1, 100) AS query_preview
        FROM qry WHERE ms > 10000 ORDER BY ms DESC, query_id LIMIT 20""",
)
def _(spark, d):
    return queries.slow_preview(inputs.queries(spark, d))


@register(
    "slowest_queries",
    f"""SELECT query_id, moment AS query_start_time, CAST(ms AS DOUBLE) / 1000 AS duration_seconds,
        rows_produced, CAST(bytes AS DOUBLE) / 1048576 AS mb_scanned,
        usr AS executed_by_user_name, substring(query_text, 1, 200) AS query_preview
        FROM qry WHERE {_since('moment', '7 DAYS')} AND err IS NULL
        ORDER BY ms DESC, query_id LIMIT 25""",
)
def _(spark, d):
    return queries.slowest(inputs.queries(spark, d), EVENTS_AS_OF)


@register(
    "dash_slow_queries",
    f"""SELECT query_id, moment AS query_start_time, CAST(ms AS DOUBLE) / 1000 AS duration_seconds,
        rows_produced, {r2('bytes', '1073741824')} AS gb_scanned,
        usr AS executed_by_user_name, substring(query_text, 1, 200) AS query_preview
        FROM qry WHERE {_since('moment', '24 HOURS')} AND err IS NULL AND ms > 10000
        ORDER BY ms DESC, query_id LIMIT 50""",
)
def _(spark, d):
    return queries.slow_last_day(inputs.queries(spark, d), EVENTS_AS_OF)


@register(
    "query_error_patterns",
    f"""SELECT substring(err, 1, 100) AS error_pattern, count(*) AS occurrence_count,
        count(DISTINCT usr) AS affected_users, max(moment) AS last_occurred
        FROM qry WHERE {_since('moment', '7 DAYS')} AND err IS NOT NULL
        GROUP BY 1 ORDER BY occurrence_count DESC, error_pattern LIMIT 20""",
)
def _(spark, d):
    return queries.error_patterns(inputs.queries(spark, d), EVENTS_AS_OF)
