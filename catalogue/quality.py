"""Event log, quality reports, expectations and the bronze-silver-gold example."""

from catalogue import inputs
from catalogue.base_sql import COST_DAY, EVENTS_AT, ORDERS_DAY, QUALITY_AT, pct, r2
from catalogue.registry import ORACLE, register
from pyspark.sql import functions as F
from vigil.operators import event_log, medallion, privacy, quality, stored_health
from vigil.operators.expectations import Expectation, check, counts
from vigil.plans.scratch import scratch_path
from vigil.sources import collectors, testbed
from vigil.sources.testbed import EVENTS_AS_OF, ORDERS_AS_OF, QUALITY_AS_OF, table


def _since(col: str, end: str, amount: str) -> str:
    return f"{col} >= {end} - INTERVAL {amount} AND {col} <= {end}"


EVENTS_7 = _since("moment", EVENTS_AT, "7 DAYS")
QUALITY_7 = _since("moment", QUALITY_AT, "7 DAYS")
RATE = "CASE WHEN passed + failed > 0 THEN passed / (passed + failed) ELSE 1.0 END"
AVG_RATE = "CAST(sum(CAST(pass_rate AS DECIMAL(18,10))) AS DOUBLE) / count(*)"
SCORE = pct("sum(passed)", "sum(passed) + sum(failed)")

# ---------------------------------------------------------------- event log


@register(
    "collect_event_logs",
    f"""SELECT event_id, pipeline_id, pipeline_name, update_id, moment AS timestamp,
        CASE WHEN is_update THEN 'update_progress' ELSE 'flow_progress' END AS event_type, level,
        message, error, {EVENTS_AT} AS ingestion_timestamp FROM log WHERE {EVENTS_7}""",
)
def _(spark, d):
    return inputs.events(spark, d, 7).drop("details", "origin")


@register(
    "collect_event_logs_one_flow",
    f"""SELECT event_id, update_id, moment AS timestamp, level FROM log
        WHERE {EVENTS_7} AND pipeline_id = 'p3'""",
)
def _(spark, d):
    log = testbed.event_log(spark, d)
    return collectors.event_logs(log, EVENTS_AS_OF, 7, pipeline_id="p3").select(
        "event_id", "update_id", "timestamp", "level"
    )


@register(
    "extract_quality_metrics",
    f"""SELECT pipeline_id, pipeline_name, update_id, moment AS timestamp, dataset_name,
        expectation_name, expectation_query, expectation_action, passed AS passed_records,
        failed AS failed_records, {RATE} AS pass_rate, {EVENTS_AT} AS ingestion_timestamp
        FROM results""",
)
def _(spark, d):
    return event_log.quality_metrics(inputs.events(spark, d), EVENTS_AS_OF)


@register(
    "update_health",
    f"""SELECT pipeline_id, pipeline_name, update_id, start_time, end_time,
        CAST(secs AS BIGINT) AS duration_seconds, status, num_datasets,
        CAST(records AS BIGINT) AS total_records_processed, checks AS total_expectations_checked,
        broken AS total_expectations_failed, {pct('passed', 'records')} AS overall_quality_score,
        errors AS error_count, warnings AS warning_count, {EVENTS_AT} AS ingestion_timestamp
        FROM health""",
)
def _(spark, d):
    return inputs.health(spark, d)


HEALTH_7 = _since("start_time", EVENTS_AT, "7 DAYS")
AVG_SECS = "CAST(sum(secs) AS DOUBLE) / count(secs)"


@register(
    "update_exec_by_status",
    f"""SELECT pipeline_name, status, count(*) AS execution_count,
        {AVG_SECS} AS avg_duration_seconds, CAST(max(secs) AS BIGINT) AS max_duration_seconds,
        CAST(sum(errors) AS BIGINT) AS total_errors, CAST(sum(warnings) AS BIGINT) AS total_warnings
        FROM health WHERE {HEALTH_7} GROUP BY pipeline_name, status""",
)
def _(spark, d):
    return event_log.executions_by_status(inputs.health(spark, d), EVENTS_AS_OF)


@register(
    "dash_update_summary",
    f"""SELECT pipeline_name, count(*) AS total_runs,
        count(*) FILTER (status = 'COMPLETED') AS successful_runs,
        count(*) FILTER (status IN ('FAILED', 'CANCELED')) AS failed_runs,
        {r2('sum(secs)', '60 * count(secs)')} AS avg_duration_minutes,
        CAST(sum(errors) AS BIGINT) AS total_errors, CAST(sum(warnings) AS BIGINT) AS total_warnings,
        max(start_time) AS last_run_time,
        {pct("count(*) FILTER (status = 'COMPLETED')", 'count(*)')} AS success_rate
        FROM health WHERE {HEALTH_7} GROUP BY pipeline_name""",
)
def _(spark, d):
    return event_log.execution_summary(inputs.health(spark, d), EVENTS_AS_OF)


# The mapped updates run daily, so freshness is asked two and a half days later.
LATER = "TIMESTAMP '2024-02-01 13:30:00'"


def _later():
    from datetime import datetime

    return datetime(2024, 2, 1, 13, 30)


@register(
    "dash_freshness",
    f"""WITH g AS (SELECT pipeline_name, max(start_time) AS last_run_time FROM health
          GROUP BY pipeline_name),
        h AS (SELECT *, date_sub('hour', last_run_time, {LATER}) AS n FROM g)
        SELECT pipeline_name, last_run_time, n AS hours_since_last_run,
        CASE WHEN n > 48 THEN 'CRITICAL: >48h' WHEN n > 24 THEN 'WARNING: >24h' ELSE 'OK' END
          AS freshness_status FROM h WHERE n > 12""",
)
def _(spark, d):
    return event_log.freshness(inputs.health(spark, d), _later())


def _stored(spark, d):
    """Stored health after four batches: the older events, the newer ones, late ones from both,
    and the first batch again."""
    root = scratch_path(spark, "health")
    log = inputs.events(spark, d)
    late = F.pmod(F.xxhash64("timestamp", "details"), F.lit(11)) == 0
    old = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp_ntz")
    batches = [~late & old, ~late & ~old, late, ~late & old]
    for number, which in zip((0, 1, 2, 0), batches):
        stored_health.refresh(log.filter(which), root, number, EVENTS_AS_OF)
    return root


@register("stored_health")
def _(spark, d):
    return stored_health.health(spark, _stored(spark, d))


@register("stored_exec_by_status")
def _(spark, d):
    week = stored_health.health(spark, _stored(spark, d), EVENTS_AS_OF, 7)
    return event_log.executions_by_status(week, EVENTS_AS_OF)


@register("stored_update_summary")
def _(spark, d):
    week = stored_health.health(spark, _stored(spark, d), EVENTS_AS_OF, 7)
    return event_log.execution_summary(week, EVENTS_AS_OF)


@register("stored_freshness")
def _(spark, d):
    return event_log.freshness(stored_health.health(spark, _stored(spark, d)), _later())


# The stored tables must give what the whole log gives.
for _name, _same in {
    "stored_health": "update_health",
    "stored_exec_by_status": "update_exec_by_status",
    "stored_update_summary": "dash_update_summary",
    "stored_freshness": "dash_freshness",
}.items():
    ORACLE[_name] = ORACLE[_same]


@register(
    "error_analysis",
    f"""SELECT pipeline_name,
        CASE WHEN is_update THEN 'update_progress' ELSE 'flow_progress' END AS event_type, level,
        error, count(*) AS occurrence_count, max(moment) AS last_occurred
        FROM log WHERE {EVENTS_7} AND level IN ('ERROR', 'WARN') GROUP BY ALL
        ORDER BY occurrence_count DESC, last_occurred DESC, pipeline_name LIMIT 25""",
)
def _(spark, d):
    return event_log.error_analysis(inputs.events(spark, d), EVENTS_AS_OF)


_PATTERNS = f"""SELECT substring(error, 1, 100) AS error_pattern,
        count(DISTINCT pipeline_name) AS affected_pipelines, count(*) AS occurrence_count,
        max(moment) AS last_occurred
        FROM log WHERE {EVENTS_7} AND level = 'ERROR' AND error IS NOT NULL GROUP BY 1
        ORDER BY occurrence_count DESC, error_pattern LIMIT 25"""


@register("dash_error_patterns", _PATTERNS)
def _(spark, d):
    return event_log.error_patterns(inputs.events(spark, d), EVENTS_AS_OF).totals


@register(
    "dash_error_pattern_pipelines",
    f"""SELECT DISTINCT error_pattern, pipeline_name
        FROM log JOIN ({_PATTERNS}) ON substring(error, 1, 100) = error_pattern
        WHERE {EVENTS_7} AND level = 'ERROR' AND pipeline_name IS NOT NULL""",
)
def _(spark, d):
    return event_log.error_patterns(inputs.events(spark, d), EVENTS_AS_OF).values


# ---------------------------------------------------------------- quality metrics


@register(
    "quality_metrics",
    """SELECT pipeline_name, moment AS timestamp, dataset_name, expectation_name,
        passed AS passed_records, failed AS failed_records, pass_rate FROM qm""",
)
def _(spark, d):
    return inputs.quality(spark, d).select(
        "pipeline_name",
        "timestamp",
        "dataset_name",
        "expectation_name",
        "passed_records",
        "failed_records",
        "pass_rate",
    )


@register(
    "quality_trend_daily",
    f"""SELECT CAST(CAST(moment AS DATE) AS VARCHAR) AS date, dataset_name, expectation_name,
        {AVG_RATE} AS avg_pass_rate, CAST(sum(failed) AS BIGINT) AS total_failed_records,
        CAST(sum(passed) AS BIGINT) AS total_passed_records FROM qm WHERE {QUALITY_7}
        GROUP BY CAST(moment AS DATE), dataset_name, expectation_name""",
)
def _(spark, d):
    return quality.trend_daily(inputs.quality(spark, d), QUALITY_AS_OF)


@register(
    "failed_expectations_report",
    f"""SELECT pipeline_name, dataset_name, expectation_name, moment AS timestamp,
        passed AS passed_records, failed AS failed_records, pass_rate
        FROM qm WHERE pass_rate < 1 AND {QUALITY_7}
        ORDER BY moment DESC, pass_rate, pipeline_name, dataset_name, expectation_name LIMIT 50""",
)
def _(spark, d):
    return quality.failed_report(inputs.quality(spark, d), QUALITY_AS_OF).drop("expectation_query")


@register(
    "dash_quality_by_flow",
    f"""SELECT pipeline_name, count(DISTINCT dataset_name) AS dataset_count,
        CAST(sum(passed) AS BIGINT) AS total_passed, CAST(sum(failed) AS BIGINT) AS total_failed,
        {SCORE} AS overall_quality_score FROM qm WHERE {QUALITY_7} GROUP BY pipeline_name""",
)
def _(spark, d):
    return quality.by_pipeline(inputs.quality(spark, d), QUALITY_AS_OF)


@register(
    "dash_failed_expectations",
    f"""SELECT dataset_name, expectation_name, count(*) AS failure_count,
        CAST(sum(failed) AS BIGINT) AS total_failed_records, {AVG_RATE} AS avg_pass_rate,
        min(pass_rate) AS min_pass_rate, max(moment) AS last_failure
        FROM qm WHERE {QUALITY_7} AND failed > 0 GROUP BY dataset_name, expectation_name
        ORDER BY total_failed_records DESC, failure_count DESC, dataset_name, expectation_name
        LIMIT 50""",
)
def _(spark, d):
    return quality.failures_by_dataset(inputs.quality(spark, d), QUALITY_AS_OF)


@register(
    "dash_quality_trend",
    f"""SELECT CAST(CAST(moment AS DATE) AS VARCHAR) AS quality_date, pipeline_name,
        {SCORE} AS daily_quality_score, CAST(sum(passed + failed) AS BIGINT) AS total_records_processed
        FROM qm WHERE {_since('moment', QUALITY_AT, '30 DAYS')}
        GROUP BY CAST(moment AS DATE), pipeline_name""",
)
def _(spark, d):
    return quality.daily_by_pipeline(inputs.quality(spark, d), QUALITY_AS_OF)


@register(
    "low_pass_rate_datasets",
    f"""SELECT dataset_name, {AVG_RATE} AS avg_pass_rate FROM qm WHERE {QUALITY_7}
        GROUP BY dataset_name HAVING {AVG_RATE} < 0.9""",
)
def _(spark, d):
    return quality.low_pass_rate(inputs.quality(spark, d), QUALITY_AS_OF)


@register(
    "quality_grade",
    f"""WITH g AS (SELECT pipeline_name, dataset_name, {SCORE} AS quality_score FROM qm
          WHERE {QUALITY_7} GROUP BY pipeline_name, dataset_name)
        SELECT *, CASE WHEN quality_score >= 95 THEN 'healthy' WHEN quality_score < 80
          THEN 'critical' WHEN quality_score < 90 THEN 'warning' ELSE 'degraded' END AS health
        FROM g""",
)
def _(spark, d):
    return quality.graded(inputs.quality(spark, d), QUALITY_AS_OF)


@register(
    "exec_summary",
    f"""SELECT '2024-01-29' AS report_date,
        (SELECT CAST(sum(cost4) AS DOUBLE) / 10000 FROM cost WHERE usage_date = {COST_DAY} - 1)
          AS yesterday_cost,
        (SELECT count(*) FROM jobs_cost WHERE CAST(start_time AS DATE) = DATE '2024-01-29')
          AS total_jobs_run,
        (SELECT count(*) FROM jobs_cost WHERE CAST(start_time AS DATE) = DATE '2024-01-29'
          AND bad) AS failed_jobs,
        (SELECT {SCORE} FROM qm WHERE CAST(moment AS DATE) = DATE '2001-07-31')
          AS overall_quality_score,
        (SELECT count(*) FROM log WHERE CAST(moment AS DATE) = DATE '2024-01-29'
          AND level = 'ERROR') AS total_errors""",
)
def _(spark, d):
    return quality.executive_summary(
        inputs.shifted_cost(spark, d),
        inputs.jobs(spark, d),
        inputs.shifted_quality(spark, d),
        inputs.events(spark, d),
        EVENTS_AS_OF,
    )


# ---------------------------------------------------------------- expectations

_ORDERS = "o_totalprice >= 5000", "o_orderstatus IN ('O','F')"
_CREDIT = "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"


def _orders(spark, d):
    return check(
        table(spark, d, "orders"),
        inputs.ORDER_QUALITY,
        {"customers_in_credit": inputs.customers_in_credit(spark, d)},
    )


def _counted(name: str, action: str, condition: str, source: str) -> str:
    return f"""SELECT '{name}' AS expectation_name, '{action}' AS expectation_action,
        count(*) FILTER (coalesce({condition}, false)) AS passed_records,
        count(*) FILTER (NOT coalesce({condition}, false)) AS failed_records,
        count(*) FILTER (coalesce({condition}, false)) / count(*) AS pass_rate FROM {source}"""


@register(
    "expect_warn_counts",
    " UNION ALL ".join(
        (
            _counted("min_price", "drop", _ORDERS[0], "orders"),
            _counted("known_status", "warn", _ORDERS[1], "orders"),
            _counted("customer_in_credit", "drop", _CREDIT, "orders"),
        )
    ),
)
def _(spark, d):
    return _orders(spark, d).counts().drop("expectation_query")


@register(
    "expect_drop_rows",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
        WHERE {_ORDERS[0]} AND {_CREDIT}""",
)
def _(spark, d):
    return _orders(spark, d).valid.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


@register(
    "quarantine_rows",
    f"""SELECT o_orderkey, o_totalprice, concat_ws(',',
          CASE WHEN NOT ({_ORDERS[0]}) THEN 'min_price' END,
          CASE WHEN NOT ({_CREDIT}) THEN 'customer_in_credit' END) AS quarantine_reasons
        FROM orders WHERE NOT ({_ORDERS[0]} AND {_CREDIT})""",
)
def _(spark, d):
    return _orders(spark, d).quarantine.select("o_orderkey", "o_totalprice", "quarantine_reasons")


@register(
    "expect_fail_check",
    """SELECT 'order_has_key' AS expectation_name, count(*) FILTER (o_orderkey IS NOT NULL)
        AS passed_records, count(*) FILTER (o_orderkey IS NULL) AS failed_records FROM orders""",
)
def _(spark, d):
    rules = [Expectation("order_has_key", "o_orderkey IS NOT NULL", "fail")]
    checked = check(table(spark, d, "orders"), rules).enforce()
    return checked.counts().select("expectation_name", "passed_records", "failed_records")


@register(
    "expect_referential_integrity",
    _counted("customer_in_credit", "drop", _CREDIT, "orders"),
)
def _(spark, d):
    rule = [r for r in inputs.ORDER_QUALITY if r.fk]
    refs = {"customers_in_credit": inputs.customers_in_credit(spark, d)}
    return counts(table(spark, d, "orders"), rule, refs).drop("expectation_query")


@register(
    "expect_by_group",
    """SELECT o_orderpriority, 'min_price' AS expectation_name,
        count(*) FILTER (o_totalprice >= 5000) AS passed_records,
        count(*) FILTER (o_totalprice < 5000) AS failed_records FROM orders GROUP BY 1""",
)
def _(spark, d):
    return counts(
        table(spark, d, "orders"),
        inputs.ORDER_QUALITY[:1],
        by={"o_orderpriority": F.col("o_orderpriority")},
    ).select("o_orderpriority", "expectation_name", "passed_records", "failed_records")


@register(
    "expect_unique_rows",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
)
def _(spark, d):
    rule = Expectation("line_unique", "one row per line", "drop", unique=("l_orderkey", "l_linenumber"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return check(lines, [rule]).valid


# ---------------------------------------------------------------- bronze, silver, gold


def _layers(spark, d):
    return medallion.build(
        testbed.bronze_customers(spark, d), testbed.bronze_orders(spark, d), ORDERS_AS_OF
    )


@register(
    "silver_customers",
    """SELECT customer_id, email, full_name, status, CAST(created_date AS VARCHAR)
        AS created_date, email_domain, age, phone_number FROM good_customers""",
)
def _(spark, d):
    return medallion.silver_customers(testbed.bronze_customers(spark, d)).drop(
        "first_name", "last_name"
    )


@register(
    "silver_customers_quarantine",
    r"""SELECT customer_id, concat_ws(', ',
          CASE WHEN email IS NULL THEN 'email_not_null' END,
          CASE WHEN NOT coalesce(regexp_matches(email,
            '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'), false)
            THEN 'valid_email_format' END,
          CASE WHEN NOT coalesce(status IN ('active', 'inactive', 'suspended'), false)
            THEN 'valid_status' END,
          CASE WHEN age < 18 OR age > 120 THEN 'valid_age_range' END) AS quarantine_reason
        FROM customers WHERE customer_id NOT IN (SELECT customer_id FROM good_customers)""",
)
def _(spark, d):
    bronze = testbed.bronze_customers(spark, d)
    return medallion.quarantined_customers(bronze, ORDERS_AS_OF).select(
        "customer_id", "quarantine_reason"
    )


@register(
    "silver_orders",
    """SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date,
        CAST(order_amount AS DOUBLE) AS order_amount, order_status,
        CAST(shipped_date AS VARCHAR) AS shipped_date, days_to_ship FROM good_orders""",
)
def _(spark, d):
    return medallion.silver_orders(
        testbed.bronze_orders(spark, d),
        medallion.silver_customers(testbed.bronze_customers(spark, d)),
    )


GOLD = f"""SELECT customer_id, count(*) AS total_orders, sum(order_amount) AS revenue,
    min(order_date) AS first_day, max(order_date) AS last_day,
    count(DISTINCT year(order_date)) AS active_years FROM good_orders GROUP BY customer_id"""
SEGMENT = """CASE WHEN revenue >= 1000 THEN 'VIP' WHEN revenue >= 500 THEN 'High Value'
    WHEN revenue >= 100 THEN 'Regular' ELSE 'Low Value' END"""


@register(
    "gold_customer_metrics",
    f"""WITH g AS ({GOLD})
        SELECT g.customer_id, total_orders, CAST(revenue AS DOUBLE) AS total_revenue,
        CAST(revenue AS DOUBLE) / total_orders AS avg_order_value,
        CAST(first_day AS VARCHAR) AS first_order_date,
        CAST(last_day AS VARCHAR) AS last_order_date, active_years, email, full_name, status,
        CAST(created_date AS VARCHAR) AS created_date, email_domain,
        date_diff('day', first_day, {ORDERS_DAY}) AS days_since_first_order,
        date_diff('day', last_day, {ORDERS_DAY}) AS days_since_last_order,
        {SEGMENT} AS customer_segment
        FROM g JOIN good_customers c ON g.customer_id = c.customer_id""",
)
def _(spark, d):
    return _layers(spark, d).metrics


@register(
    "customer_segment",
    f"""WITH g AS ({GOLD}) SELECT {SEGMENT} AS customer_segment, count(*) AS customers,
        CAST(sum(revenue) AS DOUBLE) AS revenue FROM g GROUP BY 1""",
)
def _(spark, d):
    return (
        _layers(spark, d)
        .metrics.groupBy("customer_segment")
        .agg(F.count("*").alias("customers"), F.sum("total_revenue").alias("revenue"))
    )


@register(
    "gold_daily_revenue",
    """SELECT CAST(order_date AS VARCHAR) AS order_date,
        CAST(sum(order_amount) AS DOUBLE) AS daily_revenue, count(*) AS order_count,
        count(DISTINCT customer_id) AS unique_customers,
        CAST(sum(order_amount) AS DOUBLE) / count(*) AS avg_order_value
        FROM good_orders WHERE order_status = 'completed' GROUP BY order_date""",
)
def _(spark, d):
    return _layers(spark, d).revenue


@register(
    "gold_status_summary",
    f"""SELECT status, count(*) AS customer_count, CAST(sum(age) AS DOUBLE) / count(age) AS avg_age,
        count(DISTINCT email_domain) AS email_domains,
        {pct('count(*)', '(SELECT count(*) FROM good_customers)')} AS percentage
        FROM good_customers GROUP BY status""",
)
def _(spark, d):
    return medallion.status_summary(
        medallion.silver_customers(testbed.bronze_customers(spark, d))
    ).totals


@register(
    "gold_status_domains",
    """SELECT DISTINCT status, email_domain FROM good_customers WHERE email_domain IS NOT NULL""",
)
def _(spark, d):
    return medallion.status_summary(
        medallion.silver_customers(testbed.bronze_customers(spark, d))
    ).values


def _tally(table_name: str, layer: str, source: str, *rules: str) -> str:
    passed = " + ".join(f"count(*) FILTER (coalesce({r}, false))" for r in rules)
    return f"""SELECT '{table_name}' AS table_name, '{layer}' AS layer,
        {passed} AS p, count(*) * {len(rules)} AS n FROM {source}"""


_TALLIES = " UNION ALL ".join(
    (
        _tally("bronze_customers", "bronze", "customers", "customer_id IS NOT NULL"),
        _tally("bronze_orders", "bronze", "bronze_orders", "order_id IS NOT NULL"),
        _tally(
            "silver_customers", "silver", "customers", "customer_id IS NOT NULL",
            "email IS NOT NULL",
            r"regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')",
            "status IN ('active', 'inactive', 'suspended')", "age BETWEEN 18 AND 120",
            "length(phone_number) >= 10",
        ),
        _tally(
            "silver_orders", "silver", "bronze_orders", "order_id IS NOT NULL",
            "customer_id IS NOT NULL", "order_amount > 0",
            "order_status IN ('pending', 'completed', 'cancelled', 'refunded')",
            "shipped_date IS NULL OR shipped_date >= order_date",
            "customer_id IN (SELECT customer_id FROM good_customers)",
        ),
        _tally(
            "gold_customer_metrics", "gold",
            "(SELECT count(*) AS o, sum(order_amount) AS r FROM good_orders GROUP BY customer_id)",
            "o > 0", "r > 0",
        ),
        _tally(
            "gold_daily_revenue", "gold",
            "(SELECT order_date AS day, sum(order_amount) AS r FROM good_orders "
            "WHERE order_status = 'completed' GROUP BY order_date)",
            "day IS NOT NULL", "r > 0",
        ),
    )
)


@register(
    "data_quality_summary",
    f"""SELECT table_name, layer, p AS records_passed, n - p AS records_failed,
        {pct('p', 'n')} AS quality_score FROM ({_TALLIES})""",
)
def _(spark, d):
    return medallion.quality_summary(
        testbed.bronze_customers(spark, d), testbed.bronze_orders(spark, d), ORDERS_AS_OF
    )


@register(
    "mask_pii",
    """SELECT customer_id,
        regexp_replace(regexp_replace(regexp_replace(email, '[A-Z]', 'X', 'g'),
          '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS email,
        regexp_replace(regexp_replace(phone_number, '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')
          AS phone_number, sha256(email) AS email_digest FROM customers""",
)
def _(spark, d):
    bronze = testbed.bronze_customers(spark, d).select("customer_id", "email", "phone_number")
    return privacy.masked_columns(bronze, digests=True).drop("phone_number_digest")


_KEY = privacy.Key("v1", b"a key for the comparison only")
_INNER, _OUTER = (f"unhex('{pad.hex()}')" for pad in _KEY.pads())


@register(
    "pseudonyms",
    f"""SELECT customer_id, 'v1:' || sha256({_OUTER} || unhex(sha256({_INNER} ||
        encode(phone_number)))) AS phone_number_pseudonym FROM customers""",
)
def _(spark, d):
    bronze = testbed.bronze_customers(spark, d).select("customer_id", "phone_number")
    return privacy.keyed_digests(bronze, ["phone_number"], _KEY).drop("phone_number")


@register(
    "row_filter",
    """SELECT customer_id, status FROM customers WHERE status = 'suspended' AND age < 40""",
)
def _(spark, d):
    policies = {"support": "status = 'suspended' AND age < 40", "admin": "true"}
    bronze = testbed.bronze_customers(spark, d)
    return privacy.visible_rows(bronze, policies, "support").select("customer_id", "status")
