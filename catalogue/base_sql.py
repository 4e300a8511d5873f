"""SQL views that state the table mappings a second time, independently of Spark."""

# Reference times, as in the table mappings.
COST_DAY = "DATE '2001-06-30'"
ORDERS_DAY = "DATE '2001-08-02'"
QUALITY_AT = "TIMESTAMP '2001-08-01 00:00:00'"
EVENTS_AT = "TIMESTAMP '2024-01-30 12:00:00'"


def r2(num: str, den: str) -> str:
    """Integer quotient rounded half away from zero to two digits; NULL for a zero divisor."""
    n, m = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN {m} = 0 THEN NULL ELSE sign({n}) * CAST((abs({n}) * 200 + {m}) "
        f"// (2 * {m}) AS DOUBLE) / 100.0 END)"
    )


def pct(part: str, whole: str) -> str:
    """Percentage of two integers with two digits."""
    return r2(f"({part}) * 100", whole)


VIEWS = {
    "ev": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "customers": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 17 = 0 THEN NULL
                    WHEN c_custkey % 23 = 0 THEN lower(replace(c_name, '#', '.'))
                    ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com'
               END AS email,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS VARCHAR)
                 AS created_date,
               CASE c_nationkey % 5 WHEN 0 THEN 'inactive' WHEN 1 THEN 'suspended'
                    WHEN 2 THEN CASE WHEN c_custkey % 3 = 0 THEN 'deleted' ELSE 'active' END
                    WHEN 3 THEN CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'active' END
                    ELSE 'active' END AS status,
               10 + c_custkey % 120 AS age,
               CASE WHEN c_custkey % 3 = 0 THEN '555-' ELSE '555-010-' END || c_custkey
                 AS phone_number
        FROM customer""",
    "bronze_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0004 - 2 AS DECIMAL(18,6))
                 AS order_amount,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'lost' END END
                 AS order_status,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 - 1 AS INTEGER) END
                 AS shipped_date
        FROM orders""",
    "good_customers": """
        SELECT customer_id, email, first_name || ' ' || last_name AS full_name, status,
               CAST(created_date AS DATE) AS created_date, split_part(email, '@', 2)
                 AS email_domain, age, phone_number
        FROM customers
        WHERE email IS NOT NULL
          AND regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$')
          AND coalesce(status IN ('active', 'inactive', 'suspended'), false)
          AND age >= 18 AND age <= 120""",
    "good_orders": """
        SELECT *, date_diff('day', order_date, shipped_date) AS days_to_ship
        FROM bronze_orders
        WHERE order_amount > 0
          AND order_status IN ('pending', 'completed', 'cancelled', 'refunded')
          AND customer_id IN (SELECT customer_id FROM good_customers)""",
    "cost": """
        SELECT CAST(l_shipdate AS DATE) AS usage_date,
               l_returnflag || '-' || l_linestatus AS sku_name,
               CASE l_linenumber % 3 WHEN 0 THEN 'AWS' WHEN 1 THEN 'AZURE' ELSE 'GCP' END
                 AS cloud,
               p_type AS billing_origin_product,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS usage_quantity,
               CAST(1 - l_discount AS DECIMAL(18,2)) AS list_price,
               CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round((1 - l_discount) * 100)
                 AS BIGINT) AS cost4, l_orderkey
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "jobs_all": """
        SELECT user_id % 25 AS job_id, 'job_' || user_id % 25 AS job_name, event_id AS run_id,
               ts AS start_time,
               CASE WHEN k <> 0 THEN ts + to_seconds(CAST(floor(value * 10) AS BIGINT)) END
                 AS end_time,
               CASE WHEN k <> 0 THEN CAST(floor(value * 10) AS BIGINT) END AS secs,
               CASE WHEN event_type = 'error' THEN 'FAILED'
                    WHEN event_type = 'signup' AND k < 50 THEN 'TIMEDOUT'
                    WHEN event_type = 'signup' THEN 'CANCELED' ELSE 'SUCCESS' END
                 AS result_state,
               CASE WHEN event_type IN ('error', 'signup') THEN 'ERR_' || k % 7 END
                 AS error_message, user_id, k
        FROM ev""",
    "jobs_cost": """
        SELECT *, result_state <> 'SUCCESS' AS bad,
               (secs * 1000000 * 2 + 1800) // 3600 AS dbu6,
               (secs * 1000000 * 2 + 12000) // 24000 AS cost6
        FROM jobs_all WHERE start_time <= TIMESTAMP '2024-01-30 12:00:00'""",
    "clu": """
        SELECT ts AS moment, 'pool_' || user_id % 8 AS cluster_name,
               CASE user_id % 3 WHEN 0 THEN 'm5.xlarge' WHEN 1 THEN 'm5.large' ELSE 'm5.small' END
                 AS node, k % 9 AS workers,
               CASE WHEN event_type IN ('view', 'click') THEN 'RUNNING'
                    WHEN event_type = 'purchase' THEN 'RESIZING' ELSE 'TERMINATED' END AS state,
               CAST(floor(value * 10) AS BIGINT) AS uptime,
               CASE user_id % 3 WHEN 0 THEN 25 WHEN 1 THEN 15 ELSE 10 END * (k % 9 + 1) AS rate10,
               user_id % 8 AS cluster
        FROM ev WHERE ts <= TIMESTAMP '2024-01-30 12:00:00'""",
    "qry": """
        SELECT 'q_' || event_id AS query_id, ts AS moment,
               CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS BIGINT) AS ms,
               user_id * 100 AS rows_produced, CAST(k AS BIGINT) * 1048576 AS bytes,
               'user_' || user_id AS usr,
               'SELECT * FROM ' || event_type || ' WHERE p = ' || props AS query_text,
               CASE WHEN event_type IN ('error', 'signup') THEN 'ERR_' || k % 7 END AS err,
               'wh_' || user_id % 3 AS warehouse_id
        FROM ev WHERE ts <= TIMESTAMP '2024-01-30 12:00:00'""",
    "log_all": """
        SELECT 'e' || event_id AS event_id, 'p' || user_id % 6 AS pipeline_id,
               'flow_' || user_id % 6 AS pipeline_name,
               'p' || user_id % 6 || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS update_id,
               ts AS moment, event_type IN ('click', 'signup') AS is_update,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO'
               END AS level,
               event_type || ' ' || props AS message,
               CASE WHEN event_type = 'error' THEN 'ERR_' || k % 7 END AS error,
               CASE WHEN k % 10 < 7 THEN 'COMPLETED' WHEN k % 10 = 7 THEN 'FAILED'
                    WHEN k % 10 = 8 THEN 'CANCELED' ELSE 'RUNNING' END AS state,
               'ds_' || k % 5 AS flow, k, value,
               event_type NOT IN ('click', 'signup') AND k % 50 <> 49 AS has_results
        FROM ev""",
    "log": """
        SELECT * FROM log_all WHERE moment <= TIMESTAMP '2024-01-30 12:00:00'""",
    "results_all": """
        SELECT event_id, pipeline_id, pipeline_name, update_id, moment, flow AS dataset_name,
               'exp_a' AS expectation_name, 'a > 0' AS expectation_query,
               'warn' AS expectation_action, CAST(floor(value * 10) AS BIGINT) AS passed,
               CAST(CASE WHEN k % 4 = 0 THEN k ELSE 0 END AS BIGINT) AS failed
        FROM log_all WHERE has_results
        UNION ALL
        SELECT event_id, pipeline_id, pipeline_name, update_id, moment, flow, 'exp_b', 'b > 0',
               'drop', CAST(k * 10 AS BIGINT),
               CAST(CASE WHEN k % 10 = 0 THEN 5 ELSE 0 END AS BIGINT)
        FROM log_all WHERE has_results""",
    "results": """
        SELECT * FROM results_all WHERE moment <= TIMESTAMP '2024-01-30 12:00:00'""",
    "health": """
        SELECT pipeline_id, pipeline_name, update_id, start_time, end_time,
               epoch(date_trunc('second', end_time)) - epoch(date_trunc('second', start_time))
                 AS secs,
               status, num_datasets, passed + failed AS records, checks, broken, passed, errors,
               warnings
        FROM (
          SELECT pipeline_id, pipeline_name, update_id,
                 min(moment) FILTER (is_update) AS start_time, max(moment) FILTER (is_update) AS end_time,
                 arg_max(state, moment) FILTER (is_update) AS status,
                 count(DISTINCT CASE WHEN has_results THEN flow END) AS num_datasets,
                 sum(CASE WHEN has_results THEN CAST(floor(value * 10) AS BIGINT) + k * 10
                     ELSE 0 END) AS passed,
                 sum(CASE WHEN has_results THEN (CASE WHEN k % 4 = 0 THEN k ELSE 0 END)
                     + (CASE WHEN k % 10 = 0 THEN 5 ELSE 0 END) ELSE 0 END) AS failed,
                 count(*) FILTER (has_results) * 2 AS checks,
                 count(*) FILTER (has_results AND k % 4 = 0 AND k > 0)
                   + count(*) FILTER (has_results AND k % 10 = 0) AS broken,
                 count(*) FILTER (level = 'ERROR') AS errors,
                 count(*) FILTER (level = 'WARN') AS warnings
          FROM log GROUP BY ALL)
        WHERE start_time IS NOT NULL""",
    "qm": """
        SELECT pipeline_name, moment, dataset_name, expectation_name, passed, n - passed AS failed,
               passed / n AS pass_rate
        FROM (
          SELECT 'orders_flow' AS pipeline_name, 'orders' AS dataset_name, o_orderdate AS moment,
                 unnest(['min_price', 'known_status', 'customer_in_credit']) AS expectation_name,
                 unnest([count(*) FILTER (o_totalprice >= 5000),
                         count(*) FILTER (o_orderstatus IN ('O', 'F')),
                         count(*) FILTER (o_custkey IN
                           (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))]) AS passed,
                 count(*) AS n
          FROM orders GROUP BY o_orderdate
          UNION ALL
          SELECT 'sales_flow', 'lineitem', l_shipdate,
                 unnest(['small_discount', 'min_quantity']),
                 unnest([count(*) FILTER (l_discount <= 0.08),
                         count(*) FILTER (l_quantity >= 3)]), count(*)
          FROM lineitem GROUP BY l_shipdate)
        WHERE moment <= TIMESTAMP '2001-08-01 00:00:00'""",
    "lin": """
        SELECT 'cat_' || s % 3 || '.sch_' || s % 5 || '.t_' || s AS src,
               'cat_' || d % 3 || '.sch_' || d % 5 || '.t_' || d AS dst,
               'cat_' || s % 3 AS src_cat, 'cat_' || d % 3 AS dst_cat,
               'sch_' || s % 5 AS src_sch, 'sch_' || d % 5 AS dst_sch,
               't_' || s AS src_t, 't_' || d AS dst_t,
               upper(event_type) AS source_type, ts AS moment, CAST(event_id AS VARCHAR) AS entity_id,
               'c_' || event_id % 3 AS src_col, 'c_' || (event_id + k) % 3 AS dst_col,
               'nb_' || user_id % 10 AS notebook_id, 'job_' || user_id % 25 AS job_id,
               'run_' || event_id AS run_id
        FROM (SELECT *, block + i AS s, block + (i * 7 + k % 3 * 31 + 1) % 140 + 10 AS d
              FROM (SELECT *, user_id - user_id % 150 AS block,
                           CASE WHEN user_id % 150 >= 140 THEN user_id % 150 - 10
                                ELSE user_id % 150 END AS i
                    FROM ev))""",
    "edge": "SELECT DISTINCT src, dst FROM lin",
    "cedge": """
        SELECT DISTINCT src || '#' || src_col AS src, dst || '#' || dst_col AS dst FROM lin""",
    "rules": """
        SELECT p_partkey AS id, lower(replace(p_brand, '#', '_')) AS dataset_name,
               'rule_' || p_partkey AS expectation_name,
               sha256(lower(replace(p_brand, '#', '_')) || '|rule_' || p_partkey) AS rule_id,
               CASE WHEN p_partkey % 4 <> 0 THEN 'flow_' || p_partkey % 3 END AS pipeline_name,
               ['not_null', 'valid_values', 'range', 'regex', 'custom'][p_partkey % 5 + 1]
                 AS expectation_type,
               'p_size >= ' || p_size AS constraint_expression,
               ['warn', 'drop', 'fail'][p_partkey % 3 + 1] AS action,
               ['critical', 'high', 'medium', 'low'][p_size % 4 + 1] AS severity,
               p_partkey % 5 <> 0 AS is_enabled,
               TIMESTAMP '2024-01-01 00:00:00' + to_hours(p_partkey % 200) AS created_at,
               TIMESTAMP '2024-01-01 00:00:00' + to_hours(p_partkey % 200)
                 + to_days(CAST(p_partkey % 13 AS INTEGER)) AS updated_at
        FROM part""",
    "cls": """
        SELECT CAST(DATE '2024-01-01' + CAST(d.doc_id % 30 AS INTEGER) AS TIMESTAMP)
                 AS window_start,
               lang AS model_id, CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END AS p, quality AS y
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "reg": """
        SELECT l_shipdate AS window_start, p_brand AS model_id,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS y,
               CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2))
                 AS DECIMAL(18,2)) AS p
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "raised": """
        SELECT 'a' || event_id AS alert_id, 'job_failure_' || user_id % 4 AS alert_type,
               CASE WHEN event_type = 'error' THEN 'critical' ELSE 'warning' END AS severity,
               'job_' || user_id % 25 || ' failed with ERR_' || k % 7 AS message,
               ts AS triggered_at, 'flow_' || user_id % 6 AS pipeline_name,
               'ds_' || k % 5 AS dataset_name
        FROM ev WHERE event_type IN ('error', 'signup')""",
}


def query(body: str) -> str:
    """``body`` preceded by the views it needs, in order of definition."""
    import re

    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"[a-z_]+", pending.pop()))
        for name in words & VIEWS.keys() - needed:
            needed.add(name)
            pending.append(VIEWS[name])
    if not needed:
        return body
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed)
    text = body.strip()
    if text.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {text[15:]}"
    if text.upper().startswith("WITH "):
        return f"WITH {ctes}, {text[5:]}"
    return f"WITH {ctes} {text}"
