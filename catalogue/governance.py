"""Rules registry, rule templates and lineage."""

from datetime import date, datetime

from catalogue import inputs
from catalogue.base_sql import EVENTS_AT, QUALITY_AT, pct
from catalogue.registry import register
from pyspark.sql import functions as F
from vigil.functions.exprs import severity_rank, ts_lit
from vigil.operators import lineage, quality, rule_history, rules
from vigil.operators.expectations import Expectation, counts
from vigil.operators.rules import Templates, to_expectation
from vigil.plans.scratch import scratch_path
from vigil.sources import testbed
from vigil.sources.testbed import EVENTS_AS_OF, QUALITY_AS_OF, table

NOW = datetime(2024, 3, 1)
SHIPPED = date(2001, 7, 31)
NOW_SQL = "TIMESTAMP '2024-03-01 00:00:00'"

# ---------------------------------------------------------------- rule templates


def _applied(spark, d, name: str, rule: dict, references=None):
    return counts(table(spark, d, name), [to_expectation(rule, SHIPPED)], references).drop(
        "expectation_query"
    )


def _counted(name: str, action: str, condition: str, source: str) -> str:
    ok = f"count(*) FILTER (coalesce({condition}, false))"
    return f"""SELECT '{name}' AS expectation_name, '{action}' AS expectation_action,
        {ok} AS passed_records, count(*) - {ok} AS failed_records, {ok} / count(*) AS pass_rate
        FROM {source}"""


@register("rule_not_null", _counted("email_not_null", "warn", "email IS NOT NULL", "customers"))
def _(spark, d):
    rule = to_expectation(Templates.not_null("customers", "email", now=NOW))
    return counts(testbed.bronze_customers(spark, d), [rule]).drop("expectation_query")


@register(
    "rule_valid_values",
    _counted("o_orderstatus_valid_values", "drop", "o_orderstatus IN ('O', 'F')", "orders"),
)
def _(spark, d):
    rule = Templates.valid_values("orders", "o_orderstatus", ["O", "F"], now=NOW)
    return _applied(spark, d, "orders", rule)


@register(
    "rule_numeric_range",
    _counted("c_acctbal_range", "warn", "c_acctbal >= 0 AND c_acctbal <= 5000", "customer"),
)
def _(spark, d):
    rule = Templates.numeric_range("customer", "c_acctbal", 0, 5000, now=NOW)
    return _applied(spark, d, "customer", rule)


@register(
    "rule_unique",
    """SELECT 'l_orderkey_unique' AS expectation_name, 'warn' AS expectation_action,
        CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS passed_records,
        CAST(sum(n) - sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS failed_records,
        sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n) AS pass_rate
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)""",
)
def _(spark, d):
    rule = Templates.unique_values("lineitem", "l_orderkey", action="warn", now=NOW)
    return _applied(spark, d, "lineitem", rule)


@register(
    "rule_regex",
    _counted(
        "url_format", "drop",
        r"regexp_matches(url, '^https?://[a-z0-9.-]+\.(com|org)/[a-z]{2}/')", "pages",
    ),
)
def _(spark, d):
    pattern = r"^https?://[a-z0-9.-]+\.(com|org)/[a-z]{2}/"
    return _applied(spark, d, "pages", Templates.regex_match("pages", "url", pattern, now=NOW))


@register(
    "rule_freshness",
    _counted("l_shipdate_freshness", "warn", "l_shipdate >= DATE '2001-07-01'", "lineitem"),
)
def _(spark, d):
    rule = Templates.date_freshness("lineitem", "l_shipdate", 30, now=NOW)
    return _applied(spark, d, "lineitem", rule)


@register(
    "rule_referential",
    _counted(
        "o_custkey_fk_check", "drop",
        "o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)", "orders",
    ),
)
def _(spark, d):
    rule = Templates.referential_integrity(
        "orders", "o_custkey", "customers_in_credit", "c_custkey", now=NOW
    )
    refs = {"customers_in_credit": inputs.customers_in_credit(spark, d)}
    return _applied(spark, d, "orders", rule, refs)


@register(
    "rule_custom",
    _counted("text_not_short", "drop", "length(text) >= 200 AND lang <> 'en'", "documents"),
)
def _(spark, d):
    rule = rules.create_rule(
        "documents", "text_not_short", "custom", "LENGTH(text) >= 200 AND lang <> 'en'", "drop",
        now=NOW,
    )
    return _applied(spark, d, "documents", rule)


# ---------------------------------------------------------------- registry


@register(
    "rules_round_trip",
    " UNION ALL ".join(
        (
            _counted("l_quantity_range", "warn", "l_quantity >= 1 AND l_quantity <= 40", "lineitem"),
            _counted("l_linenumber_valid_values", "drop", "l_linenumber IN (1, 2, 3)", "lineitem"),
            _counted("l_shipdate_freshness", "warn", "l_shipdate >= DATE '2001-07-01'", "lineitem"),
            _counted(
                "l_suppkey_fk_check", "drop",
                "l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)", "lineitem",
            ),
            """SELECT 'l_orderkey_l_linenumber_unique', 'warn',
               CAST(coalesce(sum(n) FILTER (n = 1), 0) AS BIGINT),
               CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT),
               coalesce(sum(n) FILTER (n = 1), 0) / sum(n)
               FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
        )
    ),
)
def _(spark, d):
    """Rules are stored beside all others, replaced, switched off, loaded and applied."""
    of = "lineitem"
    first = [
        Templates.numeric_range(of, "l_quantity", 0, 10, now=datetime(2024, 2, 1)),
        Templates.valid_values(of, "l_linenumber", [1, 2, 3], now=NOW),
        Templates.date_freshness(of, "l_shipdate", 30, now=NOW),
        Templates.referential_integrity(of, "l_suppkey", "suppliers", "s_suppkey", now=NOW),
        Templates.unique_values(of, ["l_orderkey", "l_linenumber"], action="warn", now=NOW),
        Templates.not_null(of, "l_tax", now=NOW),
    ]
    registry = rules.upsert(testbed.rules_registry(spark, d), rules.as_rows(spark, first))
    again = [Templates.numeric_range(of, "l_quantity", 1, 40, now=datetime(2024, 2, 1))]
    registry = rules.upsert(registry, rules.as_rows(spark, again))
    registry = rules.disable(registry, rules.rule_id(of, "l_tax_not_null"), NOW)
    path = scratch_path(spark, "rules")
    registry.write.parquet(path)
    loaded = rules.load(spark.read.parquet(path), of, as_of=SHIPPED)
    suppliers = table(spark, d, "supplier").filter("s_acctbal >= 0")
    return counts(table(spark, d, of), loaded, {"suppliers": suppliers}).drop("expectation_query")


@register(
    "rules_for_dataset",
    """SELECT expectation_name, expectation_type, constraint_expression, action,
        expectation_type || ' validation for ' || dataset_name AS description, severity
        FROM rules WHERE dataset_name = 'brand_2' AND is_enabled
        AND (pipeline_name = 'flow_1' OR pipeline_name IS NULL)""",
)
def _(spark, d):
    return rules.for_dataset(testbed.rules_registry(spark, d), "brand_2", "flow_1")


@register(
    "rules_active",
    """SELECT rule_id, pipeline_name, dataset_name, expectation_name, action, severity
        FROM rules WHERE is_enabled""",
)
def _(spark, d):
    return rules.active(testbed.rules_registry(spark, d)).select(
        "rule_id", "pipeline_name", "dataset_name", "expectation_name", "action", "severity"
    )


def _incoming(spark, d):
    """A delivery of changed rules: every third one again, plus new names."""
    known = testbed.rules_registry(spark, d)
    later = ts_lit(datetime(2024, 2, 20))
    changed = known.filter(F.substring("expectation_name", -1, 1).isin("1", "4", "7")).withColumns(
        {"severity": F.lit("low"), "updated_at": later}
    )
    fresh = changed.withColumns(
        {
            "expectation_name": F.concat("expectation_name", F.lit("_b")),
            "created_at": later,
            "rule_id": F.sha2(F.concat_ws("|", "dataset_name", "expectation_name"), 256),
        }
    )
    return changed.unionByName(fresh)


_CHANGED = "right(expectation_name, 1) IN ('1', '4', '7')"


@register(
    "rules_upsert",
    f"""SELECT dataset_name, expectation_name,
        CASE WHEN {_CHANGED} THEN 'low' ELSE severity END AS severity, created_at,
        CASE WHEN {_CHANGED} THEN TIMESTAMP '2024-02-20 00:00:00' ELSE updated_at END
          AS updated_at FROM rules
        UNION ALL SELECT dataset_name, expectation_name || '_b', 'low',
        TIMESTAMP '2024-02-20 00:00:00', TIMESTAMP '2024-02-20 00:00:00'
        FROM rules WHERE {_CHANGED}""",
)
def _(spark, d):
    merged = rules.upsert(testbed.rules_registry(spark, d), _incoming(spark, d))
    return merged.select("dataset_name", "expectation_name", "severity", "created_at", "updated_at")


@register(
    "rules_change_feed",
    f"""SELECT rule_id, CASE WHEN id % 10 = 0 THEN 'delete' ELSE 'update' END AS change_type,
        dataset_name, expectation_name,
        CASE WHEN {_CHANGED} THEN 'low' ELSE severity END AS severity
        FROM rules WHERE id % 10 = 0 OR {_CHANGED}
        UNION ALL SELECT sha256(dataset_name || '|' || expectation_name || '_b'), 'insert',
        dataset_name, expectation_name || '_b', 'low' FROM rules WHERE {_CHANGED}""",
)
def _(spark, d):
    before = testbed.rules_registry(spark, d)
    after = rules.upsert(before, _incoming(spark, d)).filter(
        ~F.col("expectation_name").endswith("0")
    )
    after = after.withColumn(
        "rule_id", F.sha2(F.concat_ws("|", "dataset_name", "expectation_name"), 256)
    )
    return rules.change_feed(before, after).select(
        "rule_id", "change_type", "dataset_name", "expectation_name", "severity"
    )


def _change_log(spark, d):
    """Seeded rules, the delivery of 20 February, and a deletion on 25 February."""
    known = testbed.rules_registry(spark, d)
    kept = known.filter(~F.col("expectation_name").endswith("3"))
    delivered = _incoming(spark, d).withColumn(
        "rule_id", F.sha2(F.concat_ws("|", "dataset_name", "expectation_name"), 256)
    )
    return (
        rule_history.versions(known)
        .unionByName(rule_history.versions(delivered))
        .unionByName(rule_history.changes(known, kept, datetime(2024, 2, 25)))
    )


_VERSIONS = f"""(SELECT dataset_name, expectation_name, severity, is_enabled,
        updated_at AS valid_from, CASE WHEN {_CHANGED} THEN TIMESTAMP '2024-02-20 00:00:00'
          WHEN id % 10 = 3 THEN TIMESTAMP '2024-02-25 00:00:00' END AS valid_to FROM rules
        UNION ALL SELECT dataset_name, expectation_name || suffix, 'low', is_enabled,
        TIMESTAMP '2024-02-20 00:00:00', NULL FROM rules, (VALUES (''), ('_b')) AS s(suffix)
        WHERE {_CHANGED})"""


@register(
    "rules_in_force",
    f"""SELECT dataset_name, expectation_name, severity, valid_from AS updated_at
        FROM {_VERSIONS} v WHERE is_enabled AND valid_from <= TIMESTAMP '2024-02-22 00:00:00'
        AND coalesce(valid_to > TIMESTAMP '2024-02-22 00:00:00', true)""",
)
def _(spark, d):
    return rule_history.in_force(_change_log(spark, d), datetime(2024, 2, 22)).select(
        "dataset_name", "expectation_name", "severity", "updated_at"
    )


@register(
    "rules_intervals",
    f"SELECT dataset_name, expectation_name, severity, valid_from, valid_to FROM {_VERSIONS} v",
)
def _(spark, d):
    spans = rule_history.intervals(_change_log(spark, d)).filter("change_type <> 'delete'")
    return spans.select("dataset_name", "expectation_name", "severity", "valid_from", "valid_to")


@register(
    "rules_of_own_day",
    f"""SELECT f.expectation_name, v.severity, v.valid_from, count(*) AS n_facts,
        sum(l_quantity) AS quantity
        FROM (SELECT 'rule_' || l_partkey AS expectation_name, l_quantity,
            TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(l_orderkey % 90 AS INTEGER))
              + to_hours(l_linenumber) AS at FROM lineitem) f
        LEFT JOIN {_VERSIONS} v ON v.expectation_name = f.expectation_name AND v.is_enabled
          AND v.valid_from <= f.at AND coalesce(f.at < v.valid_to, true)
        GROUP BY f.expectation_name, v.severity, v.valid_from""",
)
def _(spark, d):
    hours = F.col("l_linenumber").cast("int")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        (F.col("l_orderkey") % 90).cast("int"), hours
    )
    dataset = F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))
    part = table(spark, d, "part").select("p_partkey", dataset.alias("dataset_name"))
    facts = table(spark, d, "lineitem").select(
        "l_partkey",
        F.concat(F.lit("rule_"), F.col("l_partkey").cast("string")).alias("expectation_name"),
        "l_quantity",
        at.alias("at"),
    ).join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    judged = rule_history.judged(facts, _change_log(spark, d), "at")
    return judged.groupBy("expectation_name", "rule.severity", "rule.valid_from").agg(
        F.count("*").alias("n_facts"), F.sum("l_quantity").alias("quantity")
    )


@register(
    "rules_bulk_disable",
    f"""SELECT expectation_name,
        is_enabled AND NOT (dataset_name = 'brand_3' AND severity = 'high') AS is_enabled,
        CASE WHEN is_enabled AND dataset_name = 'brand_3' AND severity = 'high'
          THEN {NOW_SQL} ELSE updated_at END AS updated_at FROM rules""",
)
def _(spark, d):
    changed = rules.bulk_disable(testbed.rules_registry(spark, d), NOW, "brand_3", "high")
    return changed.select("expectation_name", "is_enabled", "updated_at")


@register(
    "rules_switch_and_delete",
    f"""SELECT expectation_name,
        CASE WHEN id = 5 THEN true WHEN id = 6 THEN false ELSE is_enabled END AS is_enabled,
        CASE WHEN id IN (5, 6) THEN {NOW_SQL} ELSE updated_at END AS updated_at
        FROM rules WHERE id <> 7""",
)
def _(spark, d):
    registry = testbed.rules_registry(spark, d)
    brand = table(spark, d, "part").select(
        "p_partkey", F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("dataset")
    )
    of = {r.p_partkey: r.dataset for r in brand.filter("p_partkey IN (5, 6, 7)").collect()}
    out = rules.enable(registry, rules.rule_id(of[5], "rule_5"), NOW)
    out = rules.disable(out, rules.rule_id(of[6], "rule_6"), NOW)
    out = rules.delete(out, rules.rule_id(of[7], "rule_7"))
    return out.select("expectation_name", "is_enabled", "updated_at")


@register(
    "rules_by_dataset",
    """SELECT dataset_name, count(*) AS total_rules, count(*) FILTER (is_enabled) AS active_rules,
        count(*) FILTER (NOT is_enabled) AS disabled_rules,
        array_to_string(list_sort(list(DISTINCT expectation_type)), ',') AS rule_types,
        array_to_string(list_sort(list(DISTINCT severity)), ',') AS severity_levels
        FROM rules GROUP BY dataset_name""",
)
def _(spark, d):
    return rules.by_dataset(testbed.rules_registry(spark, d))


@register(
    "rules_by_severity",
    """SELECT severity, count(*) AS rule_count, count(*) FILTER (is_enabled) AS active_count,
        array_to_string(list_sort(list(DISTINCT action)), ',') AS actions_used
        FROM rules GROUP BY severity""",
)
def _(spark, d):
    return rules.by_severity(testbed.rules_registry(spark, d))


@register(
    "rules_recent",
    """SELECT rule_id, dataset_name, expectation_name, is_enabled, updated_at, created_at,
        date_diff('day', CAST(created_at AS DATE), CAST(updated_at AS DATE))
          AS days_since_creation FROM rules ORDER BY updated_at DESC, rule_id LIMIT 20""",
)
def _(spark, d):
    return rules.recent(testbed.rules_registry(spark, d))


_OWN_RULES = (
    ("orders", "min_price", "range", "medium"),
    ("orders", "known_status", "valid_values", "high"),
    ("orders", "customer_in_credit", "foreign_key", "critical"),
    ("lineitem", "small_discount", "range", "low"),
    ("lineitem", "min_quantity", "range", "medium"),
    ("customer", "never_checked", "custom", "low"),
)


@register(
    "rules_status",
    f"""WITH r AS (SELECT * FROM (VALUES {", ".join(str(r) for r in _OWN_RULES)})
          AS t(dataset_name, expectation_name, expectation_type, severity)),
        c AS (SELECT dataset_name, expectation_name, count(*) AS n,
          count(*) FILTER (failed > 0) AS f FROM qm
          WHERE moment >= {QUALITY_AT} - INTERVAL 7 DAYS AND moment <= {QUALITY_AT}
          GROUP BY ALL)
        SELECT r.dataset_name, r.expectation_name, expectation_type, severity, true AS is_enabled,
        coalesce(n, 0) AS times_checked, coalesce(f, 0) AS times_failed,
        coalesce({pct('n - f', 'n')}, 100.0::DOUBLE) AS pass_rate
        FROM r LEFT JOIN c ON r.dataset_name = c.dataset_name
          AND r.expectation_name = c.expectation_name""",
)
def _(spark, d):
    own = rules.as_rows(
        spark,
        [
            rules.create_rule(ds, name, kind, "true", severity=severity, now=NOW)
            for ds, name, kind, severity in _OWN_RULES
        ],
    )
    return quality.rules_status(own, inputs.quality(spark, d), QUALITY_AS_OF)


# ---------------------------------------------------------------- lineage

ROOT_NAME = "cat_1.sch_4.t_49"


def _walk(direction: str, depth: int, edge: str = "edge", root: str = ROOT_NAME) -> str:
    """Recursive closure with the first level of every node, without the root."""
    here, there = ("src", "dst") if direction == "down" else ("dst", "src")
    return f"""WITH RECURSIVE walk AS (SELECT '{root}' AS node, 0 AS depth
        UNION SELECT e.{there}, w.depth + 1 FROM walk w JOIN {edge} e ON e.{here} = w.node
        WHERE w.depth < {depth}),
        found AS (SELECT node, min(depth) AS depth FROM walk GROUP BY node
          HAVING node <> '{root}')"""


@register(
    "lineage_upstream", f"{_walk('up', 3)} SELECT node AS table_name, depth FROM found"
)
def _(spark, d):
    return lineage.upstream(inputs.lineage(spark, d), ROOT_NAME)


@register(
    "lineage_downstream", f"{_walk('down', 3)} SELECT node AS table_name, depth FROM found"
)
def _(spark, d):
    return lineage.downstream(inputs.lineage(spark, d), ROOT_NAME)


@register(
    "lineage_paths",
    f"""WITH RECURSIVE up AS (SELECT src AS table_name, dst AS reference_table, 1 AS depth,
          [src] AS path FROM edge WHERE dst = '{ROOT_NAME}'
        UNION ALL SELECT e.src, e.dst, u.depth + 1, list_append(u.path, e.src)
          FROM up u JOIN edge e ON e.dst = u.table_name
          WHERE u.depth < 3 AND NOT list_contains(u.path, e.src))
        SELECT DISTINCT table_name, reference_table, depth,
        array_to_string(path, ',') AS path FROM up""",
)
def _(spark, d):
    return lineage.upstream_paths(inputs.lineage(spark, d), ROOT_NAME)


@register(
    "column_lineage",
    f"""SELECT src AS source_table_full_name, src_col AS source_column_name,
        dst AS target_table_full_name, dst_col AS target_column_name, source_type
        FROM lin WHERE dst = '{ROOT_NAME}'""",
)
def _(spark, d):
    return lineage.column_sources(testbed.column_lineage(spark, d), ROOT_NAME)


@register(
    "column_impact",
    f"""{_walk('down', 5, 'cedge', ROOT_NAME + '#c_1')}
        SELECT split_part(node, '#', 1) AS table_name, split_part(node, '#', 2) AS column_name,
        depth FROM found""",
)
def _(spark, d):
    return lineage.column_impact(testbed.column_lineage(spark, d), ROOT_NAME, "c_1")


_ENDS = """SELECT DISTINCT dst FROM edge WHERE src IN (SELECT node FROM found)
    AND dst NOT IN (SELECT node FROM found)"""


@register("impact_critical_endpoints", f"{_walk('down', 5)} SELECT dst AS endpoint FROM ({_ENDS})")
def _(spark, d):
    return lineage.critical_endpoints(inputs.lineage(spark, d), ROOT_NAME)


@register(
    "impact_affected_schemas",
    f"""{_walk('down', 5)} SELECT split_part(node, '.', 1) AS catalog,
        split_part(node, '.', 1) || '.' || split_part(node, '.', 2) AS schema,
        count(*) AS tables FROM found GROUP BY 1, 2""",
)
def _(spark, d):
    return lineage.affected_schemas(inputs.lineage(spark, d), ROOT_NAME)


@register(
    "impact_summary",
    f"""{_walk('down', 5)} SELECT '{ROOT_NAME}' AS "table", count(*) AS total_downstream,
        count(DISTINCT split_part(node, '.', 1)) AS affected_catalogs,
        count(DISTINCT split_part(node, '.', 1) || '.' || split_part(node, '.', 2))
          AS affected_schemas, (SELECT count(*) FROM ({_ENDS})) AS critical_endpoints
        FROM found""",
)
def _(spark, d):
    return lineage.impact_summary(inputs.lineage(spark, d), ROOT_NAME)


_AROUND = f"""WITH RECURSIVE dn AS (SELECT '{ROOT_NAME}' AS node, 0 AS depth
      UNION SELECT e.dst, w.depth + 1 FROM dn w JOIN edge e ON e.src = w.node WHERE w.depth < 3),
    up AS (SELECT '{ROOT_NAME}' AS node, 0 AS depth
      UNION SELECT e.src, w.depth + 1 FROM up w JOIN edge e ON e.dst = w.node WHERE w.depth < 3),
    d AS (SELECT node, min(depth) AS depth FROM dn GROUP BY node),
    u AS (SELECT node, -min(depth) AS depth FROM up GROUP BY node),
    nodes AS (SELECT node, CASE WHEN depth = 0 THEN 'center' ELSE 'downstream' END AS node_type,
        depth FROM d
      UNION ALL SELECT node, 'upstream', depth FROM u WHERE node NOT IN (SELECT node FROM d))"""


@register("lineage_nodes", f"{_AROUND} SELECT node, node_type, depth FROM nodes")
def _(spark, d):
    return lineage.graph_nodes(inputs.lineage(spark, d), ROOT_NAME)


@register(
    "lineage_subgraph_edges",
    f"""{_AROUND} SELECT src, dst FROM edge WHERE src IN (SELECT node FROM nodes)
        AND dst IN (SELECT node FROM nodes)""",
)
def _(spark, d):
    return lineage.graph_edges(inputs.lineage(spark, d), ROOT_NAME)


@register(
    "lineage_adjacency",
    f"""SELECT node_id, 'table' AS node_type, split_part(node_id, '.', 3) AS node_name, side,
        neighbour, {EVENTS_AT} AS last_updated
        FROM (SELECT src AS node_id, 'downstream' AS side, dst AS neighbour FROM edge
              UNION ALL SELECT dst, 'upstream', src FROM edge)""",
)
def _(spark, d):
    return lineage.adjacency(inputs.lineage(spark, d), EVENTS_AS_OF)


@register(
    "most_connected",
    """WITH n AS (SELECT src AS t, 0 AS u, 1 AS v FROM edge UNION ALL SELECT dst, 1, 0 FROM edge)
        SELECT t AS table_name, CAST(sum(u) AS BIGINT) AS upstream_count, CAST(sum(v) AS BIGINT) AS downstream_count,
        count(*) AS total_connections FROM n GROUP BY t
        ORDER BY total_connections DESC, table_name LIMIT 25""",
)
def _(spark, d):
    return lineage.most_connected(inputs.lineage(spark, d))


@register(
    "lineage_source_tables",
    "SELECT DISTINCT src AS source_table FROM edge WHERE src NOT IN (SELECT dst FROM edge)",
)
def _(spark, d):
    return lineage.source_tables(inputs.lineage(spark, d))


@register(
    "lineage_end_consumers",
    "SELECT DISTINCT dst AS end_consumer_table FROM edge WHERE dst NOT IN (SELECT src FROM edge)",
)
def _(spark, d):
    return lineage.end_consumers(inputs.lineage(spark, d))


@register(
    "lineage_by_source_type",
    """SELECT source_type, count(DISTINCT src) AS unique_source_tables,
        count(DISTINCT dst) AS unique_target_tables, count(*) AS total_lineage_records
        FROM lin GROUP BY source_type""",
)
def _(spark, d):
    return lineage.by_source_type(inputs.lineage(spark, d))


@register(
    "cross_catalog",
    """SELECT src_cat AS source_table_catalog, dst_cat AS target_table_catalog,
        count(*) AS lineage_count FROM lin WHERE src_cat <> dst_cat GROUP BY 1, 2""",
)
def _(spark, d):
    return lineage.cross_catalog(inputs.lineage(spark, d))


@register(
    "lineage_cycles",
    """WITH RECURSIVE r AS (SELECT src AS a, dst AS b FROM edge
          UNION SELECT r.a, e.dst FROM r JOIN edge e ON e.src = r.b),
        m AS (SELECT x.a AS node, min(x.b) AS cycle_id, count(DISTINCT x.b) AS cycle_size
          FROM r x JOIN r y ON x.a = y.b AND x.b = y.a GROUP BY x.a)
        SELECT node AS table_name, cycle_id, cycle_size FROM m""",
)
def _(spark, d):
    return lineage.cycles(inputs.lineage(spark, d))
