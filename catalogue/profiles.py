"""Profiles, drift and prediction quality."""

from datetime import datetime

from catalogue.base_sql import EVENTS_AT, pct
from catalogue.registry import register
from pyspark.sql import functions as F
from vigil.operators import bulk_profile, drift, inference, profile
from vigil.operators.profile import Metric
from vigil.sources import testbed
from vigil.sources.testbed import table

SPLIT = datetime(2024, 1, 16)
SPLIT_SQL = "TIMESTAMP '2024-01-16 00:00:00'"

# Floating-point sums depend on row order in their last digits; the comparison rounds,
# a little off zero so that exact half-way means fall on the same side.
DIGITS = {"avg": 4, "stddev": 3, "drift_score": 6}
OFF = 1e-9


def _rounded(df):
    return df.withColumns(
        {c: F.round(F.col(c) + OFF, n) for c, n in DIGITS.items() if c in df.columns}
    )


def _column(name: str, kind: str, source: str, keys: str = "", distinct: bool = True) -> str:
    """Profile row of one column; ``kind`` is num, text or nested."""
    number, text = kind == "num", kind == "text"
    fields = [
        *([keys] if keys else []),
        f"'{name}' AS column_name",
        "count(*) AS row_count",
        f"count(*) - count({name}) AS null_count",
        f"{pct(f'count(*) - count({name})', 'count(*)')} AS null_percentage",
        *([f"count(DISTINCT {name}) AS num_distinct"] if distinct else []),
        (f"CAST(min({name}) AS DOUBLE) + 0.0" if number else "CAST(NULL AS DOUBLE)") + ' AS "min"',
        (f"CAST(max({name}) AS DOUBLE) + 0.0" if number else "CAST(NULL AS DOUBLE)") + ' AS "max"',
        (f"CAST(min({name}) AS VARCHAR)" if text else "CAST(NULL AS VARCHAR)") + " AS min_text",
        (f"CAST(max({name}) AS VARCHAR)" if text else "CAST(NULL AS VARCHAR)") + " AS max_text",
        (f"round(avg(CAST({name} AS DOUBLE)) + {OFF}, 4)" if number else "CAST(NULL AS DOUBLE)")
        + ' AS "avg"',
        (f"round(stddev_samp(CAST({name} AS DOUBLE)) + {OFF}, 3)" if number else "CAST(NULL AS DOUBLE)")
        + ' AS "stddev"',
    ]
    group = " GROUP BY ALL" if keys else ""
    return f"SELECT {', '.join(fields)} FROM {source}{group}"


def _profile(source: str, columns: dict[str, str], keys: str = "", distinct: bool = True) -> str:
    return " UNION ALL ".join(
        _column(name, kind, source, keys, distinct) for name, kind in columns.items()
    )


LINE_COLUMNS = {
    "l_orderkey": "num",
    "l_linenumber": "num",
    "l_quantity": "num",
    "l_extendedprice": "num",
    "l_discount": "num",
    "l_returnflag": "text",
}


@register("profile_snapshot", _profile("lineitem", LINE_COLUMNS))
def _(spark, d):
    return _rounded(profile.snapshot(table(spark, d, "lineitem"), list(LINE_COLUMNS)))


EVENT_COLUMNS = {"user_id": "num", "value": "num", "event_type": "text"}


def _events(spark, d):
    return table(spark, d, "events").select("ts", *EVENT_COLUMNS)


_DAY = "'1 day' AS granularity, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start"
_HALF_HOUR = (
    "'30 minutes' AS granularity, time_bucket(INTERVAL 30 MINUTES, ts) AS window_start"
)


@register("profile_timeseries", _profile("events", EVENT_COLUMNS, _DAY))
def _(spark, d):
    return _rounded(profile.time_series(_events(spark, d), "ts"))


@register(
    "profile_multi_granularity",
    _profile("events", EVENT_COLUMNS, _DAY)
    + " UNION ALL "
    + _profile("events", EVENT_COLUMNS, _HALF_HOUR),
)
def _(spark, d):
    return _rounded(profile.time_series(_events(spark, d), "ts", ["30 minutes", "1 day"]))


@register(
    "profile_sliced",
    " UNION ALL ".join(
        (
            _profile(
                "events", EVENT_COLUMNS,
                "CAST(NULL AS VARCHAR) AS slice_key, CAST(NULL AS VARCHAR) AS slice_value",
            ),
            _profile(
                "events", EVENT_COLUMNS,
                "'event_type' AS slice_key, event_type AS slice_value",
            ),
            _profile(
                "events", EVENT_COLUMNS,
                "'value > 100' AS slice_key, CAST(value > 100 AS VARCHAR) AS slice_value",
            ),
        )
    ),
)
def _(spark, d):
    sliced = profile.sliced(
        table(spark, d, "events"), ["event_type", "value > 100"], list(EVENT_COLUMNS)
    )
    return _rounded(sliced)


@register(
    "profile_custom_metric",
    f"""WITH m AS (SELECT event_type, sum(CAST(value AS DECIMAL(18,2))) AS s, count(*) AS n,
          count(*) FILTER (value > 100) AS big FROM events WHERE ts >= {SPLIT_SQL} GROUP BY 1),
        b AS (SELECT sum(CAST(value AS DECIMAL(18,2))) AS s, count(*) AS n FROM events
          WHERE ts < {SPLIT_SQL})
        SELECT event_type, CAST(m.s AS DOUBLE) AS total, m.n AS records, big AS large,
        CAST(big AS DOUBLE) / m.n AS large_share, CAST(m.s AS DOUBLE) / m.n AS mean_value,
        CAST(m.s AS DOUBLE) / m.n - CAST(b.s AS DOUBLE) / b.n AS mean_shift FROM m, b""",
)
def _(spark, d):
    sides = drift.split_at(table(spark, d, "events"), "ts", SPLIT)
    metrics = [
        Metric("total", "aggregate", "cast(sum(cast(value as decimal(18,2))) as double)"),
        Metric("records", "aggregate", "count(*)"),
        Metric("large", "aggregate", "count_if(value > 100)"),
        Metric("large_share", "derived", "large / records"),
        Metric("mean_value", "derived", "total / records"),
        Metric("mean_shift", "drift", "mean_value - baseline_mean_value"),
    ]
    out = profile.custom(
        sides["current"], metrics, {"event_type": F.col("event_type")}, sides["baseline"]
    )
    return out.select("event_type", *[m.name for m in metrics])


@register(
    "column_stats_over_time",
    f"""SELECT window_start AS time_window, column_name, null_count, null_percentage,
        num_distinct, "min", "max", "avg", "stddev" FROM ({_profile("events", EVENT_COLUMNS, _DAY)})
        """,
)
def _(spark, d):
    return _rounded(profile.over_time(profile.time_series(_events(spark, d), "ts")))


@register(
    "profile_newest",
    f"""SELECT window_start, column_name, null_count, "min", "max"
        FROM ({_profile("events", EVENT_COLUMNS, _DAY)})
        ORDER BY window_start DESC, column_name LIMIT 20""",
)
def _(spark, d):
    series = profile.time_series(_events(spark, d), "ts")
    return profile.newest(series, 20).select("window_start", "column_name", "null_count", "min", "max")


ALL_TABLES = {
    "region": {"r_regionkey": "num", "r_name": "text"},
    "nation": {"n_nationkey": "num", "n_name": "text", "n_regionkey": "num"},
    "customer": {
        "c_custkey": "num", "c_name": "text", "c_nationkey": "num", "c_acctbal": "num",
        "c_mktsegment": "text",
    },
    "supplier": {"s_suppkey": "num", "s_name": "text", "s_nationkey": "num", "s_acctbal": "num"},
    "part": {
        "p_partkey": "num", "p_name": "text", "p_brand": "text", "p_type": "text",
        "p_size": "num", "p_retailprice": "num",
    },
    "lineitem": {
        "l_orderkey": "num", "l_partkey": "num", "l_suppkey": "num", "l_linenumber": "num",
        "l_quantity": "num", "l_extendedprice": "num", "l_discount": "num", "l_tax": "num",
        "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "text",
    },
    "documents": {
        "doc_id": "num", "text": "text", "lang": "text", "source": "text", "n_chars": "num",
    },
    "embeddings": {"vec_id": "num", "embedding": "nested", "label": "num"},
    "pages": {"page_id": "num", "url": "text", "html": "text"},
    "benchmark": {"item_id": "num", "text": "text"},
    "labels": {"doc_id": "num", "quality": "num", "toxic": "num"},
    "conversations": {"conv_id": "num", "turn": "num", "role": "text", "text": "text"},
}


def _all_tables_sql() -> str:
    none = "CAST(NULL AS VARCHAR) AS granularity, CAST(NULL AS TIMESTAMP) AS window_start"
    parts = [
        f"SELECT '{name}' AS table_name, {none}, * FROM ({_profile(name, cols, distinct=False)})"
        for name, cols in ALL_TABLES.items()
    ]
    series = {**EVENT_COLUMNS, "event_id": "num", "props": "text"}
    parts.append(
        f"SELECT 'events' AS table_name, * FROM "
        f"({_profile('events', series, _DAY, distinct=False)})"
    )
    kept = 'table_name, granularity, window_start, column_name, row_count, null_count, "min", "max"'
    digests = "md5(min_text) AS min_text, md5(max_text) AS max_text"
    return f'SELECT {kept}, {digests} FROM ({" UNION ALL ".join(parts)})'


@register("profile_all_tables", _all_tables_sql())
def _(spark, d):
    names = [*ALL_TABLES, "events", "orders"]
    out = profile.all_tables(
        {n: table(spark, d, n) for n in names}, {"events": "ts"}, exclude=["orders"]
    )
    return out.select(
        "table_name", "granularity", "window_start", "column_name", "row_count", "null_count",
        "min", "max", F.md5("min_text").alias("min_text"), F.md5("max_text").alias("max_text"),
    )


_KINDS = {**{n: "created_snapshot" for n in ALL_TABLES}, "events": "created_timeseries"}


@register(
    "profile_outcomes",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, '{kind}' AS status, NULL AS error_class,
        count(*) AS profiled_rows FROM {n}"""
        for n, kind in _KINDS.items()
    )
    + """ UNION ALL SELECT 'orders', 'excluded', NULL, NULL
        UNION ALL SELECT 'not_there', 'failed', 'PATH_NOT_FOUND', NULL""",
)
def _(spark, d):
    def reads(name):
        return lambda: table(spark, d, name)

    names = [*_KINDS, "orders", "not_there"]
    out = bulk_profile.run(spark, {n: reads(n) for n in names}, {"events": "ts"}, ["orders"])
    return out.outcomes.select("table_name", "status", "error_class", "profiled_rows")


# ---------------------------------------------------------------- drift


def _scores(pairs: str, keys: str = "") -> str:
    """Share measures over rows (b, c, nb, nc), from doubles p and q."""
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}
        sum(abs(p - q)) / 2 AS tv,
        sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
           + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2) AS js,
        sum(CASE WHEN b + c > 0 THEN pow(b * sqrt(nc / nb) - c * sqrt(nb / nc), 2) / (b + c) END)
          AS chi
        FROM (SELECT *, b / nb AS p, c / nc AS q FROM ({pairs})) {group}"""


def _long(scores: str, column: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{column}' AS column_name, '{kind}' AS drift_type, "
        f"round({col} + {OFF}, 6) AS drift_score, 0.1::DOUBLE AS threshold FROM ({scores})"
        for kind, col in (("total_variation", "tv"), ("jensen_shannon", "js"), ("chi_square", "chi"))
    )


def _sides(value: str, source: str = "events", baseline: str = f"ts < {SPLIT_SQL}") -> str:
    return f"""SELECT v, b, c, sum(b) OVER () AS nb, sum(c) OVER () AS nc FROM (
        SELECT {value} AS v, count(*) FILTER ({baseline}) AS b,
        count(*) FILTER (NOT ({baseline})) AS c FROM {source} GROUP BY 1)"""


_CATEGORICAL = _long(_scores(_sides("event_type")), "event_type")


@register("drift_baseline_categorical", _CATEGORICAL)
def _(spark, d):
    sides = drift.split_at(table(spark, d, "events"), "ts", SPLIT)
    return _rounded(drift.categorical(sides["baseline"], sides["current"], "event_type"))


_LIMITS = f"(SELECT min(value) AS lo, max(value) AS hi FROM events WHERE ts < {SPLIT_SQL})"
_BIN = """CASE WHEN value < lo THEN 0 WHEN value > hi THEN 21 WHEN value = hi THEN 20
    ELSE least(CAST(floor((value - lo) / ((hi - lo) / 20)) AS INTEGER) + 1, 20) END"""
_BINNED = _long(_scores(_sides(_BIN, f"events, {_LIMITS}")), "value")
_WALK = f"""SELECT v, sum(b) OVER w / nb AS f, sum(c) OVER w / nc AS g, lead(v) OVER (ORDER BY v)
    AS nxt FROM ({_sides('value')}) WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING)"""
_EXACT = f"""SELECT 'value' AS column_name, 'kolmogorov_smirnov' AS drift_type,
    round(max(abs(f - g)) + {OFF}, 6) AS drift_score, 0.1::DOUBLE AS threshold FROM ({_WALK})
    UNION ALL SELECT 'value', 'wasserstein', round(sum(abs(f - g) * (nxt - v)) + {OFF}, 6), 0.1::DOUBLE
    FROM ({_WALK})"""


@register("drift_baseline_numeric", f"{_BINNED} UNION ALL {_EXACT}")
def _(spark, d):
    sides = drift.split_at(table(spark, d, "events"), "ts", SPLIT)
    return _rounded(drift.numeric(sides["baseline"], sides["current"], "value"))


@register(
    "drift_texts",
    _long(_scores(_sides("lang", "documents", "doc_id % 2 = 0")), "lang"),
)
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    even = F.col("doc_id") % 2 == 0
    return _rounded(drift.categorical(docs.filter(even), docs.filter(~even), "lang"))


_DAILY = """SELECT w, v, sum(b) AS b, sum(c) AS c FROM (
      SELECT date_trunc('day', ts) AS w, event_type AS v, 0 AS b, count(*) AS c FROM events
      GROUP BY 1, 2
      UNION ALL SELECT date_trunc('day', ts) + INTERVAL 1 DAY, event_type, count(*), 0
      FROM events GROUP BY 1, 2) GROUP BY w, v"""
_CONSECUTIVE = _long(
    _scores(
        f"""SELECT CAST(w AS TIMESTAMP) AS window_start, * FROM (
            SELECT w, v, b, c, sum(b) OVER (PARTITION BY w) AS nb,
            sum(c) OVER (PARTITION BY w) AS nc FROM ({_DAILY})) WHERE nb > 0 AND nc > 0""",
        "window_start",
    ),
    "event_type",
    "window_start",
)


@register("drift_consecutive", _CONSECUTIVE)
def _(spark, d):
    return _rounded(drift.consecutive(table(spark, d, "events"), "ts", "event_type"))


_DAILY_BINS = f"""SELECT w, v, sum(b) AS b, sum(c) AS c FROM (
      SELECT w, {_BIN} AS v, b, c FROM (
        SELECT date_trunc('day', ts) AS w, value, 0 AS b, 1 AS c FROM events
        UNION ALL SELECT date_trunc('day', ts) + INTERVAL 1 DAY, value, 1, 0 FROM events) e
      JOIN (SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS day, min(value) AS lo,
              max(value) AS hi FROM events GROUP BY 1) r ON e.w = r.day) GROUP BY w, v"""


@register(
    "drift_consecutive_numeric",
    _long(
        _scores(
            f"""SELECT CAST(w AS TIMESTAMP) AS window_start, * FROM (
                SELECT w, v, b, c, sum(b) OVER (PARTITION BY w) AS nb,
                sum(c) OVER (PARTITION BY w) AS nc FROM ({_DAILY_BINS})) WHERE nb > 0 AND nc > 0""",
            "window_start",
        ),
        "value",
        "window_start",
    ),
)
def _(spark, d):
    return _rounded(drift.consecutive_numeric(table(spark, d, "events"), "ts", "value"))


@register(
    "profile_monthly",
    _profile(
        "events", EVENT_COLUMNS,
        "'1 month' AS granularity, CAST(date_trunc('month', ts) AS TIMESTAMP) AS window_start",
    ),
)
def _(spark, d):
    return _rounded(profile.time_series(_events(spark, d), "ts", ["1 month"]))


@register(
    "drift_status",
    f"""SELECT *, CASE WHEN drift_score > threshold THEN 'DRIFT_DETECTED' ELSE 'NO_DRIFT' END
        AS drift_status FROM ({_CONSECUTIVE})""",
)
def _(spark, d):
    found = drift.consecutive(table(spark, d, "events"), "ts", "event_type")
    return _rounded(drift.with_status(found))


# ---------------------------------------------------------------- predictions


@register(
    "inference_classification",
    f"""WITH g AS (SELECT window_start, model_id, count(*) AS predictions, count(y) AS labelled,
          count(*) FILTER (p = y) AS correct, count(*) FILTER (p = 1 AND y = 1) AS tp,
          count(*) FILTER (p = 1 AND y <> 1) AS fp, count(*) FILTER (p <> 1 AND y = 1) AS fn,
          count(*) FILTER (p <> 1 AND y <> 1) AS tn FROM cls GROUP BY ALL)
        SELECT window_start, model_id, predictions, labelled, correct, tp AS true_positives,
        fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
        {pct('correct', 'labelled')} AS accuracy, {pct('tp', 'tp + fp')} AS precision,
        {pct('tp', 'tp + fn')} AS recall, {pct('2 * tp', '2 * tp + fp + fn')} AS f1 FROM g""",
)
def _(spark, d):
    return inference.monitor(testbed.classification_log(spark, d), "classification")


@register(
    "inference_confusion",
    """SELECT window_start, model_id, p AS prediction, y AS label, count(*) AS records
        FROM cls WHERE y IS NOT NULL GROUP BY ALL""",
)
def _(spark, d):
    return inference.confusion(testbed.classification_log(spark, d))


ERROR_DIGITS = {"mae": 3, "mse": -2, "rmse": 2, "r2": 4, "mape": 3}


@register(
    "inference_regression",
    f"""WITH g AS (SELECT time_bucket(INTERVAL 90 DAYS, window_start, TIMESTAMP '1970-01-01')
          AS window_start, model_id, count(*) AS n,
          CAST(sum(abs(p - y)) AS DOUBLE) AS a, CAST(sum((p - y) * (p - y)) AS DOUBLE) AS s,
          var_pop(CAST(y AS DOUBLE)) * count(*) AS spread,
          avg(CAST(abs(p - y) AS DOUBLE) / CAST(abs(y) AS DOUBLE)) AS ape FROM reg GROUP BY ALL)
        SELECT window_start, model_id, n AS labelled, round(a / n + {OFF}, 3) AS mae,
        round(s / n + {OFF}, -2) AS mse, round(sqrt(s / n) + {OFF}, 2) AS rmse,
        round(1 - s / nullif(spread, 0) + {OFF}, 4) AS r2, round(ape * 100 + {OFF}, 3) AS mape
        FROM g""",
)
def _(spark, d):
    out = inference.monitor(testbed.regression_log(spark, d), "regression", granularity="90 days")
    return out.withColumns({c: F.round(F.col(c) + OFF, n) for c, n in ERROR_DIGITS.items()})
