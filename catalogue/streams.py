"""Streaming jobs run to the end of their input, compared with the batch statement.

A window is emitted once the watermark (largest event time minus ten minutes) has
passed its end; the SQL states the same condition.
"""

from catalogue.base_sql import pct
from catalogue.registry import register
from pyspark.sql import functions as F
from vigil.operators.expectations import Expectation
from vigil.plans.scratch import scratch_path
from vigil.sources import testbed
from vigil.sources.testbed import table
from vigil.streaming import jobs as streams

DONE = "(SELECT max(ts) - INTERVAL 10 MINUTES FROM events)"


def _source(spark, d):
    """The events folder as a stream."""
    schema = table(spark, d, "events").schema
    return streams.source(spark, d, schema, "ts", pattern="events.parquet")


def _runs(events):
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    state = (
        F.when(kind == "error", "FAILED")
        .when((kind == "signup") & (k < 50), "TIMEDOUT")
        .when(kind == "signup", "CANCELED")
        .otherwise("SUCCESS")
    )
    return events.select(
        (F.col("user_id") % 25).alias("job_id"),
        F.col("event_id").alias("run_id"),
        F.col("ts").alias("start_time"),
        state.alias("result_state"),
    )


@register("stream_ingest", "SELECT event_id, ts, event_type FROM events")
def _(spark, d):
    return streams.collected(_source(spark, d), "ingest").select("event_id", "ts", "event_type")


@register("stream_dedup", "SELECT event_id, ts FROM events")
def _(spark, d):
    """Every event is delivered twice; each arrives once."""
    twice = _source(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = streams.deduplicated(twice, ["event_id"], "ts")
    return streams.collected(unique, "dedup").select("event_id", "ts")


@register(
    "stream_throughput",
    f"""SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type,
        count(*) AS events FROM (SELECT date_trunc('hour', ts) AS window_start, event_type
          FROM events) WHERE window_start + INTERVAL 1 HOUR <= {DONE} GROUP BY ALL""",
)
def _(spark, d):
    return streams.collected(
        streams.throughput(_source(spark, d), "ts", ["event_type"]), "throughput"
    )


@register(
    "stream_quality",
    f"""SELECT window_start, pipeline_name, expectation_name, CAST(sum(passed) AS BIGINT) AS passed_records,
        CAST(sum(failed) AS BIGINT) AS failed_records,
        {pct('sum(passed)', 'sum(passed) + sum(failed)')} AS quality_score
        FROM (SELECT *, date_trunc('day', moment) AS window_start FROM results_all)
        WHERE window_start + INTERVAL 1 DAY <= {DONE} GROUP BY ALL""",
)
def _(spark, d):
    flow = F.concat(F.lit("flow_"), (F.col("user_id") % 6).cast("string"))
    kind = F.when(F.col("event_type").isin("click", "signup"), "update_progress").otherwise(
        "flow_progress"
    )
    log = (
        _source(spark, d)
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .select(
            F.col("ts").alias("timestamp"),
            F.struct(flow.alias("pipeline_name")).alias("origin"),
            kind.alias("event_type"),
            testbed.event_details().alias("details"),
        )
    )
    return streams.collected(streams.quality(log), "quality")


@register(
    "stream_failure_rate",
    f"""WITH w AS (SELECT unnest(generate_series(
            time_bucket(INTERVAL 5 MINUTES, start_time) - INTERVAL 55 MINUTES,
            time_bucket(INTERVAL 5 MINUTES, start_time), INTERVAL 5 MINUTES)) AS window_start,
          result_state <> 'SUCCESS' AS bad FROM jobs_all)
        SELECT window_start, count(*) AS total_runs, count(*) FILTER (bad) AS failed_runs,
        {pct('count(*) FILTER (bad)', 'count(*)')} AS failure_rate FROM w
        WHERE window_start + INTERVAL 1 HOUR <= {DONE} GROUP BY window_start""",
)
def _(spark, d):
    return streams.collected(streams.failure_rate(_runs(_source(spark, d))), "failure-rate")


@register(
    "stream_sessions",
    f"""WITH m AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 12 HOURS
            OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts
            ROWS UNBOUNDED PRECEDING) AS s FROM m)
        SELECT min(ts) AS session_start, max(ts) + INTERVAL 12 HOURS AS session_end, user_id,
        count(*) AS events FROM n GROUP BY user_id, s
        HAVING max(ts) + INTERVAL 12 HOURS <= {DONE}""",
)
def _(spark, d):
    return streams.collected(
        streams.sessions(_source(spark, d), "ts", ["user_id"], "12 hours"), "sessions"
    )


@register(
    "stream_expectations",
    """SELECT event_id, concat_ws(',', CASE WHEN NOT value >= 20 THEN 'min_value' END,
          CASE WHEN user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
            THEN 'known_user' END) AS dropped_by,
        CASE WHEN event_type <> 'error' THEN '' ELSE 'no_error' END AS warned_by,
        value >= 20 AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS kept
        FROM events""",
)
def _(spark, d):
    rules = [
        Expectation("min_value", "value >= 20", "drop"),
        Expectation("no_error", "event_type <> 'error'", "warn"),
        Expectation("known_user", "", "drop", fk=("user_id", "customers", "c_custkey")),
    ]
    known = table(spark, d, "customer").filter("c_acctbal >= 0").select("c_custkey")
    marked = streams.expectations(_source(spark, d), rules, {"customers": known})
    out = streams.collected(marked, "expectations")
    return out.select("event_id", "dropped_by", "warned_by", "kept")


def _delivered(spark, d, slices=4):
    """The events as a stream of files: in slices by time, some rows up to five minutes late and
    so in a later file, and the second file delivered again after the third."""
    events = table(spark, d, "events")
    late = F.make_dt_interval(secs=F.pmod(F.xxhash64("event_id"), F.lit(300)))
    due = events.withColumn("due", F.unix_micros((F.col("ts") + late).cast("timestamp")))
    span = due.agg(F.min("due"), F.max("due")).first()
    if span[0] is None:
        span = (0, 0)
    width = (span[1] - span[0]) // slices + 1
    path = scratch_path(spark, "delivered")
    sliced = due.withColumn("slice", F.floor((F.col("due") - span[0]) / width))
    for number in [*range(slices - 1), 1, slices - 1]:
        part = sliced.filter(F.col("slice") == number).drop("due", "slice")
        part.coalesce(1).write.mode("append").parquet(path)
    return streams.source(spark, path, events.schema, "ts", files_per_batch=1)


@register(
    "stream_failure_streaks",
    f"""WITH n AS (SELECT *, result_state <> 'SUCCESS' AS bad, sum(CASE WHEN result_state = 'SUCCESS'
            THEN 1 ELSE 0 END) OVER (PARTITION BY job_id ORDER BY start_time, run_id
            ROWS UNBOUNDED PRECEDING) AS island FROM jobs_all),
        p AS (SELECT *, row_number() OVER (PARTITION BY job_id, island
            ORDER BY start_time, run_id) AS place FROM n WHERE bad)
        SELECT job_id, run_id, start_time AS reached_at FROM p WHERE place = 3
        AND date_trunc('hour', start_time) + INTERVAL 1 HOUR <= {DONE}""",
)
def _(spark, d):
    return streams.collected(streams.failure_streaks(_runs(_delivered(spark, d))), "streaks")
