"""Streaming jobs: incremental ingest, live metrics, expectations and alerts.

Sources are append-only Parquet folders read in bounded batches. Event times are cast
to zoned timestamps (the session zone is UTC), as watermarks require. Jobs run to the
end of the available input and stop; started with another trigger they keep running.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vigil.functions.exprs import is_failure, percent
from vigil.operators.expectations import Expectation, flagged
from vigil.operators.event_log import parsed, results
from vigil.plans.scratch import scratch_path
from vigil.settings import DEFAULTS

DELAY = "10 minutes"


def source(
    spark: SparkSession,
    path: str,
    schema: StructType,
    event_time: str,
    pattern: str | None = None,
    files_per_batch: int = DEFAULTS.batch_files,
) -> DataFrame:
    """Stream over the Parquet files of a folder, at most ``files_per_batch`` at a time."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path).withColumn(event_time, F.col(event_time).cast("timestamp"))


def run_to_files(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over everything available into Parquet files, exactly once."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def collected(df: DataFrame, label: str) -> DataFrame:
    """Run a stream to the end and read its output back as a table."""
    spark = df.sparkSession
    base = scratch_path(spark, label)
    run_to_files(df, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``; it must be repeatable per batch id."""
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def deduplicated(df: DataFrame, keys: Sequence[str], event_time: str, delay: str = DELAY):
    """Drop re-delivered events; state is bounded by the watermark."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def throughput(
    df: DataFrame, event_time: str, keys: Sequence[str], width: str = "1 hour", delay: str = DELAY
) -> DataFrame:
    """Events per tumbling window and key."""
    return (
        df.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, width).alias("w"), *keys)
        .agg(F.count("*").alias("events"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *keys,
            "events",
        )
    )


def quality(events: DataFrame, width: str = "1 day", delay: str = DELAY) -> DataFrame:
    """Expectation results per tumbling window, pipeline and expectation."""
    each = (
        parsed(events.withWatermark("timestamp", delay))
        .filter(F.col("event_type") == "flow_progress")
        .select(
            "timestamp",
            F.col("origin.pipeline_name").alias("pipeline_name"),
            results("_d").alias("x"),
        )
        .filter(F.col("x").isNotNull())
    )
    return (
        each.groupBy(
            F.window("timestamp", width).alias("w"),
            "pipeline_name",
            F.col("x.name").alias("expectation_name"),
        )
        .agg(
            F.sum("x.passed_records").alias("passed_records"),
            F.sum("x.failed_records").alias("failed_records"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "pipeline_name",
            "expectation_name",
            "passed_records",
            "failed_records",
            percent(
                F.col("passed_records"), F.col("passed_records") + F.col("failed_records")
            ).alias("quality_score"),
        )
    )


def failure_rate(
    runs: DataFrame, width: str = "1 hour", slide: str = "5 minutes", delay: str = DELAY
) -> DataFrame:
    """Failed runs in a window that slides over the start time."""
    return (
        runs.withWatermark("start_time", delay)
        .groupBy(F.window("start_time", width, slide).alias("w"))
        .agg(
            F.count("*").alias("total_runs"),
            F.count_if(is_failure()).alias("failed_runs"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "total_runs",
            "failed_runs",
            percent(F.col("failed_runs"), F.col("total_runs")).alias("failure_rate"),
        )
    )


def sessions(
    df: DataFrame, event_time: str, keys: Sequence[str], gap: str = "30 minutes", delay: str = DELAY
) -> DataFrame:
    """Bursts of activity per key, closed by a gap."""
    return (
        df.withWatermark(event_time, delay)
        .groupBy(F.session_window(event_time, gap).alias("w"), *keys)
        .agg(F.count("*").alias("events"))
        .select(
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            *keys,
            "events",
        )
    )


def expectations(
    df: DataFrame,
    rules: Sequence[Expectation],
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows with the names of violated ``drop`` and ``warn`` rules and a keep flag.

    References are static tables. Uniqueness needs other rows of the stream: use
    ``deduplicated`` or check inside ``each_batch``.
    """
    if any(r.unique for r in rules):
        raise ValueError("uniqueness is checked per micro-batch, not on an open stream")

    def violated(action: str):
        names = [
            F.when(~F.col(f"_ok_{i}"), F.lit(r.name))
            for i, r in enumerate(rules)
            if r.action == action
        ]
        return F.array_compact(F.array(*names)).cast("array<string>")

    marked = flagged(df, rules, references)
    return (
        marked.withColumns({"dropped_by": violated("drop"), "warned_by": violated("warn")})
        .withColumn("kept", F.size("dropped_by") == 0)
        .drop(*[f"_ok_{i}" for i in range(len(rules))])
    )


def observed(df: DataFrame, name: str, rules: Sequence[Expectation]) -> DataFrame:
    """Attach violation counts of row rules to the progress report of every micro-batch."""
    counts = [
        F.count_if(~F.coalesce(F.expr(r.constraint), F.lit(False))).alias(r.name)
        for r in rules
        if r.by_row
    ]
    return df.observe(name, F.count("*").alias("rows"), *counts)


def progress(query: StreamingQuery) -> list[dict[str, Any]]:
    """Input, lag and late rows of each finished micro-batch."""
    return [
        {
            "batch_id": p["batchId"],
            "input_rows": p["numInputRows"],
            "rows_per_second": p.get("processedRowsPerSecond"),
            "watermark": p.get("eventTime", {}).get("watermark"),
            "late_rows": sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"]),
            "state_rows": sum(s.get("numRowsTotal", 0) for s in p["stateOperators"]),
            "observed": dict(p.get("observedMetrics", {})),
        }
        for p in query.recentProgress
    ]


_ENTRY = "struct<start_time:timestamp,run_id:bigint,failed:boolean>"


def _summary(runs: Column, minimum: int) -> Column:
    """What the ordered runs of a time bucket mean for a streak, in a few values.

    ``open``: failures at the end, counted up to one over the minimum; ``broken``: some run did
    not fail; ``lead``: the first failures before any other run, ``minimum`` at most; ``hits``:
    the runs that complete a streak begun in the bucket after its first success.
    """
    nothing = F.array().cast(f"array<{_ENTRY}>")
    start = F.struct(
        F.lit(0).alias("open"),
        F.lit(False).alias("broken"),
        nothing.alias("lead"),
        nothing.alias("hits"),
    )

    def step(so_far: Column, run: Column) -> Column:
        streak = F.least(so_far["open"] + 1, F.lit(minimum + 1))
        broken, lead, hits = so_far["broken"], so_far["lead"], so_far["hits"]
        leads = ~broken & (F.size(lead) < minimum)
        failed = F.struct(
            streak.alias("open"),
            broken.alias("broken"),
            F.when(leads, F.array_append(lead, run)).otherwise(lead).alias("lead"),
            F.when(broken & (streak == minimum), F.array_append(hits, run))
            .otherwise(hits)
            .alias("hits"),
        )
        ended = F.struct(
            F.lit(0).alias("open"), F.lit(True).alias("broken"), lead.alias("lead"), hits.alias("hits")
        )
        return F.when(run["failed"], failed).otherwise(ended)

    return F.aggregate(F.sort_array(runs), start, step)


def _carrier(minimum: int, idle_seconds: int):
    """Processor that carries the open streak of a job from bucket to bucket."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Carrier(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.streak = handle.getValueState("streak", "length int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            buckets = pd.concat(list(rows), ignore_index=True).sort_values("bucket")
            length = self.streak.get()[0] if self.streak.exists() else 0
            found = []
            for b in buckets.itertuples():
                missing = minimum - length
                if 0 < missing <= len(b.lead_runs):
                    found.append((b.lead_runs[missing - 1], b.lead_times[missing - 1]))
                found += zip(b.hit_runs, b.hit_times)
                length = b.open if b.broken else min(length + b.open, minimum + 1)
            self.streak.update((int(length),))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            last = int(pd.Timestamp(buckets["bucket"].iloc[-1]).timestamp() * 1000)
            self.handle.registerTimer(last + idle_seconds * 1000)
            if found:
                yield pd.DataFrame(
                    {
                        "job_id": [key[0]] * len(found),
                        "run_id": [int(run) for run, _ in found],
                        "reached_at": pd.to_datetime([t for _, t in found], unit="us"),
                    }
                )

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.streak.clear()
            return iter(())

        def close(self) -> None:
            pass

    return Carrier()


def failure_streaks(
    runs: DataFrame,
    minimum: int = DEFAULTS.jobs.consecutive_failures,
    bucket: str = "1 hour",
    delay: str = DELAY,
    idle_days: int = 30,
) -> DataFrame:
    """Alert when a job reaches ``minimum`` failures in a row, in the order of their start.

    Runs are gathered by (job, time bucket), so a busy job is spread over tasks and state, and
    a bucket is judged once the watermark has passed its end: files may come late, within
    ``delay``, out of order and again. Later rows are dropped. A bucket is reduced to a few
    values by built-in functions; the open streak that is carried over per job is one number,
    which a timer removes when the job has been idle for ``idle_days``, so a streak does not
    go on after such a pause. Alerts are rows (job_id, run_id, reached_at).
    """
    slim = runs.select("job_id", "run_id", "start_time", is_failure().alias("failed"))
    entry = F.struct("start_time", "run_id", F.coalesce("failed", F.lit(False)).alias("failed"))
    gathered = (
        slim.withWatermark("start_time", delay)
        .groupBy(F.window("start_time", bucket), "job_id")
        .agg(F.collect_set(entry.cast(_ENTRY)).alias("runs"))
    )
    judged = gathered.select(
        "job_id", F.window_time("window").alias("bucket"), _summary(F.col("runs"), minimum).alias("s")
    )
    slim_buckets = judged.select(
        "job_id",
        "bucket",
        "s.open",
        "s.broken",
        *[
            F.transform(f"s.{field}", take).alias(f"{name}_{kind}")
            for field, name in (("lead", "lead"), ("hits", "hit"))
            for kind, take in (
                ("runs", lambda run: run["run_id"]),
                ("times", lambda run: F.unix_micros(run["start_time"])),
            )
        ],
    )
    return slim_buckets.groupBy("job_id").transformWithStateInPandas(
        statefulProcessor=_carrier(minimum, idle_days * 86_400),
        outputStructType="job_id bigint, run_id bigint, reached_at timestamp",
        outputMode="append",
        timeMode="eventTime",
    )
