"""Streams over several micro-batches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigil.operators.expectations import Expectation
from vigil.streaming import jobs as streams

START = datetime(2024, 1, 1)
SCHEMA = "job_id bigint, run_id bigint, start_time timestamp_ntz, result_state string"


def _write(spark, path, batches):
    """One file per micro-batch, oldest first."""
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    schema = spark.read.parquet(path).schema
    return streams.source(spark, path, schema, "start_time", files_per_batch=1)


def _streaks(spark, path, **how):
    out = streams.collected(streams.failure_streaks(_stream(spark, path), **how), "t").collect()
    return sorted((r.job_id, r.run_id) for r in out)


def _reached(runs, minimum=3):
    """Runs that complete a streak, over all runs in order."""
    found, length = [], {}
    for job, run, start, state in sorted(set(runs), key=lambda r: (r[0], r[2], r[1])):
        length[job] = length.get(job, 0) + 1 if state == "FAILED" else 0
        if length[job] == minimum:
            found.append((job, run))
    return sorted(found)


def test_streaks_over_late_and_repeated_files_equal_the_batch(spark, tmp_path):
    draw = random.Random(4)
    runs = [
        (draw.choice([1, 1, 1, 2, 3]), i, START + timedelta(minutes=i // 2),
         draw.choice(["FAILED", "FAILED", "SUCCESS", None]))
        for i in range(300)
    ]
    # Up to five minutes late, so some rows come in a later file; one file comes twice.
    due = sorted(runs, key=lambda r: r[2] + timedelta(minutes=(r[1] * 7) % 6))
    files = [due[i : i + 75] for i in range(0, 300, 75)]
    files.insert(3, files[1])
    closing = [(9, 999, START + timedelta(days=1), "SUCCESS")]
    _write(spark, str(tmp_path / "in"), [*files, closing])
    got = _streaks(spark, str(tmp_path / "in"), bucket="7 minutes")
    assert len(got) > 9 and got == _reached(runs)


@pytest.mark.parametrize("idle_days, reached", [(30, []), (60, [(1, 3)])])
def test_idle_jobs_lose_their_streak(spark, tmp_path, idle_days, reached):
    day = timedelta(days=1)
    files = [
        [(1, 1, START, "FAILED"), (1, 2, START + day / 24, "FAILED")],
        [(2, 10, START + 35 * day, "SUCCESS")],
        [(2, 11, START + 36 * day, "SUCCESS")],
        [(1, 3, START + 37 * day, "FAILED")],
        [(2, 12, START + 40 * day, "SUCCESS")],
    ]
    _write(spark, str(tmp_path / "in"), files)
    assert _streaks(spark, str(tmp_path / "in"), idle_days=idle_days) == reached


def test_a_busy_job_is_spread_over_buckets(spark, tmp_path):
    """State is kept by (job, bucket): one job's open runs are many small groups."""
    runs = [(1, i, START + timedelta(minutes=i), "FAILED") for i in range(600)]
    _write(spark, str(tmp_path / "in"), [runs])
    df = streams.failure_streaks(_stream(spark, str(tmp_path / "in")), bucket="10 minutes")
    plan = df._jdf.queryExecution().analyzed().toString()
    query = streams.run_to_files(df, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert "window" in plan and max(p["state_rows"] for p in streams.progress(query)) >= 60
    assert [r.run_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]


def test_late_rows_are_counted_and_backlog_reported(spark, tmp_path):
    on_time = [(1, i, START + timedelta(hours=i), "SUCCESS") for i in range(10)]
    later = [(1, 50, START + timedelta(hours=10), "SUCCESS")]
    # A batch is filtered with the watermark that stood before the batch ahead of it.
    late = [(1, 99, START, "FAILED"), (1, 100, START + timedelta(hours=10), "SUCCESS")]
    _write(spark, str(tmp_path / "in"), [on_time, later, late])
    df = streams.throughput(_stream(spark, str(tmp_path / "in")), "start_time", ["job_id"])
    query = streams.run_to_files(df, str(tmp_path / "out"), str(tmp_path / "cp"))
    report = streams.progress(query)
    assert sum(p["input_rows"] for p in report) == 13
    assert sum(p["late_rows"] for p in report) == 1
    stored = spark.read.parquet(str(tmp_path / "out"))
    # The watermark stands at 09:50, so the windows from 09:00 on are still open.
    assert stored.agg(F.sum("events")).first()[0] == 9


def test_restart_reads_only_new_files(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    _write(spark, source, [[(1, 1, START, "SUCCESS")]])
    streams.run_to_files(_stream(spark, source), out, cp)
    _write(spark, source, [[(1, 2, START, "SUCCESS")]])
    query = streams.run_to_files(_stream(spark, source), out, cp)
    assert sum(p["input_rows"] for p in streams.progress(query)) == 1
    assert sorted(r.run_id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_observed_counts_reach_the_progress(spark, tmp_path):
    _write(spark, str(tmp_path / "in"), [[(1, i, START, "FAILED" if i else "SUCCESS")
                                          for i in range(4)]])
    rules = [Expectation("ok", "result_state = 'SUCCESS'", "warn")]
    df = streams.observed(_stream(spark, str(tmp_path / "in")), "checks", rules)
    query = streams.run_to_files(df, str(tmp_path / "out"), str(tmp_path / "cp"))
    seen = [p["observed"]["checks"] for p in streams.progress(query) if p["input_rows"]]
    assert [(s.rows, s.ok) for s in seen] == [(4, 3)]


def test_unique_rule_runs_per_batch(spark, tmp_path):
    rule = Expectation("run_unique", "", "drop", unique=("run_id",))
    _write(spark, str(tmp_path / "in"), [[(1, 1, START, "S"), (1, 1, START, "S"),
                                          (1, 2, START, "S")]])
    stream = _stream(spark, str(tmp_path / "in"))
    with pytest.raises(ValueError):
        streams.expectations(stream, [rule])
    from vigil.operators.expectations import check

    out = str(tmp_path / "out")

    def keep(batch, batch_id):
        check(batch, [rule]).valid.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    streams.each_batch(stream, keep, str(tmp_path / "cp"))
    assert [r.run_id for r in spark.read.parquet(out).collect()] == [2]
