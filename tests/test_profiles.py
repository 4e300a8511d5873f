import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import drift, inference, profile


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(3)
    base = [(round(rng.gauss(0, 1), 2), "a" if rng.random() < 0.7 else "b") for _ in range(700)]
    cur = [(round(rng.gauss(0.4, 1.3), 2), "a" if rng.random() < 0.5 else "c") for _ in range(500)]
    schema = "x double, c string"
    return base, cur, spark.createDataFrame(base, schema), spark.createDataFrame(cur, schema)


def _scores(df):
    return {r.drift_type: r.drift_score for r in df.collect()}


def test_drift_of_a_sample_with_itself_is_zero(samples):
    _, _, base, _ = samples
    for scores in (_scores(drift.numeric(base, base, "x")),
                   _scores(drift.categorical(base, base, "c"))):
        assert all(abs(s) < 1e-12 for s in scores.values())


def test_exact_numeric_measures(samples):
    b, c, base, cur = samples
    got = _scores(drift.numeric(base, cur, "x"))
    xb, xc = np.sort([r[0] for r in b]), np.sort([r[0] for r in c])
    grid = np.unique(np.concatenate([xb, xc]))
    gap = np.abs(
        np.searchsorted(xb, grid, "right") / len(xb) - np.searchsorted(xc, grid, "right") / len(xc)
    )
    assert got["kolmogorov_smirnov"] == pytest.approx(gap.max())
    assert got["wasserstein"] == pytest.approx((gap[:-1] * np.diff(grid)).sum())


def test_categorical_measures(samples):
    b, c, base, cur = samples
    got = _scores(drift.categorical(base, cur, "c"))
    cats = ["a", "b", "c"]
    p = np.array([sum(r[1] == k for r in b) for k in cats]) / len(b)
    q = np.array([sum(r[1] == k for r in c) for k in cats]) / len(c)
    assert got["total_variation"] == pytest.approx(np.abs(p - q).sum() / 2)
    m = (p + q) / 2
    kl = lambda x: sum(v * np.log2(v / w) for v, w in zip(x, m) if v > 0)
    assert got["jensen_shannon"] == pytest.approx((kl(p) + kl(q)) / 2)


def test_constant_column_has_a_drift_score(spark):
    one = spark.createDataFrame([(1.0,)] * 5, "x double")
    two = spark.createDataFrame([(2.0,)] * 5, "x double")
    got = _scores(drift.numeric(one, two, "x"))
    assert got["kolmogorov_smirnov"] == 1 and got["total_variation"] == 1
    assert got["wasserstein"] == 1


def test_status_labels(spark):
    df = spark.createDataFrame(
        [("a", "tv", 0.2, 0.1), ("b", "tv", 0.05, 0.1), ("c", "tv", None, 0.1)],
        "column_name string, drift_type string, drift_score double, threshold double",
    )
    got = {r.column_name: r.drift_status for r in drift.with_status(df).collect()}
    assert got == {"a": "DRIFT_DETECTED", "b": "NO_DRIFT"}


def test_slices_add_up_to_the_table(spark):
    df = spark.range(200).select("id", (F.col("id") % 3).cast("string").alias("g"))
    out = profile.sliced(df, ["g", "id > 50"], ["id"]).collect()
    whole = [r.row_count for r in out if r.slice_key is None]
    assert whole == [200]
    assert sum(r.row_count for r in out if r.slice_key == "g") == 200
    assert {r.slice_value: r.num_distinct for r in out if r.slice_key == "id > 50"} == {
        "true": 149, "false": 51
    }


def test_exact_and_approximate_distinct(spark):
    long = F.concat(F.lit("x" * 100), (F.col("id") % 40).cast("string"))
    df = spark.range(1000).select(long.alias("t"), F.lit(None).cast("int").alias("n"))
    exact = {r.column_name: r for r in profile.snapshot(df).collect()}
    assert exact["t"].num_distinct == 40 and exact["n"].num_distinct == 0
    assert exact["n"].null_percentage == 100.0
    rough = {r.column_name: r for r in profile.snapshot(df, distinct="approximate").collect()}
    assert abs(rough["t"].num_distinct - 40) <= 4


def test_exact_distinct_does_not_copy_rows_per_column(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"))
    plan = profile.snapshot(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_monitor_plan_and_listing(spark):
    plan = profile.monitor_plan(["a", "b", "c", "d"], ["a"], {"b": "ts"}, ["d"])
    assert [p["status"] for p in plan] == ["exists", "created_timeseries", "created_snapshot"]
    monitors = spark.createDataFrame([("m.s.a",), ("m.t.b",), ("n.s.c",)], "table_name string")
    assert profile.listed(monitors, "m").count() == 2
    assert profile.listed(monitors, "m", "t").count() == 1


def test_drift_metric_needs_a_baseline(spark):
    metrics = [profile.Metric("n", "aggregate", "count(*)"),
               profile.Metric("d", "drift", "n - baseline_n")]
    with pytest.raises(ValueError):
        profile.custom(spark.range(3), metrics)
    assert profile.custom(spark.range(3), metrics, baseline=spark.range(5)).first().d == -2


def test_regression_and_problem_types(spark):
    log = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5), "m", 2.0, 1.0), (datetime(2024, 1, 1, 6), "m", 3.0, 5.0)],
        "ts timestamp_ntz, model_id string, prediction double, label double",
    )
    row = inference.monitor(log, "Regression").first()
    assert (row.mae, row.mse, row.labelled) == (1.5, 2.5, 2)
    assert row.r2 == pytest.approx(1 - 5 / 8)
    assert row.window_start == datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        inference.monitor(log, "clustering")
