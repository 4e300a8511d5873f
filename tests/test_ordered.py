"""Order-dependent work against plain window functions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from vigil.plans.lists import listed
from vigil.plans.ordered import in_ranges, running_totals, trailing_mean, with_next

SCHEMA = "k bigint, t bigint, v bigint"


def _skewed(spark, n=3000):
    """One key holds a third of the rows, one key is NULL."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        key = 1 if i % 3 == 0 else rng.choice([2, 3, 4, None])
        data.append((key, i, rng.randint(-3, 9)))
    return spark.createDataFrame(data, SCHEMA)


def test_running_totals_equal_a_window(spark):
    df = _skewed(spark)
    got = running_totals(df, ["k"], F.floor(F.col("t") / 50), ["t"], {"s": F.col("v")})
    frame = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got) == rows(df.withColumn("s", F.sum("v").over(frame)))


def test_hot_bucket_falls_back_to_ranges(spark):
    """One bucket and one copied row each hold a third of the rows."""
    base = [(1, 5, i) for i in range(300)] + [(1, 6, 7)] * 300 + [(2, i, i) for i in range(300)]
    df = spark.createDataFrame(base, SCHEMA)
    got = running_totals(df, ["k"], F.lit(0), ["t", "v"], {"n": F.lit(1)}, bucket_rows=50)
    frame = Window.partitionBy("k").orderBy("t", "v").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got) == rows(df.withColumn("n", F.count("*").over(frame)))


def test_ranges_stay_balanced_under_copies(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.monotonically_increasing_id().alias("_tie"))
    sizes = [r["count"] for r in in_ranges(df, "k", "_tie", ranges=8).groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_trailing_mean_with_hot_bucket(spark):
    df = _skewed(spark, 900)
    got = trailing_mean(df, ["k"], F.lit(0), ["t"], "v", 5, chunk=40, bucket_rows=50)
    frame = Window.partitionBy("k").orderBy("t").rowsBetween(-5, -1)
    want = df.withColumns(
        {"trailing_sum": F.sum("v").over(frame), "trailing_n": F.count("v").over(frame)}
    )
    assert rows(got) == rows(want)


def test_running_totals_without_keys(spark):
    df = _skewed(spark, 400)
    got = running_totals(df, [], F.floor(F.col("t") / 10), ["t"], {"s": F.col("v")})
    frame = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got) == rows(df.withColumn("s", F.sum("v").over(frame)))


def test_trailing_mean_crosses_chunks(spark):
    df = _skewed(spark)
    got = trailing_mean(df, ["k"], F.floor(F.col("t") / 50), ["t"], "v", 5, chunk=40)
    frame = Window.partitionBy("k").orderBy("t").rowsBetween(-5, -1)
    want = df.withColumns(
        {"trailing_sum": F.sum("v").over(frame), "trailing_n": F.count("v").over(frame)}
    )
    assert rows(got) == rows(want)


def test_ranges_keep_order_and_neighbours(spark):
    df = spark.range(500).select((F.col("id") * 7 % 1009).alias("x"))
    ranged = in_ranges(df, "x", ranges=4)
    bounds = ranged.groupBy("_range").agg(F.min("x"), F.max("x")).orderBy("_range").collect()
    assert len(bounds) > 1
    for left, right in zip(bounds, bounds[1:]):
        assert left[2] < right[1]
    got = {r.x: r.nxt for r in with_next(ranged, "x", "nxt").collect()}
    ordered = sorted(got)
    assert got == dict(zip(ordered, ordered[1:] + [None]))


def test_lists_have_one_shape(spark):
    """A key of any size gives one row per value; NULL keys survive; the limit counts keys."""
    data = [("hot", f"v{i}", 1) for i in range(20_000)]
    data += [(None, "a", 2), (None, None, 3), ("x", "b", 9)]
    pairs = spark.createDataFrame(data, "k string, v string, n bigint")
    got = listed(pairs, ["k"], "v", "v", {"total": F.sum("n")})
    assert {tuple(r) for r in got.totals.collect()} == {("hot", 20_000), (None, 5), ("x", 9)}
    rows = sorted(map(tuple, got.values.collect()), key=repr)
    assert rows == sorted([(k, v) for k, v, _ in data if v is not None], key=repr)
    top = listed(pairs, ["k"], "v", "v", {"total": F.sum("n")}, [F.desc("total")], 2)
    assert {r.k for r in top.totals.collect()} == {"hot", "x"}
    assert {r.k for r in top.values.collect()} == {"hot", "x"} and top.values.count() == 20_001
