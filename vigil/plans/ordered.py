"""Order-dependent work on keys of any size.

A window function puts a whole key into one task. Here every key is first cut into
parts: rows are ordered inside (key, part), and only one summary row per part takes
part in the step that spans the key. Parts are time buckets while all of those are
small enough, which is counted first; otherwise they are sampled ranges of the rows
in order, which stay balanced whatever key, bucket or copied row dominates.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.plans.scratch import cut

# Most rows of one (key, bucket) that a single task is asked to order.
BUCKET_ROWS = 2_000_000


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    totals: dict[str, Column],
    bucket_rows: int | None = BUCKET_ROWS,
) -> DataFrame:
    """Add running totals (inclusive) of numeric expressions per key, in order.

    ``bucket`` must be a non-decreasing function of the leading order column. The
    result equals ``sum(expr) over (partition by keys order by order rows unbounded
    preceding)``. ``bucket_rows=None`` vouches for small buckets and skips the count.
    """
    keys, order = list(keys), list(order)
    columns = df.columns
    if bucket_rows is not None and _largest(df, keys, bucket) > bucket_rows:
        # Numbers for equal rows are stored before they steer a shuffle, so that a task
        # repeated after a loss sees the same ones.
        numbered = cut(df.withColumn("_tie", F.monotonically_increasing_id()))
        df = in_ranges(numbered, *keys, *order, "_tie")
        bucket, order = F.col("_range"), [*order, "_tie"]
    # Key and bucket as one struct: NULL keys stay comparable, and the window, the summary
    # and the join below all use the same partitioning.
    part = F.struct(*keys, bucket.alias("_bucket"))
    tagged = df.withColumns({"_part": part, **{f"_v_{n}": e for n, e in totals.items()}})
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = tagged.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(inside) for n in totals})
    summary = tagged.groupBy("_part").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
    before = Window.partitionBy(*[f"_part.{k}" for k in keys] or [F.lit(0)]).orderBy(
        "_part._bucket"
    ).rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        F.col("_part").alias("_of"),
        *[
            F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}")
            for n in totals
        ],
    )
    joined = rows.join(offsets, F.col("_part") == F.col("_of"))
    return joined.select(
        *columns, *[(F.col(f"_r_{n}") + F.col(f"_b_{n}")).alias(n) for n in totals]
    )


def _largest(df: DataFrame, keys: Sequence[str], bucket: Column) -> int:
    """Rows of the largest (key, bucket); one narrow pass, counted on the map side."""
    sizes = df.groupBy(*keys, bucket.alias("_bucket")).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def trailing_mean(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    value: str,
    rows: int,
    chunk: int = 100_000,
    bucket_rows: int | None = BUCKET_ROWS,
) -> DataFrame:
    """Mean of ``value`` over the ``rows`` rows before each row of a key.

    Rows get their position in the key, are cut into chunks of equal size, and each
    chunk also receives the last ``rows`` rows of the chunk before it.
    """
    if rows >= chunk:
        raise ValueError("the trailing frame must be shorter than a chunk")
    keys = list(keys)
    one = {"_pos": F.lit(1).cast("bigint")}
    placed = running_totals(df, keys, bucket, order, one, bucket_rows)
    home = F.floor((F.col("_pos") - 1) / F.lit(chunk)).cast("bigint")
    spill = F.pmod(F.col("_pos") - 1, F.lit(chunk)) >= F.lit(chunk - rows)
    copies = placed.withColumn("_home", home).withColumn(
        "_chunk",
        F.explode(
            F.when(spill, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(
                F.array(F.col("_home"))
            )
        ),
    )
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_pos").rowsBetween(-rows, -1)
    return (
        copies.withColumns(
            {
                "trailing_sum": F.sum(value).over(frame),
                "trailing_n": F.count(value).over(frame),
            }
        )
        .filter(F.col("_chunk") == F.col("_home"))
        .drop("_pos", "_home", "_chunk")
    )


def in_ranges(df: DataFrame, *order: str, ranges: int | None = None) -> DataFrame:
    """Cut rows into balanced ranges of ``order``; adds ``_range``, ascending with it.

    The sampled bounds become part of the stored rows, so later steps agree on them.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def with_next(ranged: DataFrame, value: str, name: str) -> DataFrame:
    """Add the next larger value; ``ranged`` comes from ``in_ranges`` with distinct values."""
    inside = Window.partitionBy("_range").orderBy(value)
    firsts = ranged.groupBy("_range").agg(F.min(value).alias("_first"))
    # One row per range is ordered here.
    follower = F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy("_range"))
    followers = firsts.select("_range", follower.alias("_follower"))
    return (
        ranged.withColumn(name, F.lead(value).over(inside))
        .join(followers, "_range")
        .withColumn(name, F.coalesce(name, "_follower"))
        .drop("_follower")
    )
