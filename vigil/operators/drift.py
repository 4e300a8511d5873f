"""Drift between two samples of a column, and between consecutive windows.

Measures: total variation, Jensen-Shannon divergence (Lin 1991, base 2), two-sample
chi-square (Pearson 1900), Kolmogorov-Smirnov and Wasserstein-1. Both samples are first
reduced to counts per value (or bin); everything after works on those counts.
"""

from __future__ import annotations

from datetime import datetime
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import ts_lit
from vigil.operators.profile import next_window, window_start
from vigil.plans.ordered import in_ranges, running_totals, with_next
from vigil.settings import DEFAULTS

# Labels of the drift report.
DETECTED = "DRIFT_DETECTED"
NONE = "NO_DRIFT"


def _counted(baseline: DataFrame, current: DataFrame, value: Column) -> DataFrame:
    """Counts per value in both samples."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    base = baseline.select(value.alias("value"), one.alias("b"), none.alias("c"))
    cur = current.select(value.alias("value"), none.alias("b"), one.alias("c"))
    return base.unionByName(cur).groupBy("value").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))


def _with_totals(counted: DataFrame) -> DataFrame:
    """Sample sizes beside every count, from a one-row scalar subquery."""
    sizes = counted.select(F.struct(F.sum("b").alias("b"), F.sum("c").alias("c"))).scalar()
    return counted.withColumn("_sizes", sizes).select(
        *counted.columns, F.col("_sizes.b").alias("_nb"), F.col("_sizes.c").alias("_nc")
    )


def _share_scores(b: str, c: str, nb: str, nc: str) -> dict[str, Column]:
    """Aggregates over (value, count) rows."""
    p, q = F.col(b) / F.col(nb), F.col(c) / F.col(nc)
    middle = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / middle)).otherwise(F.lit(0.0))

    scale = F.sqrt(F.col(nc) / F.col(nb))
    gap = F.col(b) * scale - F.col(c) / scale
    return {
        "total_variation": F.sum(F.abs(p - q)) / 2,
        "jensen_shannon": F.sum((part(p) + part(q)) / 2),
        "chi_square": F.sum(F.try_divide(gap * gap, (F.col(b) + F.col(c)).cast("double"))),
    }


def _long(scores: DataFrame, column: str, types: list[str], keys: list[str], threshold: float):
    rows = [
        F.struct(F.lit(t).alias("drift_type"), F.col(t).cast("double").alias("drift_score"))
        for t in types
    ]
    return scores.select(
        *keys,
        F.lit(column).alias("column_name"),
        F.inline(F.array(*rows)),
    ).withColumn("threshold", F.lit(threshold))


def categorical(
    baseline: DataFrame,
    current: DataFrame,
    column: str,
    threshold: float = DEFAULTS.drift_threshold,
) -> DataFrame:
    measures = _share_scores("b", "c", "_nb", "_nc")
    scored = _with_totals(_counted(baseline, current, F.col(column))).agg(
        *[m.alias(n) for n, m in measures.items()]
    )
    return _long(scored, column, list(measures), [], threshold)


def _bin(column: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 1..bins; 0 below, bins + 1 above, NULL stays NULL."""
    width = (high - low) / bins
    inner = F.floor(F.try_divide(column - low, width)).cast("int") + 1
    return (
        F.when(column < low, 0)
        .when(column > high, bins + 1)
        .when(column == high, bins)
        .otherwise(F.least(inner, F.lit(bins)))
    )


def numeric(
    baseline: DataFrame,
    current: DataFrame,
    column: str,
    bins: int = 20,
    threshold: float = DEFAULTS.drift_threshold,
) -> DataFrame:
    """Binned share measures plus exact KS and Wasserstein-1 of a numeric column.

    Bins have equal width over the range of the baseline. The exact measures need the
    cumulated counts of both samples, summed inside value ranges and then across them.
    """
    value = F.col(column).cast("double")
    # One reduction to distinct values serves every measure.
    counted = in_ranges(
        _counted(
            baseline.filter(value.isNotNull()), current.filter(value.isNotNull()), value
        ),
        "value",
    )
    sized = _with_totals(counted)

    seen = counted.filter("b > 0")
    edges = {
        "_low": seen.select(F.min("value")).scalar(),
        "_high": seen.select(F.max("value")).scalar(),
    }
    binned = (
        sized.withColumns(edges)
        .groupBy(_bin(F.col("value"), F.col("_low"), F.col("_high"), bins).alias("bin"))
        .agg(
            F.sum("b").alias("b"),
            F.sum("c").alias("c"),
            F.first("_nb").alias("_nb"),
            F.first("_nc").alias("_nc"),
        )
    )
    measures = _share_scores("b", "c", "_nb", "_nc")
    shares = binned.agg(*[m.alias(n) for n, m in measures.items()])

    walked = with_next(
        running_totals(
            sized,
            [],
            F.col("_range"),
            ["value"],
            {"_cb": F.col("b"), "_cc": F.col("c")},
            bucket_rows=None,
        ),
        "value",
        "_next",
    )
    gap = F.abs(F.col("_cb") / F.col("_nb") - F.col("_cc") / F.col("_nc"))
    exact = walked.agg(
        F.max(gap).alias("kolmogorov_smirnov"),
        F.coalesce(F.sum(gap * (F.col("_next") - F.col("value"))), F.lit(0.0)).alias(
            "wasserstein"
        ),
    )
    return _long(shares, column, list(measures), [], threshold).unionByName(
        _long(exact, column, ["kolmogorov_smirnov", "wasserstein"], [], threshold)
    )


def consecutive(
    df: DataFrame,
    ts: str,
    column: str,
    granularity: str = "1 day",
    threshold: float = DEFAULTS.drift_threshold,
) -> DataFrame:
    """Share measures of each window against the window right before it.

    Every (window, value) count takes part twice: as the current side of its window and
    as the previous side of the next one. Windows are never joined with each other.
    """
    pairs = _window_pairs(df, ts, F.col(column), granularity)
    return _window_scores(pairs, "value", column, threshold)


def consecutive_numeric(
    df: DataFrame,
    ts: str,
    column: str,
    granularity: str = "1 day",
    bins: int = 20,
    threshold: float = DEFAULTS.drift_threshold,
) -> DataFrame:
    """Binned share measures of each window against the window right before it.

    Bins have equal width over the range of the earlier window, as in ``numeric``.
    """
    value = F.col(column).cast("double")
    pairs = _window_pairs(df.filter(value.isNotNull()), ts, value, granularity)
    # One row per window: the range of the window before it.
    limits = pairs.filter("b > 0").groupBy(F.col("w").alias("_lw")).agg(
        F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    placed = pairs.join(limits, F.col("w") == F.col("_lw"))
    place = _bin(F.col("value"), F.col("_low"), F.col("_high"), bins)
    binned = placed.groupBy("w", place.alias("bin")).agg(
        F.sum("b").alias("b"), F.sum("c").alias("c")
    )
    return _window_scores(binned, "bin", column, threshold)


def _window_pairs(df: DataFrame, ts: str, value: Column, granularity: str) -> DataFrame:
    """(w, value, b, c): how often a value occurs in the window before w, and in w."""
    start = window_start(ts, granularity).alias("window_start")
    counts = df.groupBy(start, value.alias("value")).agg(F.count("*").alias("n"))
    later = next_window(F.col("window_start"), granularity)
    none = F.lit(0).cast("bigint")
    sides = counts.select(
        "value",
        F.inline(
            F.array(
                F.struct(
                    F.col("window_start").alias("w"), none.alias("b"), F.col("n").alias("c")
                ),
                F.struct(later.alias("w"), F.col("n").alias("b"), none.alias("c")),
            )
        ),
    )
    return sides.groupBy("w", "value").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))


def _window_scores(pairs: DataFrame, by: str, column: str, threshold: float) -> DataFrame:
    """Share measures per window over rows that are one per (w, ``by``)."""
    # One row per window.
    totals = pairs.groupBy(F.col("w").alias("_w")).agg(
        F.sum("b").alias("_nb"), F.sum("c").alias("_nc")
    )
    measures = _share_scores("b", "c", "_nb", "_nc")
    scored = (
        pairs.join(totals.filter("_nb > 0 AND _nc > 0"), F.col("w") == F.col("_w"))
        .groupBy(F.col("w").alias("window_start"))
        .agg(*[m.alias(n) for n, m in measures.items()])
    )
    return _long(scored, column, list(measures), ["window_start"], threshold)


def with_status(drift: DataFrame) -> DataFrame:
    """Scored rows with their verdict, largest score first."""
    over = F.when(F.col("drift_score") > F.col("threshold"), DETECTED).otherwise(NONE)
    order = [F.desc("drift_score")]
    if "window_start" in drift.columns:
        order.append(F.desc("window_start"))
    return (
        drift.filter(F.col("drift_score").isNotNull())
        .withColumn("drift_status", over)
        .orderBy(*order, "column_name", "drift_type")
    )


def split_at(df: DataFrame, ts: str, moment: datetime) -> Mapping[str, DataFrame]:
    """Baseline before ``moment`` and current from it on."""
    return {
        "baseline": df.filter(F.col(ts) < ts_lit(moment)),
        "current": df.filter(F.col(ts) >= ts_lit(moment)),
    }
