"""Column profiles: one wide aggregate per table, window or slice."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    NumericType,
    StringType,
    StructType,
    VariantType,
)

from vigil.functions.exprs import percent

EXACT, APPROXIMATE = "exact", "approximate"

# Texts longer than this are compared by digest when counting distinct values.
DIGEST_OVER = 64

MEASURES = (
    "row_count",
    "null_count",
    "null_percentage",
    "num_distinct",
    "min",
    "max",
    "min_text",
    "max_text",
    "avg",
    "stddev",
)


def _plain(kind: DataType) -> bool:
    return not isinstance(kind, (ArrayType, MapType, StructType, VariantType))


def _kinds(df: DataFrame) -> dict[str, DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _measures(name: str, kind: DataType, how: str, grouped: bool) -> list[Column]:
    numeric = isinstance(kind, NumericType)
    null_number, null_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    text = not numeric and _plain(kind) and not grouped
    number = F.col(name).cast("double")
    rough = F.approx_count_distinct(name) if how == APPROXIMATE and _plain(kind) else F.lit(None)
    return [
        F.count_if(F.col(name).isNull()).alias(f"{name}__nulls"),
        rough.cast("bigint").alias(f"{name}__distinct"),
        (F.min(number) if numeric else null_number).alias(f"{name}__min"),
        (F.max(number) if numeric else null_number).alias(f"{name}__max"),
        (F.min(name).cast("string") if text else null_text).alias(f"{name}__min_text"),
        (F.max(name).cast("string") if text else null_text).alias(f"{name}__max_text"),
        (F.avg(number) if numeric else null_number).alias(f"{name}__avg"),
        (F.stddev_samp(number) if numeric else null_number).alias(f"{name}__stddev"),
    ]


def _per_column(wide: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"{n}__nulls").alias("null_count"),
            percent(F.col(f"{n}__nulls"), F.col("_rows")).alias("null_percentage"),
            *[F.col(f"{n}__{m.removeprefix('num_')}").alias(m) for m in MEASURES[3:]],
        )
        for n in names
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def _chosen(df: DataFrame, columns: Sequence[str] | None, skip: Sequence[str] = ()) -> list[str]:
    return [c for c in (columns or df.columns) if c not in skip]


def _wide(df: DataFrame, names: Sequence[str], how: str, grouped: bool) -> list[Column]:
    kinds = _kinds(df)
    measures = [m for n in names for m in _measures(n, kinds[n], how, grouped)]
    return [F.count("*").alias("_rows"), *measures]


def _comparable(name: str, kind: DataType) -> Column:
    """The value, or the digest of a long text, so that whole texts stay out of the shuffle."""
    if isinstance(kind, StringType):
        text = F.col(name)
        return F.when(F.length(text) > DIGEST_OVER, F.sha2(text, 256)).otherwise(text)
    return F.col(name)


def _completed(
    profile: DataFrame, keyed: DataFrame, keys: Sequence[str], names: Sequence[str], how: str
) -> DataFrame:
    """Fill what the wide aggregate leaves out, from narrow branches of the same query.

    Exact distinct counts: counting all columns in one aggregate would copy every row once
    per column; here each branch reads its own column and drops repeated values before the
    shuffle. Bounds of texts per group: their buffers have no fixed width and would turn
    the wide aggregate into a sort of whole rows.
    """
    kinds = _kinds(keyed)
    result = profile
    for name in names:
        if not _plain(kinds[name]):
            continue
        if keys and not isinstance(kinds[name], NumericType):
            bounds = keyed.groupBy(*keys).agg(
                F.min(name).cast("string").alias("min_text"),
                F.max(name).cast("string").alias("max_text"),
            )
            result = result.unionByName(
                bounds.withColumn("column_name", F.lit(name)), allowMissingColumns=True
            )
        if how == APPROXIMATE:
            continue
        values = keyed.select(*keys, _comparable(name, kinds[name]).alias("_v")).distinct()
        counted = values.groupBy(*keys).agg(F.count("_v").alias("num_distinct"))
        result = result.unionByName(
            counted.withColumn("column_name", F.lit(name)), allowMissingColumns=True
        )
    # Branches meet again on a handful of rows per column and group.
    return (
        result.groupBy(*keys, "column_name")
        .agg(*[F.max(m).alias(m) for m in MEASURES])
        .filter(F.col("row_count").isNotNull())
    )


def snapshot(
    df: DataFrame, columns: Sequence[str] | None = None, distinct: str = EXACT
) -> DataFrame:
    """Profile of the whole table, one row per column.

    ``distinct="approximate"`` keeps the profile at one pass without a shuffle of values.
    """
    names = _chosen(df, columns)
    profile = _per_column(df.agg(*_wide(df, names, distinct, grouped=False)), [], names)
    if distinct == APPROXIMATE:
        return profile
    return _completed(profile, df, [], names, distinct)


def time_series(
    df: DataFrame,
    ts: str,
    granularities: Sequence[str] = ("1 day",),
    columns: Sequence[str] | None = None,
    distinct: str = EXACT,
) -> DataFrame:
    """Profile per window, for any number of granularities in one scan."""
    names = _chosen(df, columns, [ts])
    parts = [
        F.struct(F.lit(g).alias("granularity"), window_start(ts, g).alias("window_start"))
        for g in granularities
    ]
    spread = df.select(*names, F.inline(F.array(*parts)))
    keys = ["granularity", "window_start"]
    wide = spread.groupBy(*keys).agg(*_wide(df, names, distinct, grouped=True))
    profile = _per_column(wide, keys, names)
    return _completed(profile, spread, keys, names, distinct)


def sliced(
    df: DataFrame,
    slices: Sequence[str],
    columns: Sequence[str] | None = None,
    distinct: str = EXACT,
) -> DataFrame:
    """Profile of the table and of every value of every slicing expression, in one scan."""
    names = _chosen(df, columns)
    marks = {f"_slice_{i}": F.expr(s) for i, s in enumerate(slices)}
    tagged = df.select(*names, *[e.cast("string").alias(n) for n, e in marks.items()])
    sets = list(marks)
    wide = tagged.groupingSets([[], *[[k] for k in sets]], *sets).agg(
        *_wide(df, names, distinct, grouped=True), F.grouping_id().alias("_set")
    )
    # grouping_id has the bit of a key set when the key is not part of the group.
    everything = (1 << len(sets)) - 1
    none = F.lit(None).cast("string")
    slice_key = slice_value = none
    for i, expression in enumerate(slices):
        mine = F.col("_set") == everything - (1 << (len(sets) - 1 - i))
        slice_key = F.when(mine, F.lit(expression)).otherwise(slice_key)
        slice_value = F.when(mine, F.col(f"_slice_{i}")).otherwise(slice_value)
    labelled = wide.withColumns({"slice_key": slice_key, "slice_value": slice_value})
    keys = ["slice_key", "slice_value"]
    profile = _per_column(labelled, keys, names)
    parts = [F.struct(none.alias("slice_key"), none.alias("slice_value"))] + [
        F.struct(F.lit(s).alias("slice_key"), F.col(f"_slice_{i}").alias("slice_value"))
        for i, s in enumerate(slices)
    ]
    spread = tagged.select(*names, F.inline(F.array(*parts)))
    return _completed(profile, spread, keys, names, distinct)


# Lengths of the window units, in seconds or in calendar months.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
UNIT_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _length(granularity: str) -> tuple[int, int]:
    """Months and seconds of a window; one of them is zero."""
    count, unit = granularity.split()
    unit = unit.rstrip("s")
    if unit not in UNIT_SECONDS and unit not in UNIT_MONTHS:
        raise ValueError(f"unknown window: {granularity}")
    return int(count) * UNIT_MONTHS.get(unit, 0), int(count) * UNIT_SECONDS.get(unit, 0)


def window_start(ts: str, granularity: str) -> Column:
    """Start of the window that holds ``ts``; windows are counted from 1970-01-01."""
    months, seconds = _length(granularity)
    if months:
        month = (F.year(ts) - 1970) * 12 + F.month(ts) - 1
        first = month - F.pmod(month, F.lit(months))
        return F.add_months(F.lit("1970-01-01").cast("date"), first).cast("timestamp_ntz")
    epoch = F.unix_timestamp(ts)
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds))).cast("timestamp_ntz")


def next_window(start: Column, granularity: str) -> Column:
    """Start of the window after the one that begins at ``start``."""
    months, seconds = _length(granularity)
    if months:
        return F.add_months(start.cast("date"), months).cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


@dataclass(frozen=True)
class Metric:
    """A user-defined metric.

    ``aggregate``: SQL aggregate over the table; ``derived``: SQL over other metrics;
    ``drift``: SQL over metrics and their baseline values, named ``baseline_<metric>``.
    """

    name: str
    kind: str
    expression: str

    def __post_init__(self):
        if self.kind not in ("aggregate", "derived", "drift"):
            raise ValueError(f"unknown kind of metric: {self.kind}")


def custom(
    df: DataFrame,
    metrics: Sequence[Metric],
    by: Mapping[str, Column] | None = None,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """User-defined metrics of a table, per group when ``by`` is given."""

    def of(kind: str) -> list[Metric]:
        return [m for m in metrics if m.kind == kind]

    def measured(data: DataFrame, keys: Sequence[Column]) -> DataFrame:
        sums = [F.expr(m.expression).alias(m.name) for m in of("aggregate")]
        out = data.groupBy(*keys).agg(*sums)
        for m in of("derived"):
            out = out.withColumn(m.name, F.expr(m.expression))
        return out

    result = measured(df, [e.alias(n) for n, e in (by or {}).items()])
    if of("drift"):
        if baseline is None:
            raise ValueError("drift metrics need a baseline")
        names = [m.name for m in of("aggregate") + of("derived")]
        # The baseline is one row, read as a scalar subquery.
        one = measured(baseline, []).select(F.struct(*names).alias("b")).scalar()
        result = result.withColumn("_base", one).withColumns(
            {f"baseline_{n}": F.col(f"_base.{n}") for n in names}
        )
        for m in of("drift"):
            result = result.withColumn(m.name, F.expr(m.expression))
        result = result.drop("_base")
    return result


def all_tables(
    tables: Mapping[str, DataFrame],
    timestamp_columns: Mapping[str, str] | None = None,
    exclude: Sequence[str] = (),
    distinct: str = APPROXIMATE,
) -> DataFrame:
    """Profile every table of a schema: per day where a timestamp is named, else whole."""
    stamps = dict(timestamp_columns or {})
    result = None
    for name, df in tables.items():
        if name in exclude:
            continue
        if name in stamps:
            part = time_series(df, stamps[name], distinct=distinct)
        else:
            none = F.lit(None)
            part = snapshot(df, distinct=distinct).select(
                none.cast("string").alias("granularity"),
                none.cast("timestamp_ntz").alias("window_start"),
                "*",
            )
        part = part.select(F.lit(name).alias("table_name"), "*")
        result = part if result is None else result.unionByName(part)
    if result is None:
        raise ValueError("no table left to profile")
    return result


def monitor_plan(
    tables: Sequence[str],
    monitored: Sequence[str] = (),
    timestamp_columns: Mapping[str, str] | None = None,
    exclude: Sequence[str] = (),
) -> list[dict[str, str]]:
    """What bulk profiling does with each table of a schema."""
    stamps = timestamp_columns or {}
    return [
        {
            "table": t,
            "status": "exists"
            if t in monitored
            else "created_timeseries"
            if t in stamps
            else "created_snapshot",
        }
        for t in tables
        if t not in exclude
    ]


def newest(metrics: DataFrame, limit: int = 100) -> DataFrame:
    """Stored profile or drift rows, newest window first."""
    rest = [c for c in ("column_name", "drift_type") if c in metrics.columns]
    return metrics.orderBy(F.desc("window_start"), *rest).limit(limit)


def over_time(series: DataFrame) -> DataFrame:
    """Column statistics over time, newest window first."""
    return series.select(
        F.col("window_start").alias("time_window"),
        "column_name",
        "null_count",
        "null_percentage",
        "num_distinct",
        "min",
        "max",
        "avg",
        "stddev",
    ).orderBy(F.desc("time_window"), "column_name")


def listed(
    monitors: DataFrame, catalog: str | None = None, schema: str | None = None
) -> DataFrame:
    """Monitors of one catalog or schema, by table-name prefix."""
    out = monitors
    if catalog is not None:
        out = out.filter(F.col("table_name").startswith(f"{catalog}."))
    if schema is not None:
        out = out.filter(F.col("table_name").startswith(f"{catalog}.{schema}."))
    return out
