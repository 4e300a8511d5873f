"""Update health kept as a stored table, refreshed by batches of events.

Reports over a week need not parse every payload ever written. Each batch of events is reduced
to mergeable parts per (event day, update), and only the updates it touches are stated anew from
their parts, also for late events. Both tables are Parquet, dealt by day:

* ``partials``: folders (event day, batch). A batch that is delivered again replaces its own
  folders, so it changes nothing.
* ``health``: one row per update, in the folder of the day on which the update was first stored
  (``home_day``). That day never changes, so a row can be replaced by writing its day again.

An update's events lie within ``SPAN_DAYS`` of each other; reads look that far to either side.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.exprs import day_lit
from vigil.operators import event_log
from vigil.operators.event_log import UPDATE
from vigil.plans.scratch import stored
from vigil.sources.sinks import read_table

SPAN_DAYS = 7
HOME, EVENT_DAY, BATCH = "home_day", "event_day", "batch"


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    """Replace the folders that ``df`` has rows for."""
    (
        df.hint("rebalance", *map(F.col, by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _update() -> Column:
    """The update as one value, in which nulls are equal."""
    return F.struct(*UPDATE)


def refresh(
    events: DataFrame, root: str, batch_id: int, as_of: datetime, span_days: int = SPAN_DAYS
) -> None:
    """Take a batch of events into the tables below ``root``.

    Usable as the writer of a stream: repeating a batch, also after a failure between the two
    writes, gives the same tables.
    """
    spark = events.sparkSession
    parts = event_log.health_partials(events, F.to_date("timestamp"))
    parts = parts.withColumnRenamed("_by0", EVENT_DAY).withColumn(BATCH, F.lit(batch_id))
    _overwrite(parts, f"{root}/partials", EVENT_DAY, BATCH)

    known = spark.read.schema(parts.schema).parquet(f"{root}/partials")
    own = known.filter(F.col(BATCH) == batch_id)
    first, last = own.agg(F.min(EVENT_DAY), F.max(EVENT_DAY)).first()
    if first is None:
        return
    margin = timedelta(days=span_days)
    near = (day_lit(first - margin), day_lit(last + margin))
    touched = own.select(_update().alias("_u")).distinct()
    whole = known.filter(F.col(EVENT_DAY).between(*near)).withColumn("_u", _update())
    restated = event_log.merged_health(whole.join(touched, "_u", "left_semi"), as_of)

    health = f"{root}/health"
    before = read_table(spark, health)
    if before is None:
        homed = restated.withColumn(HOME, F.to_date("start_time"))
        _overwrite(homed, health, HOME)
        return
    before = before.filter(F.col(HOME).between(*near))
    homes = before.select(_update().alias("_u"), F.col(HOME).alias("_home"))
    homed = restated.withColumn("_u", _update()).join(homes, "_u", "left").drop("_u")
    homed = homed.withColumn(HOME, F.coalesce("_home", F.to_date("start_time"))).drop("_home")
    homed = stored(homed, "restated")
    # A batch touches a bounded number of days; they prune the folders that are written again.
    days = [r[0] for r in homed.select(HOME).distinct().collect()]
    rest = before.filter(F.col(HOME).isin(days)).withColumn("_u", _update())
    rest = rest.join(touched, "_u", "left_anti").drop("_u")
    if days:
        _overwrite(rest.select(homed.columns).unionByName(homed), health, HOME)


def health(
    spark: SparkSession,
    root: str,
    as_of: datetime | None = None,
    days: int | None = None,
    span_days: int = SPAN_DAYS,
) -> DataFrame:
    """The stored table; with ``as_of`` and ``days`` only the folders that a report over those
    days can need."""
    table = spark.read.parquet(f"{root}/health")
    if as_of is not None and days is not None:
        first = as_of.date() - timedelta(days=days)
        last = as_of.date() + timedelta(days=span_days)
        table = table.filter(F.col(HOME).between(day_lit(first), day_lit(last)))
    return table.drop(HOME)
