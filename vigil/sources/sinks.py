"""Sinks for the stored tables: repeatable appends, day overwrites, retention.

Tables are Parquet folders partitioned by a derived day. Every write can be
repeated after a failure without duplicating or losing rows.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.exprs import as_day, day_lit
from vigil.schemas import PARTITION_DAY
from vigil.settings import DEFAULTS

NOOP = "noop"


def with_day(df: DataFrame, table: str) -> tuple[DataFrame, str]:
    column, source = PARTITION_DAY[table]
    return df.withColumn(column, F.expr(source)), column


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or nothing before the first write."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if files.exists(folder) else None


def _by_day(batch: DataFrame, day: str) -> DataFrame:
    """Few files per day: rows are gathered by day, and adaptive execution splits large days."""
    return batch.hint("rebalance", F.col(day))


def append_new(
    df: DataFrame,
    path: str,
    table: str,
    keys: Sequence[str],
    span: tuple[date, date] | None = None,
    dry_run: bool = False,
) -> None:
    """Append the rows whose key is not stored yet.

    The stored side is read only for the days the batch touches, so the cost follows
    the batch, not the table. Keys must determine the day. A caller that knows the first
    and last day of the batch passes them as ``span``; otherwise they are looked up first.
    """
    keys = list(keys)
    batch, day = with_day(df.dropDuplicates(keys), table)
    stored = read_table(df.sparkSession, path)
    if stored is not None:
        first, last = span or batch.agg(F.min(day), F.max(day)).first()
        if first is None:
            return
        known = stored.filter(F.col(day).between(day_lit(first), day_lit(last))).select(*keys)
        batch = batch.join(known, keys, "left_anti")
    if dry_run:
        batch.write.format(NOOP).mode("overwrite").save()
        return
    _by_day(batch, day).write.mode("append").partitionBy(day).parquet(path)


def overwrite_days(
    df: DataFrame, path: str, table: str, sort: Sequence[str] = (), dry_run: bool = False
) -> None:
    """Replace exactly the days present in ``df``; other days stay.

    ``sort`` orders rows inside each file, so that statistics on those columns prune.
    """
    batch, day = with_day(df, table)
    if dry_run:
        batch.write.format(NOOP).mode("overwrite").save()
        return
    files = _by_day(batch, day)
    if sort:
        files = files.sortWithinPartitions(day, *sort)
    (
        files.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def retained(df: DataFrame, ts: str, as_of: datetime, days: int) -> DataFrame:
    """Rows still inside the retention period."""
    limit = as_day(as_of) - timedelta(days=days)
    return df.filter(F.col(ts) >= day_lit(limit).cast("timestamp_ntz"))


def expire(
    spark: SparkSession,
    path: str,
    table: str,
    as_of: datetime,
    days: int = DEFAULTS.retention.history_days,
    dry_run: bool = DEFAULTS.dry_run,
) -> list[date]:
    """Removes the stored days that are out of retention and returns them.

    Days are folders, so nothing is read or rewritten; a second run finds nothing to remove.
    """
    column, _ = PARTITION_DAY[table]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = as_day(as_of) - timedelta(days=days)
    gone = []
    for status in files.listStatus(folder) if files.exists(folder) else ():
        name, _, value = status.getPath().getName().partition("=")
        if name == column and value[:1].isdigit() and date.fromisoformat(value) < limit:
            gone.append(date.fromisoformat(value))
            if not dry_run:
                files.delete(status.getPath(), True)
    return sorted(gone)
