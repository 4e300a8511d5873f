"""Profiles of all tables of a schema, one job per table with an outcome of its own.

A table that cannot be read or profiled gives a ``failed`` outcome with its reason; the profiles
of all others are complete. At most ``at_once`` tables are profiled at the same time.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from vigil.operators.profile import APPROXIMATE, all_tables
from vigil.plans.scratch import stored

Table = DataFrame | Callable[[], DataFrame]

OUTCOME = (
    "table_name string, status string, error_class string, reason string, "
    "profiled_columns long, profiled_rows long"
)


@dataclass(frozen=True)
class BulkProfile:
    """``outcomes`` has one row per table; ``profiles`` is None when no table could be profiled."""

    outcomes: DataFrame
    profiles: DataFrame | None


def _reason(error: Exception) -> tuple[str, str]:
    """Class and first line of an error."""
    named = error.getCondition() if isinstance(error, PySparkException) else None
    lines = str(error).strip().splitlines() or [""]
    return named or type(error).__name__, lines[0]


def _profiled(table: Table, name: str, stamps: Mapping[str, str], distinct: str):
    """The written profile of a table, with the columns and rows it speaks of."""
    df = table() if callable(table) else table
    part = stored(all_tables({name: df}, stamps, distinct=distinct), "profile")
    seen = part.agg(F.count_distinct("column_name").alias("c"), F.sum("row_count").alias("n")).first()
    return part, seen.c, (seen.n or 0) // max(1, seen.c)


def run(
    spark: SparkSession,
    tables: Mapping[str, Table],
    timestamp_columns: Mapping[str, str] | None = None,
    exclude: Sequence[str] = (),
    distinct: str = APPROXIMATE,
    at_once: int = 4,
) -> BulkProfile:
    """Profile ``tables``: data, or functions that read it, so that a failing read is the
    table's own. Excluded tables have the outcome ``excluded``."""
    stamps = dict(timestamp_columns or {})

    def one(name: str):
        if name in exclude:
            return (name, "excluded", None, None, None, None), None
        try:
            part, columns, rows = _profiled(tables[name], name, stamps, distinct)
        except Exception as error:  # the outcome of this table, whatever it is
            return (name, "failed", *_reason(error), None, None), None
        status = "created_timeseries" if name in stamps else "created_snapshot"
        return (name, status, None, None, columns, rows), part

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        ended = list(pool.map(inheritable_thread_target(spark)(one), tables))
    profiles = None
    for _, part in ended:
        if part is not None:
            profiles = part if profiles is None else profiles.unionByName(part)
    outcomes = spark.createDataFrame([outcome for outcome, _ in ended], OUTCOME)
    return BulkProfile(outcomes, profiles)
