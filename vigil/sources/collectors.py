"""Collectors: raw platform records -> stored metric tables, for one lookback.

Each is a filter and a projection; they trigger no job of their own.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil import schemas
from vigil.functions.exprs import seconds_between, since, since_day, ts_lit
from vigil.settings import DEFAULTS, Rates

# Size words in a node type and the DBU rate of one such node.
NODE_RATES = (("%xl%", "2.5"), ("%large%", "1.5"))
NODE_RATE_OTHER = "1.0"


def optional(spark: SparkSession, read: Callable[[], DataFrame], schema: StructType) -> DataFrame:
    """A source that may be absent: an unresolvable one becomes an empty table.

    Only resolution is guarded; failures while running still surface.
    """
    try:
        df = read()
        df.schema
        return df
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _stamped(df: DataFrame, schema: StructType, as_of: datetime) -> DataFrame:
    return df.withColumn("ingestion_timestamp", ts_lit(as_of)).select(*schema.fieldNames())


def cost_metrics(usage: DataFrame, as_of: datetime, days: int = DEFAULTS.lookback_days) -> DataFrame:
    cost = (F.col("usage_quantity") * F.col("list_price")).cast("decimal(18,4)")
    recent = usage.filter(since_day("usage_date", as_of, days)).withColumn("cost", cost)
    return _stamped(recent, schemas.COST_METRICS, as_of)


def with_run_cost(runs: DataFrame, rates: Rates = DEFAULTS.rates) -> DataFrame:
    """Duration, estimated usage and cost of finished runs; NULL while running."""
    hours = F.col("duration_seconds").cast("decimal(18,0)") * F.lit(Decimal(rates.dbu_per_hour))
    return runs.withColumn("duration_seconds", seconds_between("start_time", "end_time")).withColumns(
        {
            "total_dbu_usage": (hours / F.lit(3600)).cast("decimal(18,6)"),
            "total_cost": (hours * F.lit(Decimal(rates.cost_per_dbu)) / F.lit(3600)).cast(
                "decimal(18,6)"
            ),
        }
    )


def job_metrics(
    runs: DataFrame,
    as_of: datetime,
    days: int = DEFAULTS.lookback_days,
    rates: Rates = DEFAULTS.rates,
) -> DataFrame:
    recent = with_run_cost(runs.filter(since("start_time", as_of, days=days)), rates)
    return _stamped(recent, schemas.JOB_METRICS, as_of)


def cluster_metrics(
    clusters: DataFrame, as_of: datetime, days: int = DEFAULTS.lookback_days
) -> DataFrame:
    node_rate = F.lit(Decimal(NODE_RATE_OTHER))
    for pattern, rate in reversed(NODE_RATES):
        node_rate = F.when(
            F.col("driver_node_type_id").like(pattern), F.lit(Decimal(rate))
        ).otherwise(node_rate)
    recent = clusters.filter(since("timestamp", as_of, days=days)).withColumns(
        {
            "driver_node_type": F.col("driver_node_type_id"),
            "worker_node_type": F.col("node_type_id"),
            "autoscale_min_workers": F.col("autoscale.min_workers"),
            "autoscale_max_workers": F.col("autoscale.max_workers"),
            "uptime_seconds": F.col("uptime_in_seconds"),
            "dbu_rate": (node_rate * (F.col("num_workers") + 1)).cast("decimal(10,1)"),
        }
    )
    return _stamped(recent, schemas.CLUSTER_METRICS, as_of)


def query_metrics(
    history: DataFrame, as_of: datetime, days: int = DEFAULTS.lookback_days
) -> DataFrame:
    recent = history.filter(since("query_start_time", as_of, days=days))
    return _stamped(recent, schemas.QUERY_METRICS, as_of)


def event_logs(
    log: DataFrame,
    as_of: datetime,
    days: int = DEFAULTS.lookback_days,
    pipeline_id: str | None = None,
) -> DataFrame:
    recent = log.filter(since("timestamp", as_of, days=days))
    if pipeline_id is not None:
        recent = recent.filter(F.col("origin.pipeline_id") == pipeline_id)
    return _stamped(
        recent.select(
            F.col("id").alias("event_id"),
            "origin.pipeline_id",
            "origin.pipeline_name",
            "origin.update_id",
            *[c for c in log.columns if c != "id"],
        ),
        schemas.EVENTS,
        as_of,
    )


def table_lineage(
    lineage: DataFrame, as_of: datetime, days: int = DEFAULTS.lineage_lookback_days
) -> DataFrame:
    recent = lineage.filter(since("event_time", as_of, days=days))
    return _stamped(recent, schemas.LINEAGE, as_of)


def column_lineage(
    lineage: DataFrame, as_of: datetime, days: int = DEFAULTS.lineage_lookback_days
) -> DataFrame:
    recent = lineage.filter(since("event_time", as_of, days=days))
    return recent.select(*schemas.COLUMN_LINEAGE.fieldNames())
