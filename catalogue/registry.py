"""Registration of queries next to the SQL that states the same result independently."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, MapType, TimestampType

from catalogue.base_sql import query as with_views
from vigil.session import tune

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that both engines print alike: days as text, decimals as doubles, lists joined."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(field.dataType, ArrayType):
            col = F.array_join(col.cast("array<string>"), ",")
        elif isinstance(field.dataType, MapType):
            continue
        out.append(col.alias(field.name))
    return df.select(*out)


def register(name: str, sql: str | None = None):
    """Add a query; ``sql`` is its independent statement over the same tables."""

    def add(run: Run) -> Run:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(run(tune(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = wrapped
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return run

    return add
