"""Inline sample rows and generated sample tables, always with an explicit schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.exprs import ts_lit

# The sample rows of the bronze layer.
CUSTOMERS_SCHEMA = (
    "customer_id bigint, email string, first_name string, last_name string, "
    "created_date string, status string, age bigint, phone_number string"
)
CUSTOMERS = [
    (1, "john.doe@email.com", "John", "Doe", "2024-01-15", "active", 35, "555-1234"),
    (2, "jane.smith@email.com", "Jane", "Smith", "2024-01-16", "active", 28, "555-5678"),
    (3, None, "Invalid", "User", "2024-01-17", "active", 150, "555-9999"),
    (4, "bob@email.com", "Bob", "Johnson", "2024-01-18", "inactive", 42, "555-1111"),
    (5, "alice.wong@email.com", "Alice", "Wong", "2024-01-19", "suspended", 31, "555-2222"),
]
ORDERS_SCHEMA = (
    "order_id bigint, customer_id bigint, order_date string, order_amount double, "
    "order_status string, shipped_date string"
)
ORDERS = [
    (101, 1, "2024-01-20", 150.00, "completed", "2024-01-20"),
    (102, 2, "2024-01-21", 225.50, "completed", "2024-01-21"),
    (103, 1, "2024-01-22", 89.99, "pending", None),
    (104, 999, "2024-01-23", 500.00, "completed", "2024-01-23"),
    (105, 4, "2024-01-24", -50.00, "completed", "2024-01-24"),
]


def sample_customers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CUSTOMERS, CUSTOMERS_SCHEMA)


def sample_orders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ORDERS, ORDERS_SCHEMA)


def generated_runs(
    spark: SparkSession, as_of: datetime, rows: int = 1000, seed: int = 42
) -> DataFrame:
    """Job runs made up inside the executors; the same seed gives the same rows, however many
    cores share the work: every value is a hash of the row's number."""

    def drawn(salt: int, size: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(size))

    roll = drawn(0, 1_000_000) / 1_000_000
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), drawn(1, 86_400).cast("int"))
    return (
        spark.range(rows)
        .withColumns({"_roll": roll, "start_time": ts_lit(as_of) - back})
        .select(
            (F.col("id") % 20).alias("job_id"),
            F.concat(F.lit("job_"), (F.col("id") % 20).cast("string")).alias("job_name"),
            F.col("id").alias("run_id"),
            "start_time",
            F.when(F.col("_roll") < 0.9, "SUCCESS").otherwise("FAILED").alias("result_state"),
        )
    )


def schema_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Table names of one schema."""
    return [t.name for t in spark.catalog.listTables(database)]
