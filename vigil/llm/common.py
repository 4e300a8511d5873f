"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.plans.scratch import scratch_path
from vigil.session import tune

# Rows that cross to Python at once: texts average a few kB, long ones many times that.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20

# Names of helper columns; input columns must not use them.
ROW, SPANS = "__row__", "__spans__"


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of this package: small Arrow batches, shuffle files dropped after use."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


class Scratch:
    """Tables written once to the shared folder, dropped together or one by one.

    A written table survives lost executors and ends the plan behind it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = self.paths[label] = scratch_path(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        """Remove the tables named, or all."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for label in labels or list(self.paths):
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(label))
            path.getFileSystem(conf).delete(path, True)


def keyed(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text"):
    """``docs`` with a unique number ``__row__`` in the order of the ids.

    The id itself serves when no id is null or repeated. Otherwise rows are numbered by
    (id, text), nulls first, and the numbered table is written once so that numbers stay.
    """
    repeats = docs.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1))
    if repeats.isEmpty():
        return docs.withColumn(ROW, F.col(id_col).cast("long"))
    ordered = docs.sort(F.col(id_col).asc_nulls_first(), F.xxhash64(text), F.col(text))
    return scratch.put(ordered.withColumn(ROW, F.monotonically_increasing_id()), "keyed")


Batches = Iterator[pa.RecordBatch]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, giving freed memory back to the system after a partition.

    Python workers are used again for later stages; what their allocators keep would add up
    beside the memory of the executor.
    """

    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return wrapped


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """An Arrow batch from columns in the order of the schema."""
    arrays = [
        column if isinstance(column, pa.Array) else pa.array(column, type=field.type)
        for column, field in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
