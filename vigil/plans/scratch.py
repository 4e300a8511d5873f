"""Shared-folder scratch space: checkpoints and written tables.

A cluster names the folder in ``spark.checkpoint.dir``. Only a local master may
fall back to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables of this session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="vigil-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result outlives lost executors and ends the lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{scratch_root(spark)}/rdd")
    return df.checkpoint(eager=True)


def cut_counting(df: DataFrame, what: Column | None = None) -> tuple[DataFrame, int]:
    """``cut`` that also returns the number of rows, or the sum of ``what``, from the same job."""
    seen = Observation()
    amount = F.count(F.lit(1)) if what is None else F.coalesce(F.sum(what), F.lit(0))
    out = cut(df.observe(seen, amount.cast("bigint").alias("n")))
    return out, seen.get["n"]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result once as Parquet and read it back.

    Chosen over ``cut`` where several later scans profit from columns and statistics.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_counting(
    df: DataFrame, what: Column | None = None, label: str = "step"
) -> tuple[DataFrame, int]:
    """``stored`` that also returns the number of rows, or the sum of ``what``, from the same job.

    Writing computes the rows once, where a checkpoint computes them for the result and again
    for its files.
    """
    seen = Observation()
    amount = F.count(F.lit(1)) if what is None else F.coalesce(F.sum(what), F.lit(0))
    out = stored(df.observe(seen, amount.cast("bigint").alias("n")), label)
    return out, seen.get["n"]
