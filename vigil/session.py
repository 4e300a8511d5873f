"""Session settings the engine is designed around.

On a cluster the session comes from the platform; ``local_session`` serves
tests and the benchmark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings, safe to set on any session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sessions of a busy key are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Streaming state on local disk instead of the heap, with changes logged to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results or plans depend on."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, memory: str = "12g", app: str = "vigil") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
