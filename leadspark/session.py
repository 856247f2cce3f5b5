"""Session settings the jobs rely on, shared folders, and the check before a broadcast."""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.config import BROADCAST_ROWS

SETTINGS = {
    # JSON text with a repeated key keeps the last one.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Hot keys of a join are split at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python gets rows by size and not by number alone: texts may be long.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Stream state goes to disk and not to the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def state_partitions(spark: SparkSession, number: int | None = None):
    """Streams started inside keep their state in one part per core, or in `number` parts.

    A stream keeps the number it starts with, so it is chosen apart from that of batches.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(number or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the shared folder the cluster names.

    That is the folder in spark.checkpoint.dir, or else the warehouse. Executors on other
    machines do not see a warehouse on the driver's disk, so that is refused there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.split("[")[0] == "local"
        if not local and base.startswith(("file:", "/")):
            raise ValueError(f"spark.checkpoint.dir is unset and {base} is not shared")
    return f"{base.rstrip('/')}/leadspark/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side for broadcast after counting that it is small; else leave it to shuffle."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer files than cores, dealt to all cores for costly work on each row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df._jdf.inputFiles()) < cores else df
