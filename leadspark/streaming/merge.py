"""Put the two halves of a lead together as they arrive; lone halves go to quarantine.

Halves that wait are a table, rewritten with every batch from that of the batch before, so
that a batch that is run again gives the same. No half is lost: it is merged, replaced by a
later copy of itself, waiting, or in quarantine with a reason, however late it comes.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructType

from leadspark.schemas import INTERNAL_QC, VERIFICATION
from leadspark.sources.keyed import KeyedTable, counted
from leadspark.sources.tables import empty, remove, write_batch

# The halves, with the types they have unless others are given.
HALVES = {"verification": VERIFICATION, "internal_qc": INTERNAL_QC}
LONE = "other half missing or late"
REPEATED = "already merged"


class HalfMerger:
    """Halves of leads by `key`, below `path`: merged, waiting and quarantine.

    Halves whose times are at most `apart` seconds apart make a lead. A half waits until
    the latest time seen is `apart` and `delay` seconds after its own; `delay` is how far
    behind a half may come. Of several copies of a half the latest counts.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str = "lead_id", kind: str = "long",
        apart: int = 600, delay: int = 600, types: Mapping[str, DataType] = HALVES,
    ):
        self.spark, self.path, self.key, self.apart, self.delay = spark, path, key, apart, delay
        whole = StructType().add(key, kind)
        state = StructType().add(key, kind)
        for name in HALVES:
            whole = whole.add(name, types[name])
            state = state.add(name, types[name]).add(f"{name}_ts", "timestamp")
        self.state = state.add("latest", "timestamp")
        self.merged = KeyedTable(spark, f"{path}/merged", whole, [key])

    def halves(self, verified: DataFrame, controlled: DataFrame) -> DataFrame:
        """Both feeds as one; each has the key, its half and `ts`, without which a half is
        as old as can be."""
        parts = []
        for name, feed in zip(HALVES, (verified, controlled), strict=True):
            ts = F.coalesce("ts", F.timestamp_seconds(F.lit(0)))
            parts.append(feed.select(self.key, name, ts.alias(f"{name}_ts")))
        return parts[0].unionByName(parts[1], allowMissingColumns=True)

    def waiting(self, number: int) -> DataFrame:
        """Halves that wait after a batch; none before the first."""
        if number < 0:
            return empty(self.spark, self.state)
        return self.spark.read.schema(self.state).parquet(f"{self.path}/waiting/batch={number}")

    def quarantine(self) -> DataFrame:
        """(key, half, reason, raw) of lone halves."""
        return self.spark.read.schema(self._quarantine_schema()).parquet(f"{self.path}/quarantine")

    def _quarantine_schema(self) -> StructType:
        text = StructType().add(self.state[self.key])
        return text.add("half", "string").add("reason", "string").add("raw", "string")

    def _folded(self, rows: DataFrame) -> DataFrame:
        """One row for each lead: the latest of each half, and the latest time of all."""
        latest = [
            x for name in HALVES
            for x in (F.max_by(name, f"{name}_ts").alias(name), F.max(f"{name}_ts").alias(f"{name}_ts"))
        ]
        return rows.groupBy(self.key).agg(*latest)

    def add(self, halves: DataFrame, number: int, last: bool = False) -> None:
        """Take in one batch. With `last` nothing waits any longer."""
        before = self.waiting(number - 1)
        state = self._folded(before.drop("latest").unionByName(halves, allowMissingColumns=True))
        path = f"{self.path}/states/batch={number}"
        state.write.mode("overwrite").parquet(path)
        state = self.spark.read.schema(state.schema).parquet(path)
        # The latest times are looked up in what is written: the feeds are worked out once.
        times = [F.max(F.unix_micros(f"{name}_ts")) for name in HALVES]
        latest = before.agg(F.max(F.unix_micros("latest"))).first()[0]
        seen = [x for x in (latest, *state.agg(*times).first()) if x is not None]
        now = F.timestamp_micros(F.lit(max(seen, default=0)))

        names = list(HALVES)
        first, second = (F.unix_timestamp(f"{name}_ts") for name in names)
        both = F.col(f"{names[0]}_ts").isNotNull() & F.col(f"{names[1]}_ts").isNotNull()
        fits = both & (F.abs(first - second) <= self.apart)

        # Every half that is not merged: the older one of two that do not fit has no chance
        # left, and the others have one until their time is over.
        limit = now - F.expr(f"interval {self.apart + self.delay} seconds")
        gone = {
            name: F.coalesce(F.col(f"{name}_ts") < F.col(f"{other}_ts"), F.lit(False))
            | F.lit(last) | (F.col(f"{name}_ts") < limit)
            for name, other in zip(names, reversed(names), strict=True)
        }
        over = {name: F.col(f"{name}_ts").isNotNull() & gone[name] for name in names}
        # What is known is as long as all batches. One look at it tells which leads are merged
        # already, of those that fit now and of those with lone halves.
        asked = state.where(reduce(Column.__or__, over.values(), fits)).select(self.key)
        known = self.merged.known(asked, number)
        if known is not None:
            known = known.persist(StorageLevel.MEMORY_AND_DISK)
        # One row for each key, and read from files: neither folded nor kept again.
        whole = state.where(fits).select(self.key, *names)
        self.merged.add(whole, number, folded=True, stored=True, known=known)

        open_ = state.where(~F.coalesce(fits, F.lit(False)))
        parts = [
            F.when(over[name], F.struct(F.lit(name).alias("half"), F.to_json(name).alias("raw")))
            for name in names
        ]
        told = open_.select(self.key, F.inline(F.array_compact(F.array(*parts))))
        reason = F.lit(LONE)
        if known is not None:
            told = told.join(counted(known.withColumn("known", F.lit(True))), self.key, "left")
            reason = F.when(F.col("known"), REPEATED).otherwise(reason)
        write_batch(told.select(self.key, "half", reason.alias("reason"), "raw"), f"{self.path}/quarantine", number)
        if known is not None:
            known.unpersist()

        held = [
            F.when(~gone[name], F.col(column)).alias(column)
            for name in names for column in (name, f"{name}_ts")
        ]
        waits = F.coalesce(*(F.col(f"{name}_ts") for name in names)).isNotNull()
        stays = open_.select(self.key, *held).where(waits)
        write_batch(stays.withColumn("latest", now), f"{self.path}/waiting", number)
        for name in ("states", "waiting"):  # a batch run again needs the one before it only
            remove(self.spark, f"{self.path}/{name}/batch={number - 2}")

    def finish(self, number: int) -> None:
        """Send what still waits after batch `number` to quarantine, as batch `number` + 1."""
        self.add(empty(self.spark, self.state).drop("latest"), number + 1, last=True)


def last_batch(spark: SparkSession, path: str) -> int:
    """The number of the last batch that a merger has written, or -1."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/waiting")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return -1
    names: Sequence[str] = [x.getPath().getName() for x in files.listStatus(root)]
    return max((int(x.split("=")[1]) for x in names if x.startswith("batch=")), default=-1)


def start_merge(
    merger: HalfMerger, verified: DataFrame, controlled: DataFrame, checkpoint: str
) -> StreamingQuery:
    """Merge two feeds of halves."""
    return (
        merger.halves(verified, controlled)
        .writeStream.foreachBatch(merger.add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
