"""Tables that keep one row for each key and grow batch by batch.

Rows are filed by bucket, a hash of their key, so that a batch reads only the buckets it has
keys in. What a batch adds is a folder of its own number, and it looks at the folders of
earlier batches only: a batch that is run again writes the same rows once more in place of
its own. From time to time the batches are put together, so that files stay few.
"""

import re
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadspark.config import BROADCAST_ROWS
from leadspark.sources.tables import empty, remove

#: Of a table that many batches touch in few places, more are better.
BUCKETS = 32


def counted(keys: DataFrame) -> DataFrame:
    """Keys found again, as a side of a join: broadcast where a count shows that they are few,
    else shuffled. Spark's estimate for them is no more than a guess."""
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return keys.hint("broadcast" if few else "merge")


class KeyedTable:
    """Rows of `schema` by `key`, below `path`.

    `filed_by` is the part of the key that names the bucket; all of the key, if not given.
    Among rows of a batch with one key the least stays, the columns compared in order; so
    the first column that is not of the key says which row that is. NULL is a key like any
    other.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        key: Sequence[str],
        filed_by: Sequence[str] = (),
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets
        self.key, self.filed_by = list(key), list(filed_by or key)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.filed_by), F.lit(self.buckets)).cast("int")

    def _folders(self) -> dict[str, list[int]]:
        """Numbers of finished folders: `b` of single batches, `w` of all up to one."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found: dict[str, list[int]] = {"b": [], "w": []}
        if files.exists(root):
            for status in files.listStatus(root):
                name = re.fullmatch(r"part=([bw])(\d+)", status.getPath().getName())
                if name and files.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
                    found[name[1]].append(int(name[2]))
        return found

    def _written(self, names: list[str]) -> DataFrame:
        schema = StructType(list(self.schema.fields)).add("part", "string").add("bucket", "integer")
        if not names:
            return empty(self.spark, schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*(f"{self.path}/part={name}" for name in names))

    def _names(self, before: int | None) -> list[str]:
        """Folders that hold the batches with a number less than `before`."""
        found = self._folders()
        whole = max((n for n in found["w"] if before is None or n < before), default=-1)
        names = [f"w{whole}"] if whole >= 0 else []
        return names + [f"b{n}" for n in sorted(found["b"]) if n > whole and (before is None or n < before)]

    def rows(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of the batches with a number less than `before`, from some buckets only."""
        written = self._written(self._names(before))
        if buckets is not None:
            written = written.where(F.col("bucket").isin(list(buckets)))
        return written.drop("part", "bucket")

    def batch(self, number: int) -> DataFrame:
        """What one batch has added."""
        return self._written([f"b{number}"]).drop("part", "bucket")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that rows lie in; never more than the table has."""
        return sorted(row[0] for row in rows.select(self.bucket()).distinct().collect())

    def _write(self, rows: DataFrame, name: str) -> None:
        filed = rows.select(*self.schema.fieldNames(), self.bucket().alias("bucket"))
        # One file for a bucket, or several where a bucket is large.
        filed = filed.hint("rebalance", "bucket")
        filed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/part={name}")

    def _folded(self, rows: DataFrame) -> DataFrame:
        """The least row of each key."""
        others = [name for name in self.schema.fieldNames() if name not in self.key]
        least = F.min(F.struct(*others) if others else F.lit(0)).alias("_row")
        folded = rows.groupBy(*self.key).agg(least)
        return folded.select(*self.key, *(F.col(f"_row.{name}").alias(name) for name in others))

    def _joined(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Rows of the left with, or without, a key of the right."""
        keys = right.select(*(F.col(name).alias(f"_{name}") for name in self.key))
        same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key))
        return left.join(keys, same, how)

    def known(self, rows: DataFrame, number: int) -> DataFrame | None:
        """The keys of rows that earlier batches have; None where there are no such batches.

        Keep the answer: what is known is read for it, and is longer than any batch. It is
        shuffled in any case: by the size of its packed files Spark would broadcast millions
        of keys, which take a hundred times that in the memory of the driver.
        """
        if not self._names(number):
            return None
        held = self.rows(number, self.buckets_of(rows)).hint("merge")
        return self._joined(rows.select(*self.key), held, "left_semi")

    def _without_known(self, rows: DataFrame, number: int, known: DataFrame | None = None) -> DataFrame:
        """Rows with keys of no earlier batch. Keys alone are compared with all those known;
        the rows themselves meet only the keys found again, and seldom there are any."""
        again = self.known(rows, number) if known is None else known
        if again is None or again.isEmpty():
            return rows
        return self._joined(rows, counted(again), "left_anti")

    def add(
        self, rows: DataFrame, number: int, folded: bool = False, stored: bool = False,
        known: DataFrame | None = None,
    ) -> DataFrame:
        """Add the rows with new keys as batch `number`, and give those back.

        `folded` rows have one row for each key already, `stored` ones are read from files.
        Who has asked for their `known` keys before, and kept them, may give those.
        """
        found = rows if folded else self._folded(rows)
        kept = []
        if self._names(number):  # else the rows are written and not looked at
            if not stored:
                found = found.persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(found)
            if known is None:
                known = self.known(found, number).persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(known)
        try:
            self._write(self._without_known(found, number, known), f"b{number}")
        finally:
            for frame in kept:
                frame.unpersist()
        return self.batch(number)

    def compact(self, upto: int) -> None:
        """Put the batches up to a number together.

        Folders that the last such table had put together go; the others stay, for whoever
        still reads them.
        """
        found = self._folders()
        before = max((n for n in found["w"] if n < upto), default=-1)
        self._write(self.rows(upto + 1), f"w{upto}")
        old = [f"b{n}" for n in found["b"] if n <= before] + [f"w{n}" for n in found["w"] if n < before]
        for name in old:
            remove(self.spark, f"{self.path}/part={name}")
