"""Tables that one operator writes between its steps.

They go to the folder all executors share. A written table ends the lineage, so a lost
executor costs only its own tasks, and every later read sees the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark.session import shared_dir


class Workspace:
    """Tables of one run of an operator, by name."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = shared_dir(spark, name)

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that a later one has replaced."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        self._files(path).delete(path, True)

    def keep(self, *names: str) -> None:
        """Remove all tables but these, which a result still reads."""
        base = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        files = self._files(base)
        for found in files.listStatus(base) if files.exists(base) else ():
            if found.getPath().getName() not in names:
                files.delete(found.getPath(), True)

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())


def unused(columns: list[str], *names: str) -> list[str]:
    """Names for working columns that no column has; upper and lower case are alike."""
    taken, out = {name.lower() for name in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def one_text_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text): the documents whose ids are in `ids`, a bounded sample, each once. Of
    different texts under one id the one with the smallest hash is taken."""
    found = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    return found.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
