"""Catalogs: the sources of a cycle and the relevance keywords."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark import config
from leadspark.schemas import SOURCE


def source_catalog(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Configured sources, or those of a JSON file in a shared folder."""
    if path is None:
        return spark.createDataFrame(list(config.SOURCES), SOURCE)
    return spark.read.schema(SOURCE).option("multiLine", True).json(path)


def keyword_catalog(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per keyword of a JSON object {"keywords": [...]}, or of one such object in
    each line, which is how a long catalog is kept: its files are then read in pieces."""
    listed = spark.read.schema("keywords array<string>").option("multiLine", not lines)
    return listed.json(path).select(F.explode("keywords").alias("keyword"))
