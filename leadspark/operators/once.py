"""Columns that are worth computing only once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column. Filters on it stay above the explode() of its one value; otherwise
    they would move below it with a copy of the expression, and it would be run twice."""
    held = f"_{name}"
    kept = [column for column in frame.columns if column != name]
    return frame.withColumn(held, value).select(*kept, F.explode(F.array(held)).alias(name))
