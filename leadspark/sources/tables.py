"""Stage tables: append-only Parquet that one stage writes and the next one reads."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leadspark.config import STAGES


def stage_path(root: str, stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"no such stage: {stage}")
    return f"{root}/{stage}"


def file_stream(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """A stream over Parquet files; the path may be a folder, one file or a glob."""
    # A plain path must be a folder for a stream. As a glob it may be either.
    pattern = path if path.endswith("]") else f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).options(**options).parquet(pattern)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived, each row exactly once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batch(
    rows: DataFrame, path: str, batch_id: int, partition_by: str | None = None
) -> None:
    """One micro-batch of a table; a batch that is run again replaces its own rows."""
    writer = rows.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/batch={batch_id}")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema, without a Python worker to send none."""
    return spark.range(0).select(*(F.lit(None).cast(x.dataType).alias(x.name) for x in schema))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def warehouse_rows(final: DataFrame) -> DataFrame:
    """Final analyses as one JSON column, with the decision and day they are filed under."""
    return final.select(
        F.to_json(F.struct(*[F.col(name) for name in final.columns])).alias("data"),
        F.substring("decisionTimestamp", 1, 10).alias("decision_date"),
        "decision",
    )


def append_warehouse(final: DataFrame, path: str) -> None:
    rows = warehouse_rows(final)
    rows.write.mode("append").partitionBy("decision_date", "decision").parquet(path)


def typed_warehouse(rows: DataFrame, schema: StructType, *names: str) -> DataFrame:
    """The JSON column with types again, for reports; unknown fields are dropped.

    With `names` no other fields are parsed, and what rows are filed by is not parsed at
    all. Each row is parsed once, and filters on the result do not parse it again. To read
    one decision only, filter `rows` by it: they are filed by decision and day.
    """
    wanted = names or schema.fieldNames()
    filed = [name for name in wanted if names and name in rows.columns]
    asked = StructType([schema[name] for name in wanted if name not in filed])
    parsed = rows.select(*filed, F.from_json("data", asked).alias("record"))
    return parsed.select(*filed, F.inline(F.array("record"))).select(*wanted)
