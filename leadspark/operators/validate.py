"""Decode and check records; the good ones get types, the others a quarantine row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadspark.functions import envelope
from leadspark.functions.checks import RecordType
from leadspark.operators.once import with_once


def decode(messages: DataFrame, data: str = "data") -> DataFrame:
    """Add `text` and `record` of an envelope, and `rejected` where it did not decode."""
    texts = messages.withColumn("text", envelope.decoded_text(F.col(data)))
    return texts.withColumn("record", envelope.strict_json(F.col("text"))).withColumn(
        "rejected", envelope.rejection(F.col(data), F.col("record"))
    )


def parse(bodies: DataFrame, text: str = "text") -> DataFrame:
    """Add `record` of a plain JSON body, and `rejected` where it is not JSON."""
    parsed = bodies.withColumn("record", envelope.strict_json(F.col(text)))
    return parsed.withColumn("rejected", F.when(F.col("record").isNull(), "not_json"))


def check(parsed: DataFrame, expected: RecordType) -> DataFrame:
    """Add `errors`, `first_error` and `values`; a record that did not parse has one error.

    A record is parsed and checked once, also where good and bad ones part ways later.
    """
    shaped = parsed.withColumn("shape", F.schema_of_variant("record"))
    valued = shaped.withColumn("values", expected.values())
    judged = valued.withColumn("good", expected.good())
    fields = judged.withColumn("kinds", F.when(~F.col("good"), expected.kinds()))
    found = F.when(F.col("rejected").isNotNull(), F.array("rejected")).otherwise(
        expected.errors()
    )
    checked = with_once(fields, "errors", found).drop("shape", "good", "kinds")
    return checked.withColumn("first_error", F.get("errors", F.lit(0)))


def typed(checked: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """All records beside the columns to keep; the fields of bad ones are NULL."""
    fields = [
        F.when(F.col("first_error").isNull(), F.col(f"values.{field.name}"))
        .cast(field.dataType)
        .alias(field.name)
        for field in schema
    ]
    return checked.select(*keep, *fields)


def accepted(checked: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """Records without errors, typed, beside the columns to keep."""
    return typed(checked.where("first_error is null"), schema, *keep)


def quarantined(
    checked: DataFrame, stage: str, raw: str = "text", *keep: str
) -> DataFrame:
    """Records with errors: stage, reason and raw text."""
    return checked.where("first_error is not null").select(
        *keep,
        F.lit(stage).alias("stage"),
        F.col("first_error").alias("reason"),
        F.col(raw).alias("raw"),
    )


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n_records"))
