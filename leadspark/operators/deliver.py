"""Alerts and reports on approved leads."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark import config
from leadspark.functions.text import filled


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("undefined"))


_TEXT_TYPE = "struct<type:string,text:string>"
_BLOCK_TYPE = (
    f"struct<type:string,text:{_TEXT_TYPE},"
    f"fields:array<{_TEXT_TYPE}>,elements:array<{_TEXT_TYPE}>>"
)


def _text(template: str, kind: str = "mrkdwn", **values: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), filled(template, **values).alias("text"))


def _block(kind: str, **parts: Column) -> Column:
    """One block of an alert. All have one shape; JSON leaves out what is NULL."""
    names = ("text", "fields", "elements")
    return F.struct(
        F.lit(kind), *[parts.get(name, F.lit(None)) for name in names]
    ).cast(_BLOCK_TYPE)


def alert_payload() -> Column:
    """The alert on a lead: a line of text and five blocks."""
    company = _shown(F.col("companyName"))
    needs = F.array_join("potentialNeed", config.ALERT_NEED_SEPARATOR, "")
    industry = _text(config.ALERT_INDUSTRY, industry=_shown(F.col("industry")))
    region = _text(config.ALERT_REGION, region=_shown(F.col("region")))
    opportunity = _text(config.ALERT_OPPORTUNITY, summary=_shown(F.col("summary")))
    source = _text(config.ALERT_SOURCE, url=_shown(F.col("sourceURL")))
    confidence = _text(
        config.ALERT_CONFIDENCE,
        confidence=_shown(F.col("verification.confidenceScore")),
    )
    blocks = F.array(
        _block("header", text=_text(config.ALERT_HEADER, "plain_text", company=company)),
        _block("section", fields=F.array(industry, region)),
        _block("section", text=opportunity),
        _block("section", text=_text(config.ALERT_NEEDS, needs=needs)),
        _block("context", elements=F.array(source, confidence)),
    )
    line = filled(config.ALERT_LINE, company=company)
    return F.struct(line.alias("text"), blocks.alias("blocks"))


def deliverable() -> Column:
    """A lead without checks or needs cannot be told."""
    return F.col("verification").isNotNull() & F.col("potentialNeed").isNotNull()


def alerts(leads: DataFrame) -> DataFrame:
    """Add the payload as JSON; leads that cannot be told are left out."""
    return leads.where(deliverable()).withColumn("payload", F.to_json(alert_payload()))


def undeliverable(leads: DataFrame) -> DataFrame:
    """The others, as quarantine rows."""
    reason = F.when(F.col("potentialNeed").isNull(), "potentialNeed:required").otherwise(
        "verification:required"
    )
    return leads.where(~deliverable()).select(
        F.lit("final-leads").alias("stage"),
        reason.alias("reason"),
        F.to_json(F.struct("*")).alias("raw"),
    )


def lead_report(final: DataFrame) -> DataFrame:
    """Table of approved leads."""
    return final.where(F.col("decision") == "Approved").select(
        "companyName", "summary", "sourceURL", "opportunityScore"
    )


def region_scores(final: DataFrame) -> DataFrame:
    """Number, sum and mean of the scores of approved leads by region."""
    return (
        final.where(F.col("decision") == "Approved")
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("n_leads"),
            F.sum("opportunityScore").alias("sum_score"),
            F.avg("opportunityScore").alias("avg_score"),
        )
    )
