"""Merge the two checks of a lead, decide on it and send it on its way."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark import config
from leadspark.functions import scoring
from leadspark.functions.clock import as_of_text
from leadspark.functions.text import filled
from leadspark.schemas import FINAL_ANALYSIS

REVIEW = "Manual Review"


def merge_branches(
    leads: DataFrame, verified: DataFrame, controlled: DataFrame, key: str = "lead_id"
) -> DataFrame:
    """Put the outputs of both checks beside their lead."""
    return leads.join(verified.select(key, "verification"), key).join(
        controlled.select(key, "internal_qc"), key
    )


def merge_partials(partials: DataFrame, key: str = "lead_id") -> DataFrame:
    """Join half-records from one queue; a lead with one half only has to wait."""
    others = [name for name in partials.columns if name != key]
    merged = partials.groupBy(key).agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in others]
    )
    return merged.where("verification is not null and internal_qc is not null")


def with_decision(enriched: DataFrame, as_of: str | None = None) -> DataFrame:
    outcome = scoring.decision(
        F.col("verification.confidenceScore"), F.col("internal_qc.qualityScore")
    )
    return enriched.withColumns(
        {"decision": outcome, "decisionTimestamp": as_of_text(as_of)}
    )


def raw_decision(record: Column) -> Column:
    """Decision on an enriched record whose two objects may hold anything."""
    return scoring.decision(
        scoring.raw_score(record, "$.verification.confidenceScore"),
        scoring.raw_score(record, "$.internal_qc.qualityScore"),
    )


def final_record() -> Column:
    """The fields of a final analysis as one struct."""
    return F.struct(*FINAL_ANALYSIS.fieldNames())


def route(final: DataFrame) -> dict[str, DataFrame]:
    """Where each lead goes: to the reviewers, or to the results; approved also to alerts."""
    return {
        "review": final.where(F.col("decision") == REVIEW),
        "final-analysis": final.where(F.col("decision") != REVIEW),
        "final-leads": final.where(F.col("decision") == "Approved"),
    }


def destinations(decision: Column) -> Column:
    """The same per row, as an array of names."""
    return (
        F.when(decision == REVIEW, F.array(F.lit("review")))
        .when(
            decision == "Approved",
            F.array(F.lit("final-analysis"), F.lit("final-leads")),
        )
        .otherwise(F.array(F.lit("final-analysis")))
    )


def outcome(company: Column, decision: Column, error: Column) -> tuple[Column, Column]:
    """Code and message that answer a record."""
    code = F.when(error.isNotNull(), 400).otherwise(200)
    message = (
        F.when(error.isNotNull(), filled(config.INVALID_MESSAGE, error=error))
        .when(decision == REVIEW, filled(config.REVIEW_MESSAGE, company=company))
        .otherwise(filled(config.PUBLISHED_MESSAGE, company=company, decision=decision))
    )
    return code, message


def review_log(review: DataFrame) -> DataFrame:
    """The log event of each lead that needs a review, as JSON."""
    event = F.struct(F.lit(True).alias("review_required"), "companyName", "summary")
    return review.withColumn("event", F.to_json(event))


def review_alerts(events: DataFrame, window: str, threshold: int = 0) -> DataFrame:
    """Windows with more review events than the threshold; works on streams as well."""
    counts = (
        events.where("review_required")
        .groupBy(F.window("ts", window).alias("window"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    return counts.where(F.col("n_events") > threshold).select(
        F.col("window.start").alias("window_start"), "n_events"
    )
