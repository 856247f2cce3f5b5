"""Internal checks of a lead: rules, consistency and tone."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark import config
from leadspark.functions import scoring
from leadspark.functions.clock import as_of_text


def with_internal_qc(
    leads: DataFrame,
    as_of: str | None = None,
    tone: Column | None = None,
    rules: Sequence[scoring.Rule] = scoring.RULES,
    total_rules: int = config.TOTAL_RULES,
) -> DataFrame:
    """Add the struct `internal_qc`; a tone check may be given as a column."""
    checked = leads.withColumns(
        {
            "failedRules": scoring.failed_rules(rules),
            "logicalConsistency": scoring.logical_consistency(),
            "toneAnalysis": F.lit("Passed") if tone is None else tone,
        }
    )
    n_failed = F.size("failedRules")
    score = scoring.quality_score(
        F.col("failedRules"), F.col("logicalConsistency"), F.col("toneAnalysis")
    )
    parts = F.struct(
        score.alias("qualityScore"),
        (F.lit(total_rules) - n_failed).alias("rulesPassed"),
        n_failed.alias("rulesFailed"),
        "failedRules",
        "logicalConsistency",
        "toneAnalysis",
        as_of_text(as_of).alias("lastCheckedTimestamp"),
    )
    return checked.withColumn("internal_qc", parts).drop(
        "failedRules", "logicalConsistency", "toneAnalysis"
    )
