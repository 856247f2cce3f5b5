"""Schemas of the records that pass between the stages."""

from pyspark.sql import types as T

STRING, INT = T.StringType(), T.IntegerType()
STRINGS = T.ArrayType(STRING)

SOURCE = T.StructType().add("source_url", STRING).add("source_type", STRING)

ARTICLE_REF = T.StructType().add("article_url", STRING).add("source_domain", STRING)

ARTICLE = (
    T.StructType()
    .add("clean_text", STRING)
    .add("source_url", STRING)
    .add("source_domain", STRING)
)

ANALYSIS = (
    T.StructType()
    .add("companyName", STRING)
    .add("industry", STRING)
    .add("region", STRING)
    .add("opportunityType", STRING)
    .add("summary", STRING)
    .add("potentialNeed", STRINGS)
    .add("opportunityScore", INT)
    .add("keyQuote", STRING)
    .add("sourceURL", STRING)
)

VERIFICATION = (
    T.StructType()
    .add("confidenceScore", INT)
    .add("sourceReputationScore", INT)
    .add("corroboratingSources", INT)
    .add("corroboratingUrls", STRINGS)
    .add("evidenceId", STRING)
    .add("lastCheckedTimestamp", STRING)
)

INTERNAL_QC = (
    T.StructType()
    .add("qualityScore", INT)
    .add("rulesPassed", INT)
    .add("rulesFailed", INT)
    .add("failedRules", STRINGS)
    .add("logicalConsistency", STRING)
    .add("toneAnalysis", STRING)
    .add("lastCheckedTimestamp", STRING)
)

FINAL_ANALYSIS = T.StructType(
    ANALYSIS.fields
    + [
        T.StructField("verification", VERIFICATION),
        T.StructField("internal_qc", INTERNAL_QC),
        T.StructField("decision", STRING),
        T.StructField("decisionTimestamp", STRING),
    ]
)

ANALYSIS_FIELDS = tuple(ANALYSIS.fieldNames())
