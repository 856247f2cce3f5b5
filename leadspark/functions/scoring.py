"""Scores and decisions on leads."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadspark import config


def source_reputation(
    host: Column,
    trusted: Sequence[str] = config.TRUSTED_HOSTS,
    blocked: Sequence[str] = config.BLOCKED_HOSTS,
) -> Column:
    """Score of a host by short lists; the trusted list is asked first."""
    return (
        F.when(host.isin(*trusted), config.TRUSTED_SCORE)
        .when(host.isin(*blocked), config.BLOCKED_SCORE)
        .otherwise(config.DEFAULT_SCORE)
    )


def investment(summary: Column) -> Column:
    """First investment figure of a summary, NULL without one."""
    return F.regexp_substr(summary, F.lit(config.INVESTMENT_PATTERN))


def confidence_score(reputation: Column, sources: Column) -> Column:
    """Halves round up, and the score is not held to 100."""
    return F.round(reputation * 0.5 + sources * 10 * 0.5).cast("int")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, in which characters beyond the first plane count twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


@dataclass(frozen=True)
class Rule:
    """A business rule: the condition under which it fails, and the text for that."""

    name: str
    text: str
    fails: Callable[[], Column]


def _construction_need_missing() -> Column:
    named = F.exists(
        "potentialNeed", lambda need: need.eqNullSafe(config.CONSTRUCTION_NEED)
    )
    return (F.col("opportunityType") == config.CONSTRUCTION_TYPE) & ~named


def _technology_score_low() -> Column:
    low = F.col("opportunityScore") <= config.TECHNOLOGY_SCORE_ABOVE
    return (F.col("industry") == config.TECHNOLOGY_INDUSTRY) & low


def _summary_short() -> Column:
    return utf16_length(F.col("summary")) < config.SUMMARY_LENGTH


RULES = (
    Rule("construction_need", config.RULE_CONSTRUCTION, _construction_need_missing),
    Rule("technology_score", config.RULE_TECHNOLOGY, _technology_score_low),
    Rule("summary_length", config.RULE_SUMMARY, _summary_short),
)


def failed_rules(rules: Sequence[Rule] = RULES) -> Column:
    """Texts of the failed rules in rule order."""
    return F.array_compact(
        F.array(*[F.when(rule.fails(), F.lit(rule.text)) for rule in rules])
    )


def logical_consistency() -> Column:
    contradiction = F.contains(F.lower("summary"), F.lit(config.EXPANSION_WORD)) & (
        F.col("opportunityType") == config.DOWNSIZING_TYPE
    )
    return F.when(contradiction, "Failed").otherwise("Passed")


def word_share_tone(
    text: Column,
    words: Sequence[str] = config.SENSATIONAL_WORDS,
    limit: float = config.TONE_LIMIT,
) -> Column:
    """'Failed' when the share of sensational words in a text is above the limit."""
    listed = F.array(*[F.lit(word) for word in words])
    spoken = F.filter(F.split(F.lower(text), r"\W+"), lambda word: word != "")
    loud = F.size(F.filter(spoken, lambda word: F.array_contains(listed, word)))
    return F.when(loud > F.size(spoken) * F.lit(limit), "Failed").otherwise("Passed")


def quality_score(failed: Column, consistency: Column, tone: Column) -> Column:
    penalty = (
        F.size(failed) * config.RULE_PENALTY
        + F.when(consistency == "Failed", config.CONSISTENCY_PENALTY).otherwise(0)
        + F.when(tone == "Failed", config.TONE_PENALTY).otherwise(0)
    )
    return F.greatest(F.lit(0), F.lit(100) - penalty)


def raw_score(record: Column, path: str) -> Column:
    """A score of an unchecked object as a comparison sees it.

    A null or an empty text counts as 0. What is missing or no number is NULL.
    """
    value = F.try_variant_get(record, path, "variant")
    blank = F.trim(F.try_variant_get(record, path, "string")) == ""
    return F.when(F.is_variant_null(value) | blank, F.lit(0.0)).otherwise(
        F.try_variant_get(record, path, "double")
    )


def decision(confidence: Column, quality: Column) -> Column:
    """A missing score fails every comparison, and so asks for a review."""
    return (
        F.when(
            (confidence > config.APPROVE_ABOVE) & (quality > config.APPROVE_ABOVE),
            "Approved",
        )
        .when(
            (confidence < config.REJECT_BELOW) | (quality < config.REJECT_BELOW),
            "Rejected",
        )
        .otherwise("Manual Review")
    )
