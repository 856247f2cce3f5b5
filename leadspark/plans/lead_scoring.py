"""From checked analyses to decided leads."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark import config
from leadspark.operators.decide import with_decision
from leadspark.operators.quality import with_internal_qc
from leadspark.operators.verify import (
    with_corroboration,
    with_reputation,
    with_verification,
)


def score_leads(
    leads: DataFrame,
    as_of: str | None = None,
    sources: Column | None = None,
    corpus: DataFrame | None = None,
    proof: DataFrame | None = None,
    trusted: Sequence[str] = config.TRUSTED_HOSTS,
    blocked: Sequence[str] = config.BLOCKED_HOSTS,
    tone: Column | None = None,
    mine: DataFrame | None = None,
) -> DataFrame:
    """Verify, control and decide.

    The number of corroborating sources is looked up, unless a column gives it.
    """
    if sources is None:
        backed = with_corroboration(leads, trusted, corpus, proof, mine=mine)
    else:
        backed = leads.withColumns(
            {
                "corroboratingSources": sources.cast("int"),
                "corroboratingUrls": F.array().cast("array<string>"),
            }
        )
    verified = with_verification(
        with_reputation(backed, trusted=trusted, blocked=blocked), as_of
    )
    return with_decision(with_internal_qc(verified, as_of, tone), as_of)
