"""External checks: reputation of the source, and corroboration by other articles."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadspark import config
from leadspark.functions.clock import as_of_text
from leadspark.functions.scoring import confidence_score, investment, source_reputation
from leadspark.functions.text import url_host
from leadspark.operators.joins import split_left_join
from leadspark.session import broadcast_if_small

# Stands for "any investment": no figure looks like this.
ANY = "*"
EVIDENCE = (
    StructType()
    .add("evidenceId", "string")
    .add("sourceURL", "string")
    .add("companyName", "string")
    .add("region", "string")
    .add("investmentFact", "string")
)


def with_reputation(
    leads: DataFrame,
    reputation: DataFrame | None = None,
    trusted: Sequence[str] = config.TRUSTED_HOSTS,
    blocked: Sequence[str] = config.BLOCKED_HOSTS,
) -> DataFrame:
    """Add `sourceReputationScore`, by the short lists or by a table (host, score)."""
    host = url_host(F.col("sourceURL"))
    if reputation is None:
        score = source_reputation(host, trusted, blocked)
        return leads.withColumn("sourceReputationScore", score)
    scores = reputation.groupBy("host").agg(F.max("score").alias("score"))
    known = broadcast_if_small(scores.where("host is not null"))
    joined = split_left_join(leads.withColumn("host", host), known, ["host"])
    score = F.coalesce("score", F.lit(config.DEFAULT_SCORE)).cast("int")
    return joined.withColumn("sourceReputationScore", score).drop("host", "score")


def with_facts(leads: DataFrame) -> DataFrame:
    """Add the facts to verify: company, first investment figure and region."""
    return leads.withColumn(
        "facts",
        F.struct("companyName", investment(F.col("summary")).alias("investment"), "region"),
    )


def _trusted(url: Column, trusted: Sequence[str]) -> Column:
    return F.coalesce(url_host(url).isin(*trusted), F.lit(False))


def evidence_id(company: Column, region: Column, fact: Column) -> Column:
    """Name of a set of facts; NULL without a company or region."""
    parts = [F.concat(F.length(x).cast("string"), F.lit(":"), x) for x in (company, region)]
    return F.left(F.sha2(F.concat(*parts, fact), 256), F.lit(32))


def evidence_rows(
    articles: DataFrame, trusted: Sequence[str] = config.TRUSTED_HOSTS
) -> DataFrame:
    """Who reports what, as often as an article of a trusted host comes.

    An article with an investment figure also supports leads that name none.
    """
    facts = F.array_compact(F.array(F.lit(ANY), investment(F.col("summary"))))
    rows = (
        articles.where(_trusted(F.col("sourceURL"), trusted))
        .where("companyName is not null and region is not null")
        .select(
            "companyName", "region", F.explode(facts).alias("investmentFact"), "sourceURL"
        )
    )
    name = evidence_id(F.col("companyName"), F.col("region"), F.col("investmentFact"))
    return rows.select(name.alias("evidenceId"), "sourceURL", "companyName", "region", "investmentFact")


def evidence(
    articles: DataFrame, trusted: Sequence[str] = config.TRUSTED_HOSTS
) -> DataFrame:
    """Who reports what: each URL of a trusted host once per set of facts.

    This table is the whole list of corroborating URLs for every lead, and no longer than
    two rows for each trusted article.
    """
    named = evidence_rows(articles, trusted)
    # Equal names have equal facts; those that nobody asks for are not shuffled.
    facts = [F.any_value(c).alias(c) for c in ("companyName", "region", "investmentFact")]
    return named.groupBy("evidenceId", "sourceURL").agg(*facts)


def evidence_totals(proof: DataFrame) -> DataFrame:
    """Number of URLs per set of facts. A hot set of facts is one number for each task
    before the shuffle, and totals of parts of the evidence add up."""
    return proof.groupBy("evidenceId").agg(F.count(F.lit(1)).alias("n_urls"))


def evidence_lists(proof: DataFrame) -> DataFrame:
    """The same numbers beside all URLs of a set of facts, in order. For who wants each lead
    to carry its whole list: a set of facts is one list of any length."""
    urls = F.array_sort(F.collect_list("sourceURL")).alias("urls")
    return proof.groupBy("evidenceId").agg(F.count(F.lit(1)).alias("n_urls"), urls)


def with_evidence_id(leads: DataFrame) -> DataFrame:
    """Add `evidenceId`, the name of the evidence that supports a lead."""
    fact = F.coalesce(investment(F.col("summary")), F.lit(ANY))
    return leads.withColumn("evidenceId", evidence_id(F.col("companyName"), F.col("region"), fact))


def whole_evidence(
    articles: DataFrame, trusted: Sequence[str] = config.TRUSTED_HOSTS
) -> DataFrame:
    """The same for who stores all columns: they are told apart by hash, without a sort."""
    return evidence_rows(articles, trusted).distinct()


def own_keys(leads: DataFrame, trusted: Sequence[str] = config.TRUSTED_HOSTS) -> DataFrame:
    """(evidenceId, sourceURL) under which leads of other hosts may be among evidence that was
    gathered when their hosts were trusted."""
    others = with_evidence_id(leads.where(~_trusted(F.col("sourceURL"), trusted)))
    return others.where("evidenceId is not null").select("evidenceId", "sourceURL").distinct()


def with_corroboration(
    leads: DataFrame,
    trusted: Sequence[str] = config.TRUSTED_HOSTS,
    corpus: DataFrame | None = None,
    proof: DataFrame | None = None,
    urls: bool = False,
    mine: DataFrame | None = None,
) -> DataFrame:
    """Add `corroboratingSources`, the number of other articles of trusted hosts that report
    the same facts, and `evidenceId`, under which the evidence lists them. With `urls` also
    `corroboratingUrls`, the whole list in order.

    Leads meet totals per set of facts and never each other, so popular facts cost no more
    than others. The evidence is that of the leads themselves, of the articles `corpus`, or
    the table `proof`. Who knows which of the leads are in that table gives their
    (evidenceId, sourceURL) as `mine`, each once; else all of it is read for them.
    """
    url = F.col("sourceURL")
    asked = with_evidence_id(leads)
    if proof is None:
        proof = evidence(leads if corpus is None else corpus, trusted)
        among = corpus is None
    else:
        among = False
    if among:
        # A lead without facts is not among the evidence, and so not to be taken off.
        listed = F.col("evidenceId").isNotNull()
        asked = asked.withColumn("own", (_trusted(url, trusted) & listed).cast("int"))
    else:
        mine = proof if mine is None else mine
        mine = mine.select("evidenceId", "sourceURL", F.lit(1).alias("own"))
        asked = split_left_join(asked, mine, ["evidenceId", "sourceURL"])
    totals = evidence_lists(proof) if urls else evidence_totals(proof)
    joined = split_left_join(asked, totals, ["evidenceId"])
    others = F.coalesce("n_urls", F.lit(0)) - F.coalesce("own", F.lit(0))
    names = ["corroboratingSources", "evidenceId"]
    if urls:
        rest = F.when(url.isNull(), F.col("urls")).otherwise(F.array_remove("urls", url))
        joined = joined.withColumn("corroboratingUrls", F.coalesce(rest, F.array().cast("array<string>")))
        names.insert(1, "corroboratingUrls")
    return joined.withColumn("corroboratingSources", others.cast("int")).select(
        *[name for name in leads.columns if name not in names[1:]], *names
    )


def corroborating_urls(leads: DataFrame, proof: DataFrame, key: str = "lead_id") -> DataFrame:
    """(key, sourceURL): every corroborating URL of the leads, one row each.

    `leads` have `evidenceId` and their own `sourceURL`. For all leads this is as long as
    their counts together; ask for those that somebody looks at.
    """
    asked = leads.select(key, "evidenceId", F.col("sourceURL").alias("own"))
    listed = proof.select("evidenceId", "sourceURL")
    found = asked.join(listed, "evidenceId")
    other = F.col("own").isNull() | (F.col("sourceURL") != F.col("own"))
    return found.where(other).select(key, "sourceURL")


def with_verification(leads: DataFrame, as_of: str | None = None) -> DataFrame:
    """Fold reputation and corroboration into the struct `verification`.

    The URLs themselves and the name of the evidence are NULL where no column has them.
    """
    kinds = {"corroboratingUrls": "array<string>", "evidenceId": "string"}
    held = [n for n in kinds if n in leads.columns]
    given = [F.col(n) if n in held else F.lit(None).cast(t).alias(n) for n, t in kinds.items()]
    parts = F.struct(
        confidence_score(
            F.col("sourceReputationScore"), F.col("corroboratingSources")
        ).alias("confidenceScore"),
        "sourceReputationScore",
        "corroboratingSources",
        *given,
        as_of_text(as_of).alias("lastCheckedTimestamp"),
    )
    return leads.withColumn("verification", parts).drop(
        "sourceReputationScore", "corroboratingSources", *held
    )
