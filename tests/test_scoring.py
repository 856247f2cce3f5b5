"""Checks, scores and decisions."""

import itertools
import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from leadspark import config, schemas
from leadspark.functions import envelope, scoring
from leadspark.operators import decide, quality, verify
from leadspark.plans.lead_scoring import score_leads
from leadspark.queries import QUERIES
from tests.samples import LEAD, lead


def leads(spark, *records):
    return spark.createDataFrame([tuple(r[n] for n in LEAD) for r in records], schemas.ANALYSIS)


@pytest.mark.parametrize(
    ("host", "score"),
    [
        ("reuters.com", 100),
        ("bloomberg.com", 100),
        ("my-sensational-blog.net", 0),
        ("www.bloomberg.com", 85),
        ("example.com", 85),
        (None, 85),
    ],
)
def test_reputation(one, host, score):
    assert one(scoring.source_reputation(F.col("x")), row=(host,)) == score


def test_reputation_table(spark):
    table = spark.createDataFrame([("example.com", 40)], "host string, score int")
    frame = leads(spark, LEAD, lead(sourceURL="https://other.org/"))
    rows = verify.with_reputation(frame, table).select("sourceReputationScore").collect()
    assert sorted(row[0] for row in rows) == [40, 85]


@pytest.mark.parametrize(
    ("reputation", "sources", "score"),
    [(85, 3, 58), (100, 3, 65), (0, 3, 15), (100, 12, 110), (85, 0, 43)],
)
def test_confidence_rounds_half_up(one, reputation, sources, score):
    column = scoring.confidence_score(F.col("a"), F.col("b"))
    assert one(column, "a int, b int", (reputation, sources)) == score


@pytest.mark.parametrize(
    ("summary", "figure"),
    [("puts $20M and $30M", "$20M"), ("about $20 M", None), ("", None)],
)
def test_investment(one, summary, figure):
    assert one(scoring.investment(F.col("x")), row=(summary,)) == figure


def quality_of(spark, record, **options):
    return quality.with_internal_qc(leads(spark, record), **options).first().internal_qc


def test_clean_lead(spark):
    result = quality_of(spark, LEAD, as_of="2024-01-01T00:00:00.000Z")
    assert result.asDict() == {
        "qualityScore": 100,
        "rulesPassed": 20,
        "rulesFailed": 0,
        "failedRules": [],
        "logicalConsistency": "Passed",
        "toneAnalysis": "Passed",
        "lastCheckedTimestamp": "2024-01-01T00:00:00.000Z",
    }


def test_two_failed_rules(spark):
    record = lead(industry="Technology", opportunityScore=6, summary="Short summary")
    result = quality_of(spark, record)
    assert (result.qualityScore, result.rulesPassed, result.rulesFailed) == (80, 18, 2)
    assert result.failedRules == [config.RULE_TECHNOLOGY, config.RULE_SUMMARY]


def test_construction_need(spark):
    missing = quality_of(spark, lead(potentialNeed=["Cranes", None]))
    assert missing.failedRules == [config.RULE_CONSTRUCTION]
    beside_null = lead(potentialNeed=[None, "Construction Services"])
    assert quality_of(spark, beside_null).failedRules == []


def test_rules_can_be_added(spark):
    quote = scoring.Rule("quote", "A quote is missing.", lambda: F.col("keyQuote") == "")
    result = quality_of(spark, lead(keyQuote=""), rules=(*scoring.RULES, quote), total_rules=4)
    assert (result.failedRules, result.rulesPassed) == (["A quote is missing."], 3)


def test_length_counts_utf16_units(spark):
    assert quality_of(spark, lead(summary="🚀" * 25)).failedRules == []
    assert quality_of(spark, lead(summary="é" * 49)).failedRules == [config.RULE_SUMMARY]


def test_inconsistent_and_loud(spark):
    record = lead(opportunityType="Downsizing", summary="EXPANSION " + "x" * 50)
    assert quality_of(spark, record).qualityScore == 80
    assert quality_of(spark, record, tone=F.lit("Failed")).qualityScore == 70


def test_quality_is_not_negative(one):
    failed = F.array_repeat(F.lit("rule"), 12)
    assert one(scoring.quality_score(failed, F.lit("Failed"), F.lit("Failed"))) == 0


@pytest.mark.parametrize(
    ("words", "tone"), [("a shocking scandal", "Failed"), ("a calm report", "Passed"), ("", "Passed")]
)
def test_word_share_tone(one, words, tone):
    assert one(scoring.word_share_tone(F.col("x")), row=(words,)) == tone


MISSING = object()
GRID = (MISSING, None, 0, 69, 70, 71, 90, 91, 100)


def expected_decision(confidence, quality_score):
    number = lambda v: None if v is MISSING else (v or 0)
    c, q = number(confidence), number(quality_score)
    if c is not None and q is not None and c > 90 and q > 90:
        return "Approved"
    if (c is not None and c < 70) or (q is not None and q < 70):
        return "Rejected"
    return "Manual Review"


def test_decision_grid(spark):
    def body(name, value):
        return {} if value is MISSING else {name: value}

    rows, expected = [], {}
    for index, (c, q) in enumerate(itertools.product(GRID, GRID)):
        record = {
            "verification": body("confidenceScore", c),
            "internal_qc": body("qualityScore", q),
        }
        rows.append((index, json.dumps(record)))
        expected[index] = expected_decision(c, q)
    frame = spark.createDataFrame(rows, "id int, body string").withColumn(
        "record", envelope.strict_json(F.col("body"))
    )
    got = frame.select("id", decide.raw_decision(F.col("record")).alias("d")).collect()
    assert {row.id: row.d for row in got} == expected


def test_scores_as_text(one):
    record = '{"verification":{"confidenceScore":"95"},"internal_qc":{"qualityScore":"x"}}'
    column = decide.raw_decision(envelope.strict_json(F.col("x")))
    assert one(column, row=(record,)) == "Manual Review"


def test_messages_of_outcomes(spark):
    rows = [("A", "Manual Review", None), ("B", "Approved", None), ("C", None, "x:required")]
    frame = spark.createDataFrame(rows, "company string, decision string, error string")
    got = frame.select(*decide.outcome(F.col("company"), F.col("decision"), F.col("error")))
    assert [tuple(row) for row in got.collect()] == [
        (200, "Analysis for A requires manual review."),
        (200, "Published final analysis for B with decision: Approved"),
        (400, "Invalid enriched analysis format: x:required"),
    ]


def brute_force(records, corpus, trusted):
    """Corroborating URLs of each lead by comparing it with every article."""
    from urllib.parse import urlsplit
    import re

    def figure(record):
        found = re.search(config.INVESTMENT_PATTERN, record["summary"])
        return found and found[0]

    result = defaultdict(set)
    for mine in records:
        for other in corpus:
            if (
                other["sourceURL"] != mine["sourceURL"]
                and urlsplit(other["sourceURL"]).hostname in trusted
                and other["companyName"] == mine["companyName"]
                and other["region"] == mine["region"]
                and figure(mine) in (None, figure(other))
            ):
                result[mine["keyQuote"]].add(other["sourceURL"])
    return result


def sample_leads(n):
    hosts = ("reuters.com", "bloomberg.com", "example.com")
    return [
        lead(
            # A third of all leads are about one company.
            companyName="Hot" if i % 3 == 0 else f"Company {i % 11}",
            keyQuote=f"quote {i}",
            region="Baltic" if i % 5 else "Nordic",
            summary=("puts $20M", "puts $30M", "says nothing")[i % 3 if i % 3 else i % 4 % 3],
            # Some articles come as copies under one URL.
            sourceURL=f"https://{hosts[i % 3 if i % 2 else 0]}/story/{i // 2 if i % 7 == 0 else i}",
        )
        for i in range(n)
    ]


def urls_by_quote(records, frame, proof):
    asked = verify.corroborating_urls(verify.with_evidence_id(frame), proof, "keyQuote")
    found = defaultdict(set)
    for row in asked.collect():
        assert row.sourceURL not in found[row.keyQuote]
        found[row.keyQuote].add(row.sourceURL)
    return found


def test_corroboration_equals_brute_force(spark):
    records = sample_leads(300)
    frame = leads(spark, *records)
    rows = verify.with_corroboration(frame).collect()
    expected = brute_force(records, records, config.TRUSTED_HOSTS)
    listed = urls_by_quote(records, frame, verify.evidence(frame))
    assert len(rows) == len(records)
    assert max(row.corroboratingSources for row in rows) > 50
    for row in rows:
        assert row.corroboratingSources == len(expected[row.keyQuote])
        assert listed[row.keyQuote] == expected[row.keyQuote]


def test_over_a_thousand_sources_are_all_found(spark):
    records = [lead(keyQuote=f"q{i}", sourceURL=f"https://reuters.com/{i}") for i in range(1500)]
    records.append(lead(keyQuote="no figure", summary="says nothing", sourceURL="https://a.org/1"))
    frame = leads(spark, *records)
    rows = {row.keyQuote: row.corroboratingSources for row in verify.with_corroboration(frame).collect()}
    assert rows["q7"] == 1499
    assert rows["no figure"] == 1500
    asked = frame.where("keyQuote in ('q7', 'no figure')")
    listed = urls_by_quote(records, asked, verify.evidence(frame))
    assert listed["q7"] == {f"https://reuters.com/{i}" for i in range(1500) if i != 7}
    assert len(listed["no figure"]) == 1500


def test_leads_carry_every_url(spark):
    records = [lead(keyQuote=f"q{i}", sourceURL=f"https://reuters.com/{i:04}") for i in range(1200)]
    records += [lead(keyQuote="no figure", summary="says nothing", sourceURL=None), lead(keyQuote="none", region=None)]
    rows = {row.keyQuote: row for row in verify.with_corroboration(leads(spark, *records), urls=True).collect()}
    every = [f"https://reuters.com/{i:04}" for i in range(1200)]
    assert rows["q7"].corroboratingUrls == every[:7] + every[8:]
    assert rows["no figure"].corroboratingUrls == every
    assert rows["none"].corroboratingUrls == []
    assert all(row.corroboratingSources == len(row.corroboratingUrls) for row in rows.values())
    records, corpus = sample_leads(60), sample_leads(200)[30:]
    frame = verify.with_corroboration(leads(spark, *records), corpus=leads(spark, *corpus), urls=True)
    expected = brute_force(records, corpus, config.TRUSTED_HOSTS)
    for row in frame.collect():
        assert row.corroboratingUrls == sorted(expected[row.keyQuote])


@pytest.mark.parametrize("name", ["corroboration", "verification_enrich"])
def test_queries_list_the_urls_they_count(spark, name):
    rows = QUERIES[name](spark, "/root/testdata/sf0.001").select("n_sources", "urls").collect()
    assert max(row.n_sources for row in rows) > 0
    assert all(row.n_sources == len([x for x in row.urls.split("|") if x]) for row in rows)


def test_evidence_adds_up(spark):
    """Totals of parts of the evidence without a URL in common add up to those of all."""
    records = sample_leads(200)
    proof = verify.evidence(leads(spark, *records)).withColumn("part", F.hash("sourceURL") % 3)
    parts = [verify.evidence_totals(proof.where(F.col("part") == n)) for n in (-2, -1, 0, 1, 2)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    added = every.groupBy("evidenceId").agg(F.sum("n_urls").alias("n_urls"))
    assert sorted(added.collect()) == sorted(verify.evidence_totals(proof).collect())


def test_names_of_facts_are_apart(spark):
    """Parts of names that meet elsewhere make another name."""
    frame = leads(spark, lead(companyName="ab", region="c"), lead(companyName="a", region="bc"))
    rows = verify.with_evidence_id(frame).collect()
    assert rows[0].evidenceId != rows[1].evidenceId


def test_evidence_holds_every_url(spark):
    records = sample_leads(120)
    proof = defaultdict(set)
    for row in verify.evidence(leads(spark, *records)).collect():
        proof[row.companyName, row.region, row.investmentFact].add(row.sourceURL)
    expected = brute_force(records, records, config.TRUSTED_HOSTS)
    for row in verify.with_facts(leads(spark, *records)).collect():
        listed = proof[row.companyName, row.region, row.facts.investment or verify.ANY]
        assert listed - {row.sourceURL} == expected[row.keyQuote]


def test_corroboration_by_another_corpus(spark):
    records, corpus = sample_leads(60), sample_leads(200)[30:]
    frame = verify.with_corroboration(leads(spark, *records), corpus=leads(spark, *corpus))
    expected = brute_force(records, corpus, config.TRUSTED_HOSTS)
    for row in frame.collect():
        assert row.corroboratingSources == len(expected[row.keyQuote])


def test_leads_without_facts_or_url(spark):
    trusted = "https://reuters.com/1"
    frame = leads(
        spark,
        lead(sourceURL=trusted),
        lead(sourceURL=trusted, companyName=None),
        lead(sourceURL=trusted, region=None),
        lead(sourceURL=None),
    )
    rows = verify.with_corroboration(frame).collect()
    found = {(x.companyName is None, x.region is None, x.sourceURL): x for x in rows}
    for row in rows:
        alone = row.sourceURL is not None
        assert row.corroboratingSources == (0 if alone else 1)
        known = row.companyName is not None and row.region is not None
        assert (row.evidenceId is not None) == known
    assert len(found) == 4


def test_hot_facts_are_counted_before_the_shuffle(spark):
    """Neither lists nor windows: one count for each task and set of facts."""
    plan = verify.evidence_totals(verify.evidence(leads(spark, LEAD)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "collect" not in text.lower() and "Window" not in text
    assert "partial_count" in text
    # The facts themselves are not shuffled for the totals.
    assert "any_value" not in text


def test_hot_facts_are_split(spark):
    """A third of the leads share their facts; their partition is read in several parts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 40000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, "Hot")
            .otherwise(F.concat(F.lit("Company "), F.col("id")))
            .alias("companyName"),
            F.lit("Baltic").alias("region"),
            F.lit("puts $20M").alias("summary"),
            F.concat(F.lit("https://reuters.com/"), F.col("id")).alias("sourceURL"),
        )
        frame = verify.with_corroboration(rows)
        assert frame.agg(F.sum("corroboratingSources")).first()[0] == 13334 * 13333
        done = frame.groupBy().agg(F.sum("corroboratingSources"), F.max("sourceURL"))
        done.collect()
        assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_three_given_sources_reject_every_host(spark):
    frame = leads(
        spark, LEAD, lead(sourceURL="https://reuters.com/1"), lead(sourceURL="https://a.org/1")
    )
    rows = score_leads(frame, sources=F.lit(3)).collect()
    assert {row.decision for row in rows} == {"Rejected"}
    assert {row.verification.confidenceScore for row in rows} == {58, 65}


def test_twelve_given_sources_approve(spark):
    row = score_leads(leads(spark, lead(sourceURL="https://reuters.com/1")), sources=F.lit(12)).first()
    assert row.decision == "Approved"
    assert set(schemas.FINAL_ANALYSIS.fieldNames()) == set(row.asDict())


def test_routes(spark):
    rows = [("a", "Approved"), ("b", "Rejected"), ("c", "Manual Review")]
    frame = spark.createDataFrame(rows, "companyName string, decision string")
    places = {name: [r[0] for r in df.collect()] for name, df in decide.route(frame).items()}
    assert places == {"review": ["c"], "final-analysis": ["a", "b"], "final-leads": ["a"]}
    listed = frame.select("companyName", F.explode(decide.destinations(F.col("decision"))))
    assert sorted(tuple(row) for row in listed.collect()) == sorted(
        (name, place) for place, names in places.items() for name in names
    )
