"""The registered queries: each operator on the given tables, (spark, sf_dir) -> DataFrame.

Lists are shown joined and times as ISO text, so that results compare as plain values.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark import config, fixtures
from leadspark.fixtures import AS_OF, table
from leadspark.functions import checks, envelope, scoring, text, url
from leadspark.functions.clock import utc_iso
from leadspark.operators import (
    decide,
    deliver,
    extract,
    ingest,
    keywords,
    quality,
    review,
    validate,
    verify,
)
from leadspark.operators.once import with_once
from leadspark.plans import articles
from leadspark.plans.lead_scoring import score_leads
from leadspark.schemas import ANALYSIS, ARTICLE_REF, FINAL_ANALYSIS, SOURCE
from leadspark.session import broadcast_if_small, configure, shared_dir, spread, state_partitions
from leadspark.sources import catalog, tables
from leadspark.streaming import alerts as alert_stream
from leadspark.streaming import dedup, merge
from leadspark.streaming import scoring as scoring_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def joined(values: str | Column, separator: str = "|") -> Column:
    return F.array_join(values, separator, "")


def long(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


# Sources, sinks and stage tables


@query
def source_catalog(spark, sf_dir):
    messages = validate.decode(fixtures.source_messages(spark, sf_dir))
    landed = messages.select(
        F.try_variant_get("record", "$", SOURCE.simpleString()).alias("source")
    )
    counts = landed.groupBy("source.source_url").agg(F.count(F.lit(1)).alias("n_pages"))
    sources = catalog.source_catalog(spark)
    return counts.join(broadcast_if_small(sources), "source_url").select(
        "source_url", "source_type", "n_pages"
    )


@query
def cycle_fanout(spark, sf_dir):
    times = fixtures.event_times(table(spark, sf_dir, "events"))
    return ingest.fan_out(ingest.cycle_starts(times)).select(
        utc_iso(F.col("cycle_start")).alias("cycle_start"), "source_url", "source_type"
    )


@query
def envelope_decode(spark, sf_dir):
    messages = validate.decode(fixtures.raw_messages(spark, sf_dir))
    field = lambda name: F.try_variant_get("record", f"$.{name}", "string")
    return messages.select(
        "msg_id",
        "rejected",
        field("companyName").alias("company"),
        field("summary").alias("summary"),
        field("opportunityScore").alias("score"),
        field("note").alias("note"),
    )


@query
def envelope_roundtrip(spark, sf_dir):
    lead = fixtures.leads(spark, sf_dir)
    sent = lead.select(
        "lead_id", envelope.wrapped_event(F.struct(*ANALYSIS.fieldNames())).alias("event")
    )
    received = sent.withColumn("data", envelope.event_data(F.col("event")))
    record = F.from_json(envelope.decoded_text(F.col("data")), ANALYSIS)
    return received.select("lead_id", record.alias("record")).select(
        "lead_id",
        "record.companyName",
        "record.summary",
        joined("record.potentialNeed").alias("needs"),
        long("record.opportunityScore").alias("score"),
        "record.sourceURL",
    )


@query
def keyword_catalog(spark, sf_dir):
    return ingest.keyword_counts(table(spark, sf_dir, "documents"))


def _catalog_of_file(spark, sf_dir):
    """A catalog as it is kept in a file: the words of the benchmark."""
    path = f"{shared_dir(spark, 'catalog')}/keywords"
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)).alias("keywords")
    table(spark, sf_dir, "benchmark").select(words).write.json(path)
    return catalog.keyword_catalog(spark, path, lines=True)


@query
def keyword_catalog_file(spark, sf_dir):
    listed = _catalog_of_file(spark, sf_dir)
    return keywords.counts(spread(table(spark, sf_dir, "documents")), listed, "text")


@query
def keyword_relevance_file(spark, sf_dir):
    listed = _catalog_of_file(spark, sf_dir).where(F.length("keyword") > 9)
    found = keywords.relevant(spread(table(spark, sf_dir, "documents")), listed, "text")
    return found.select("doc_id")


@query
def stage_table_stream(spark, sf_dir):
    root = shared_dir(spark, "stages")
    path = f"{sf_dir}/pages.parquet"
    pages = tables.file_stream(spark, path, spark.read.parquet(path).schema)
    refs = pages.select(
        F.col("url").alias("article_url"),
        text.url_host(F.col("url")).alias("source_domain"),
    ).where("source_domain is not null")
    stage = tables.stage_path(root, "article-to-filter")
    tables.append_stream(refs, stage, f"{root}/write").awaitTermination()
    staged = tables.file_stream(spark, stage, ARTICLE_REF)
    read = f"{root}/read-back"
    tables.append_stream(staged, read, f"{root}/read").awaitTermination()
    return spark.read.schema(ARTICLE_REF).parquet(read)


@query
def warehouse_rows(spark, sf_dir):
    final = decide.route(fixtures.scored(spark, sf_dir))["final-analysis"]
    path = f"{shared_dir(spark, 'warehouse')}/final_analysis"
    tables.append_warehouse(final.select("lead_id", *FINAL_ANALYSIS.fieldNames()), path)
    field = lambda name: F.get_json_object("data", f"$.{name}")
    return spark.read.parquet(path).select(
        field("lead_id").cast("bigint").alias("lead_id"),
        field("decision").alias("decision"),
        field("verification.confidenceScore").cast("bigint").alias("confidence"),
        field("internal_qc.qualityScore").cast("bigint").alias("quality"),
        F.col("decision_date").cast("string").alias("decision_date"),
    )


@query
def warehouse_typed(spark, sf_dir):
    final = fixtures.scored(spark, sf_dir).select(*FINAL_ANALYSIS.fieldNames())
    typed = tables.typed_warehouse(tables.warehouse_rows(final), FINAL_ANALYSIS)
    return typed.select(
        "sourceURL",
        "companyName",
        joined("potentialNeed").alias("needs"),
        long("opportunityScore").alias("score"),
        long("verification.sourceReputationScore").alias("reputation"),
        long("internal_qc.rulesPassed").alias("rules_passed"),
        joined("internal_qc.failedRules").alias("failed_rules"),
        "decision",
        "decisionTimestamp",
    )


@query
def review_queue(spark, sf_dir):
    return fixtures.queue(spark, sf_dir).select(
        "id",
        "companyName",
        "decision",
        long("verification.confidenceScore").alias("confidence"),
        long("internal_qc.qualityScore").alias("quality"),
    )


@query
def review_queue_pending(spark, sf_dir):
    # Every fifth document carries an id of its own.
    own = F.when(F.col("lead_id") % 5 == 0, F.concat(F.lit("doc-"), F.col("lead_id")))
    stored = fixtures.queue(spark, sf_dir).withColumn("document_id", own)
    waiting = review.pending(stored, fixtures.corrections(spark, sf_dir))
    return review.with_own_id(waiting, "id", "document_id").select(
        "id", "lead_id", "companyName", "sourceURL"
    )


@query
def corrections_log(spark, sf_dir):
    path = f"{shared_dir(spark, 'corrections')}/corrections"
    fixtures.corrections(spark, sf_dir).write.mode("append").parquet(path)
    return spark.read.parquet(path).select(
        "id",
        long("attempt").alias("attempt"),
        "status",
        F.coalesce("corrected", F.lit(False)).alias("corrected"),
        "region",
        utc_iso(F.col("submitted_at")).alias("submitted_at"),
    )


@query
def alert_outbox(spark, sf_dir):
    ready = deliver.alerts(decide.route(fixtures.scored(spark, sf_dir))["final-leads"])
    rows = ready.select("lead_id", "payload")
    path = f"{shared_dir(spark, 'alerts')}/outbox"
    outbox = scoring_stream.outbox_table(spark, path, "lead_id", "long")
    # The first delivery has the leads of one region; the second one all, and it is run again.
    outbox.add(ready.where("region = 'ASIA'").select(rows.columns), 0)
    for _ in range(2):
        outbox.add(rows, 1)
    return outbox.rows().select(
        "lead_id", F.get_json_object("payload", "$.text").alias("line")
    )


def _checked_messages(spark, sf_dir):
    decoded = validate.decode(fixtures.raw_messages(spark, sf_dir))
    return validate.check(decoded, checks.ANALYSIS)


@query
def quarantine_counts(spark, sf_dir):
    analyses = validate.quarantined(_checked_messages(spark, sf_dir), "external-verification")
    bodies = validate.parse(fixtures.raw_articles(spark, sf_dir), "body")
    refused = validate.quarantined(
        validate.check(bodies, checks.ARTICLE), "article-to-analyze", "body"
    )
    return validate.quarantine_counts(analyses.unionByName(refused))


def _arriving(spark, sf_dir, name, order, root, batches=5):
    """A given table as a stream of files, read in about so many micro-batches. A second
    stream below the same folder reads the same files."""
    rows = table(spark, sf_dir, name)
    path = f"{root}/{name}"
    files = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.repartitionByRange(files, order).write.mode("ignore").parquet(path)
    written = len(spark.read.parquet(path).inputFiles())
    each = str(max(1, -(-written // batches)))
    return tables.file_stream(spark, path, rows.schema, maxFilesPerTrigger=each)


# Ingestion and text


@query
def article_discovery(spark, sf_dir):
    found = ingest.page_links(table(spark, sf_dir, "pages"))
    return ingest.article_refs(found)


@query
def url_resolution(spark, sf_dir):
    """A reference of each kind on every page, resolved against the address of the page."""
    key = F.col("page_id").cast("string")
    references = {
        "sibling": F.concat(F.lit("s"), key),
        "here": F.concat(F.lit("./h"), key),
        "parent": F.concat(F.lit("../p"), key),
        "above the root": F.concat(F.lit("../../../../r"), key),
        "dots within": F.concat(F.lit("/a/./b/../c"), key),
        "rooted": F.concat(F.lit("/t"), key, F.lit("#part")),
        "query": F.concat(F.lit("?n="), key, F.lit("&amp;m=1")),
        "host": F.concat(F.lit("//h"), key, F.lit(".example.org/x/../y")),
        "whole": F.concat(F.lit(" HTTPS://w"), key, F.lit(".example.org?q ")),
        "fragment": F.concat(F.lit("#f"), key),
        "mail": F.concat(F.lit("mailto:m"), key, F.lit("@example.org")),
        "empty": F.lit(""),
    }
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("ref")) for k, v in references.items()))
    each = table(spark, sf_dir, "pages").select("page_id", "url", F.inline(rows))
    return each.select("page_id", "kind", url.resolved(F.col("url"), F.col("ref")).alias("article_url"))


@query
def url_host(spark, sf_dir):
    page, key = F.col("url"), F.col("page_id")
    scheme, rest = F.substring_index(page, "://", 1), F.substring_index(page, "://", -1)
    variant = (
        F.when(key % 6 == 1, F.upper(page))
        .when(key % 6 == 2, F.concat(scheme, F.lit("://user:pw@"), rest))
        .when(key % 6 == 3, rest)
        .when(key % 6 == 4, F.regexp_replace(page, "^([a-z]+://[^/]+)", "$1:8080"))
        .when(key % 6 == 5, F.concat(F.lit(" "), page, F.lit(" ")))
        .otherwise(page)
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", text.url_host(variant).alias("host")
    )


@query
def url_dedup(spark, sf_dir):
    fresh = ingest.new_urls(
        fixtures.found_urls(spark, sf_dir), fixtures.seen_urls(spark, sf_dir), "page_id"
    )
    return fresh.select("article_url", "page_id")


def _event_stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    return tables.file_stream(spark, path, spark.read.parquet(path).schema)


@query
def url_dedup_stream(spark, sf_dir):
    root = shared_dir(spark, "dedup")
    feed = fixtures.url_feed_of(_arriving(spark, sf_dir, "events", "ts", root))
    dedup.start_new_urls(feed, f"{root}/seen", f"{root}/state").awaitTermination()
    return dedup.seen_urls(spark, f"{root}/seen").rows().select("article_url")


@query
def html_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.clean_text(F.col("html")).alias("clean_text")
    )


@query
def keyword_relevance(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return ingest.relevant(documents, column="text").select("doc_id", "lang", "source")


@query
def relevant_articles(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = articles.relevant_articles(pages, fixtures.seen_urls(spark, sf_dir))
    return found.select("page_id", "clean_text", "source_url", "source_domain")


# Validation


def _verdict(checked, key):
    return checked.select(
        key,
        F.col("first_error").isNull().alias("valid"),
        "first_error",
        F.size("errors").cast("bigint").alias("n_errors"),
    )


@query
def validate_article(spark, sf_dir):
    bodies = validate.parse(fixtures.raw_articles(spark, sf_dir), "body")
    return _verdict(validate.check(bodies, checks.ARTICLE), "doc_id")


@query
def validate_analysis(spark, sf_dir):
    return _verdict(_checked_messages(spark, sf_dir), "msg_id")


@query
def validate_enriched(spark, sf_dir):
    bodies = validate.parse(fixtures.raw_enriched(spark, sf_dir), "body")
    return _verdict(validate.check(bodies, checks.ENRICHED), "lead_id")


@query
def validate_correction(spark, sf_dir):
    key = F.col("lead_id")
    id_text = (
        F.when(key % 7 == 1, '"id":null,')
        .when(key % 7 == 2, '"id":"",')
        .when(key % 7 == 3, '"id":0,')
        .when(key % 7 == 4, '"id":false,')
        .when(key % 7 == 5, "")
        .when(key % 7 == 6, F.concat(F.lit('"id":'), key, F.lit(",")))
        .otherwise(F.concat(F.lit('"id":"'), key, F.lit('",')))
    )
    company = F.to_json(F.struct("companyName"))
    body = F.concat(F.lit("{"), id_text, F.substring(company, F.lit(2), F.length(company)))
    bodies = fixtures.leads(spark, sf_dir).select("lead_id", body.alias("body"))
    checked = validate.check(validate.parse(bodies, "body"), checks.CORRECTION)
    return _verdict(checked, "lead_id")


# Extraction


def _document_articles(spark, sf_dir):
    squashed = F.trim(F.regexp_replace("text", text.BLANKS_PATTERN, " "))
    documents = with_once(table(spark, sf_dir, "documents"), "clean_text", squashed).select(
        "doc_id",
        "clean_text",
        F.concat(F.lit("https://"), "source", F.lit(".example.org/"), "doc_id").alias(
            "source_url"
        ),
        F.concat(F.lit("https://"), "source", F.lit(".example.org")).alias("source_domain"),
    )
    return ingest.relevant(documents)


@query
def render_prompt(spark, sf_dir):
    prompted = extract.with_prompt(_document_articles(spark, sf_dir))
    return prompted.select("doc_id", "prompt")


def _lead_fields(*keys):
    return [
        *keys,
        "companyName",
        "industry",
        "opportunityType",
        long("opportunityScore").alias("score"),
        "summary",
        "sourceURL",
    ]


@query
def model_extract(spark, sf_dir):
    checked = articles.extracted(
        _document_articles(spark, sf_dir), extract.field_model, "doc_id"
    )
    return articles.leads_from(checked, "doc_id").select(*_lead_fields("doc_id"))


@query
def reply_parse(spark, sf_dir):
    checked = extract.checked_reply(fixtures.model_replies(spark, sf_dir))
    typed = validate.typed(checked, ANALYSIS, "lead_id", "first_error")
    return typed.select("lead_id", "first_error", "companyName", "sourceURL")


# External verification


@query
def source_reputation(spark, sf_dir):
    lead = verify.with_reputation(fixtures.leads(spark, sf_dir))
    return lead.select(
        "lead_id",
        text.url_host(F.col("sourceURL")).alias("host"),
        long("sourceReputationScore").alias("reputation"),
    )


@query
def fact_extract(spark, sf_dir):
    lead = verify.with_facts(fixtures.leads(spark, sf_dir))
    return lead.select("lead_id", "facts.companyName", "facts.investment", "facts.region")


@query
def corroboration(spark, sf_dir):
    lead = verify.with_corroboration(fixtures.leads(spark, sf_dir), urls=True)
    return lead.select(
        "lead_id",
        long("corroboratingSources").alias("n_sources"),
        joined("corroboratingUrls").alias("urls"),
        F.col("evidenceId").alias("evidence_id"),
    )


@query
def corroboration_evidence(spark, sf_dir):
    proof = verify.evidence(fixtures.leads(spark, sf_dir))
    return proof.withColumnRenamed("evidenceId", "evidence_id")


@query
def corroboration_urls(spark, sf_dir):
    """The whole list of each lead that a construction firm may ask about."""
    leads = fixtures.leads(spark, sf_dir)
    asked = verify.with_evidence_id(leads.where("array_contains(potentialNeed, 'Construction Services')"))
    return verify.corroborating_urls(asked, verify.evidence(leads)).withColumnRenamed(
        "sourceURL", "url"
    )


@query
def confidence_score(spark, sf_dir):
    lead = verify.with_reputation(fixtures.leads(spark, sf_dir))
    score = scoring.confidence_score(F.col("sourceReputationScore"), F.col("corroborating"))
    return lead.select("lead_id", long(score).alias("confidence"))


@query
def verification_enrich(spark, sf_dir):
    lead = verify.with_reputation(
        verify.with_corroboration(fixtures.leads(spark, sf_dir), urls=True)
    )
    return verify.with_verification(lead, AS_OF).select(
        "lead_id",
        "companyName",
        long("verification.confidenceScore").alias("confidence"),
        long("verification.sourceReputationScore").alias("reputation"),
        long("verification.corroboratingSources").alias("n_sources"),
        joined("verification.corroboratingUrls").alias("urls"),
        F.col("verification.evidenceId").alias("evidence_id"),
        "verification.lastCheckedTimestamp",
    )


# Internal quality control


@query
def business_rules(spark, sf_dir):
    failed = scoring.failed_rules()
    return fixtures.leads(spark, sf_dir).select(
        "lead_id", joined(failed).alias("failed"), long(F.size(failed)).alias("n_failed")
    )


@query
def logical_consistency(spark, sf_dir):
    return fixtures.leads(spark, sf_dir).select(
        "lead_id", scoring.logical_consistency().alias("consistency")
    )


TONE_WORDS = ("doubling", "volumes", "deal", "the", "und", "que")


@query
def tone_check(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", scoring.word_share_tone(F.col("text"), TONE_WORDS, 0.125).alias("tone")
    )


def _controlled(spark, sf_dir):
    # The tone check fails every seventh lead here, so that its penalty shows.
    tone = F.when(F.col("lead_id") % 7 == 0, "Failed").otherwise("Passed")
    return quality.with_internal_qc(fixtures.leads(spark, sf_dir), AS_OF, tone)


@query
def quality_score(spark, sf_dir):
    return _controlled(spark, sf_dir).select(
        "lead_id", long("internal_qc.qualityScore").alias("quality")
    )


@query
def qc_enrich(spark, sf_dir):
    return _controlled(spark, sf_dir).select(
        "lead_id",
        long("internal_qc.qualityScore").alias("quality"),
        long("internal_qc.rulesPassed").alias("rules_passed"),
        long("internal_qc.rulesFailed").alias("rules_failed"),
        joined("internal_qc.failedRules").alias("failed"),
        "internal_qc.logicalConsistency",
        "internal_qc.toneAnalysis",
        "internal_qc.lastCheckedTimestamp",
    )


# Merge, decision and routing


def _scores(*keys):
    return [
        *keys,
        long("verification.confidenceScore").alias("confidence"),
        long("internal_qc.qualityScore").alias("quality"),
    ]


@query
def merge_branches(spark, sf_dir):
    lead = fixtures.leads(spark, sf_dir)
    merged = decide.merge_branches(
        lead, fixtures.verified_half(lead), fixtures.controlled_half(lead)
    )
    return merged.select(*_scores("lead_id", "companyName"))


@query
def merge_partials(spark, sf_dir):
    lead = fixtures.leads(spark, sf_dir)
    # The second halves of mergers have not come yet.
    controlled = fixtures.controlled_half(lead.where("opportunityType <> 'Merger'"))
    halves = fixtures.verified_half(lead).drop("ts").unionByName(
        controlled.drop("ts"), allowMissingColumns=True
    )
    return decide.merge_partials(halves).select(*_scores("lead_id"))


def _merged_stream(spark, sf_dir, verified, controlled):
    """A merger that has seen both halves of the leads, made from orders as they arrive."""
    root = shared_dir(spark, "merge")

    def lead():
        orders = _arriving(spark, sf_dir, "orders", "o_orderkey", root)
        return fixtures.leads_of(orders, spark, sf_dir)

    feeds = verified(lead()), controlled(lead())
    types = {name: feed.schema[name].dataType for name, feed in zip(merge.HALVES, feeds, strict=True)}
    # The files come in any order: a half may be as far behind as the table is long.
    merger = merge.HalfMerger(spark, f"{root}/halves", delay=10**9, types=types)
    merge.start_merge(merger, *feeds, f"{root}/state").awaitTermination()
    merger.finish(merge.last_batch(spark, merger.path))
    return merger


@query
def merge_partials_stream(spark, sf_dir):
    merger = _merged_stream(spark, sf_dir, fixtures.verified_half, fixtures.controlled_half)
    return merger.merged.rows().select(*_scores("lead_id"))


@query
def merge_quarantine_stream(spark, sf_dir):
    """Some halves never come and some come an hour late, on either side."""
    key = F.col("lead_id")

    def verified(lead):
        half = fixtures.verified_half(lead.where(key % 7 != 0))
        return half.withColumn("ts", F.when(key % 11 == 0, F.col("ts") + F.expr("interval 1 hour")).otherwise(F.col("ts")))

    def controlled(lead):
        half = fixtures.controlled_half(lead.where(key % 5 != 0))
        return half.withColumn("ts", F.when(key % 13 == 0, F.col("ts") + F.expr("interval 1 hour")).otherwise(F.col("ts")))

    merger = _merged_stream(spark, sf_dir, verified, controlled)
    merged = merger.merged.rows().select("lead_id", F.lit("both").alias("half"), F.lit("merged").alias("reason"))
    return merged.unionByName(merger.quarantine().select("lead_id", "half", "reason"))


@query
def decision_matrix(spark, sf_dir):
    bodies = validate.parse(fixtures.raw_enriched(spark, sf_dir), "body")
    good = validate.check(bodies, checks.ENRICHED).where("first_error is null")
    return good.select("lead_id", decide.raw_decision(F.col("record")).alias("decision"))


@query
def decision_stamp(spark, sf_dir):
    final = fixtures.scored(spark, sf_dir)
    return final.select(*_scores("lead_id"), "decision", "decisionTimestamp")


@query
def route_counts(spark, sf_dir):
    final = fixtures.scored(spark, sf_dir)
    sent = final.select(
        "decision", F.explode(decide.destinations(F.col("decision"))).alias("destination")
    )
    return sent.groupBy("destination", "decision").agg(F.count(F.lit(1)).alias("n_leads"))


@query
def record_outcome(spark, sf_dir):
    bodies = validate.parse(fixtures.raw_enriched(spark, sf_dir), "body")
    checked = validate.check(bodies, checks.ENRICHED)
    code, message = decide.outcome(
        F.col("companyName"), decide.raw_decision(F.col("record")), F.col("first_error")
    )
    return checked.select("lead_id", long(code).alias("code"), message.alias("message"))


@query
def review_log_event(spark, sf_dir):
    events = decide.review_log(decide.route(fixtures.scored(spark, sf_dir))["review"])
    return events.select(
        "lead_id",
        F.get_json_object("event", "$.review_required").alias("review_required"),
        F.get_json_object("event", "$.companyName").alias("company"),
        F.get_json_object("event", "$.summary").alias("summary"),
    )


@query
def review_alert_window(spark, sf_dir):
    events = fixtures.review_events_of(table(spark, sf_dir, "events"))
    return decide.review_alerts(events, config.REVIEW_WINDOW).select(
        utc_iso(F.col("window_start")).alias("window_start"), "n_events"
    )


@query
def review_alert_stream(spark, sf_dir):
    root = shared_dir(spark, "review-alerts")
    events = fixtures.review_events_of(_event_stream(spark, sf_dir))
    with state_partitions(spark):
        alert_stream.start_review_alerts(
            events, f"{root}/windows", f"{root}/state"
        ).awaitTermination()
    return alert_stream.current_alerts(spark, f"{root}/windows").select(
        utc_iso(F.col("window_start")).alias("window_start"), "n_events"
    )


# Human review


@query
def review_form_view(spark, sf_dir):
    key = F.col("lead_id")
    items = fixtures.queue(spark, sf_dir).withColumns(
        {
            "companyName": F.when(key % 5 == 0, F.lit(None)).otherwise(F.col("companyName")),
            "keyQuote": F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("keyQuote")),
            "potentialNeed": F.when(key % 9 != 0, F.col("potentialNeed")),
            "opportunityScore": F.when(key % 11 != 0, F.col("opportunityScore")),
        }
    )
    return review.form_view(items).select(
        "id",
        "title",
        "companyName",
        "industry",
        "region",
        "opportunityType",
        "summary",
        "potentialNeed",
        long("opportunityScore").alias("score"),
        "keyQuote",
    )


@query
def review_action(spark, sf_dir):
    done = review.normalised_actions(fixtures.review_actions(spark, sf_dir))
    return done.select(
        "lead_id",
        long("attempt").alias("attempt"),
        "id",
        "status",
        F.coalesce("corrected", F.lit(False)).alias("corrected"),
        "companyName",
        "opportunityType",
        joined("potentialNeed").alias("needs"),
        F.col("opportunityScore").cast("string").alias("score"),
    )


@query
def review_queue_resolve(spark, sf_dir):
    waiting = review.pending(
        fixtures.queue(spark, sf_dir), fixtures.corrections(spark, sf_dir)
    )
    return waiting.select("id", "lead_id")


@query
def tuning_dataset(spark, sf_dir):
    rows = review.tuning_rows(
        fixtures.queue(spark, sf_dir), fixtures.corrections(spark, sf_dir)
    )
    return rows.select(
        "id",
        "status",
        long("label").alias("label"),
        F.col("original.region").alias("original_region"),
        F.col("answer.region").alias("answer_region"),
        joined("changedFields").alias("changed"),
    )


@query
def review_queue_count(spark, sf_dir):
    waiting = review.pending(
        fixtures.queue(spark, sf_dir), fixtures.corrections(spark, sf_dir)
    )
    return review.queue_count(waiting)


# Delivery and reports


@query
def alert_payload(spark, sf_dir):
    ready = deliver.alerts(decide.route(fixtures.scored(spark, sf_dir))["final-leads"])
    field = lambda path: F.get_json_object("payload", path)
    return ready.select(
        "lead_id",
        field("$.text").alias("line"),
        field("$.blocks[0].text.text").alias("header"),
        field("$.blocks[1].fields[0].text").alias("industry"),
        field("$.blocks[1].fields[1].text").alias("region"),
        field("$.blocks[2].text.text").alias("opportunity"),
        field("$.blocks[3].text.text").alias("needs"),
        field("$.blocks[4].elements[0].text").alias("source"),
        field("$.blocks[4].elements[1].text").alias("confidence"),
    )


def _approved(spark, sf_dir, *names):
    final = fixtures.scored(spark, sf_dir).select(*FINAL_ANALYSIS.fieldNames())
    approved = tables.warehouse_rows(final).where("decision = 'Approved'")
    return tables.typed_warehouse(approved, FINAL_ANALYSIS, *names)


@query
def lead_report(spark, sf_dir):
    names = ("companyName", "summary", "sourceURL", "opportunityScore", "decision")
    return deliver.lead_report(_approved(spark, sf_dir, *names)).withColumn(
        "opportunityScore", long("opportunityScore")
    )


@query
def region_score_map(spark, sf_dir):
    return deliver.region_scores(
        _approved(spark, sf_dir, "region", "opportunityScore", "decision")
    )


# Composed jobs


@query
def lead_scoring(spark, sf_dir):
    final = score_leads(fixtures.leads(spark, sf_dir), as_of=AS_OF)
    return final.select(
        *_scores("lead_id"),
        long("verification.corroboratingSources").alias("n_sources"),
        "decision",
    )


@query
def lead_scoring_given(spark, sf_dir):
    return fixtures.scored(spark, sf_dir).select(*_scores("lead_id"), "decision")


@query
def lead_scoring_stream(spark, sf_dir):
    root = shared_dir(spark, "scoring")
    orders = _arriving(spark, sf_dir, "orders", "o_orderkey", root)
    messages = fixtures.raw_messages_of(fixtures.leads_of(orders, spark, sf_dir))
    scorer = scoring_stream.LeadScorer(
        spark, f"{root}/scored", "msg_id", trusted=fixtures.WIDE_TRUST, as_of=AS_OF
    )
    scorer.know(fixtures.leads(spark, sf_dir))
    scoring_stream.start_scoring(scorer, messages, f"{root}/state").awaitTermination()
    return scorer.routed().select(
        "msg_id", F.col("destination").cast("string").alias("destination"), "decision", "reason"
    )


@query
def article_leads(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = articles.relevant_articles(pages, fixtures.seen_urls(spark, sf_dir))
    path = f"{shared_dir(spark, 'articles')}/replies"
    # The model runs once; its checked replies are a table from here on.
    articles.extracted(found, extract.field_model, "page_id").select(
        "page_id", "text", "first_error", "values"
    ).write.parquet(path)
    leads = articles.leads_from(spark.read.parquet(path), "page_id")
    final = score_leads(leads, as_of=AS_OF)
    return final.select(*_scores("page_id", "companyName", "sourceURL"), "decision")
