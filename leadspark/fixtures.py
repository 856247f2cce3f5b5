"""Test inputs derived from the given tables by Spark; nothing is made up or cut short."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadspark import config
from leadspark.functions import envelope
from leadspark.functions.clock import from_utc_wall_clock
from leadspark.operators import quality, review, verify
from leadspark.plans.lead_scoring import score_leads
from leadspark.schemas import ANALYSIS_FIELDS
from leadspark.session import spread

AS_OF = "2024-02-01T00:00:00.000Z"
START_SECONDS = 1704067200  # 2024-01-01

# More hosts than the default ones, so that leads of every decision come about.
WIDE_TRUST = ("reuters.com", "bloomberg.com", "www.bloomberg.com", "example.com")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def leads_of(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lead per order; orders may be a stream."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region")
    key = F.col("o_orderkey")
    host = F.element_at(
        F.array(
            F.lit("reuters.com"),
            F.lit("bloomberg.com"),
            F.lit("my-sensational-blog.net"),
            F.lit("www.bloomberg.com"),
            F.lit("example.com"),
        ),
        (key % 5 + 1).cast("int"),
    )
    amount = (F.floor(F.col("o_totalprice") / 100000) * 100).cast("bigint")
    worth = F.concat(
        F.lit(" worth $"),
        amount.cast("string"),
        F.lit("M in "),
        F.col("r_name"),
        F.lit(", doubling volumes"),
    )
    summary = F.concat(
        F.col("c_name"),
        F.when(key % 3 == 0, " plans an Expansion").otherwise(" signs a deal"),
        F.when(key % 4 < 3, worth).otherwise(""),
    )
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "New Construction")
        .when(F.col("o_orderpriority") == "2-HIGH", "Expansion")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Downsizing")
        .otherwise("Merger")
    )
    return (
        orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("lead_id"),
            F.col("c_name").alias("companyName"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "Technology")
            .otherwise(F.col("c_mktsegment"))
            .alias("industry"),
            F.col("r_name").alias("region"),
            kind.alias("opportunityType"),
            summary.alias("summary"),
            F.when(
                key % 2 == 0, F.array(F.lit("Construction Services"), F.lit("Security"))
            )
            .otherwise(F.array(F.lit("Security")))
            .alias("potentialNeed"),
            (key % 10 + 1).cast("int").alias("opportunityScore"),
            F.concat(F.col("c_name"), F.lit(" said so")).alias("keyQuote"),
            F.concat(
                F.lit("https://"), host, F.lit("/story/"), key.cast("string")
            ).alias("sourceURL"),
            (key % 13).cast("int").alias("corroborating"),
            F.timestamp_seconds(F.lit(START_SECONDS) + key * 7).alias("ts"),
        )
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads_of(spread(table(spark, sf_dir, "orders")), spark, sf_dir)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decided leads with the given number of sources; all three decisions occur."""
    return score_leads(
        leads(spark, sf_dir), as_of=AS_OF, sources=F.col("corroborating")
    )


def _json_fields(**changes: Column | None) -> Column:
    """JSON of an analysis with fields changed, added, or left out where None."""
    fields = {name: F.col(name) for name in ANALYSIS_FIELDS} | changes
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in fields.items() if value is not None]),
        {"ignoreNullFields": "false"},
    )


def raw_bodies(leads: DataFrame) -> DataFrame:
    """Analyses as JSON text, ten of eleven kinds of them with something off."""
    kind = F.col("lead_id") % 11
    schemeless = F.regexp_replace("sourceURL", "^https://", "")
    body = (
        F.when(kind == 2, F.concat(_json_fields(), F.lit(" trailing")))
        .when(kind == 3, _json_fields(companyName=None))
        .when(kind == 4, _json_fields(companyName=F.lit("")))
        .when(kind == 5, _json_fields(opportunityScore=F.lit(11)))
        .when(kind == 6, _json_fields(opportunityScore=F.lit("9")))
        .when(kind == 7, _json_fields(note=F.lit("extra")))
        .when(kind == 8, _json_fields(sourceURL=schemeless))
        .when(kind == 9, _json_fields(potentialNeed=F.lit("Security")))
        .when(kind == 10, _json_fields(summary=F.lit(None).cast("string")))
        .otherwise(_json_fields())
    )
    return leads.select(F.col("lead_id").alias("msg_id"), body.alias("body"))


def raw_messages_of(leads: DataFrame) -> DataFrame:
    """The same in envelopes; one of eleven is not base64 at all."""
    bodies = raw_bodies(leads)
    broken = F.concat(F.lit("%%%"), F.col("msg_id").cast("string"))
    data = F.when(F.col("msg_id") % 11 == 1, broken).otherwise(
        envelope.encoded(F.col("body"))
    )
    return bodies.select("msg_id", data.alias("data"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages_of(leads(spark, sf_dir))


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as article records, six of seven kinds of them with something off."""
    kind = F.col("doc_id") % 7
    text = F.col("text").alias("clean_text")
    url = F.concat(
        F.lit("https://"), F.col("source"), F.lit(".example.org/"), F.col("doc_id")
    ).alias("source_url")
    domain = F.concat(F.col("source"), F.lit(".example.org")).alias("source_domain")
    body = (
        F.when(kind == 1, F.to_json(F.struct(url, domain)))
        .when(kind == 2, F.to_json(F.struct(F.lit("").alias("clean_text"), url, domain)))
        .when(
            kind == 3,
            F.to_json(F.struct(text, F.lit("not a uri").alias("source_url"), domain)),
        )
        .when(kind == 4, F.to_json(F.struct(text, url, F.lit(5).alias("source_domain"))))
        .when(
            kind == 5,
            F.to_json(F.struct(text, url, domain, F.lit("en").alias("language"))),
        )
        .when(kind == 6, F.to_json(F.array(F.struct(text, url, domain))))
        .otherwise(F.to_json(F.struct(text, url, domain)))
    )
    return spread(table(spark, sf_dir, "documents")).select("doc_id", body.alias("body"))


def raw_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched analyses as JSON text; scores are missing, null, text or numbers."""
    lead = leads(spark, sf_dir)
    key = F.col("lead_id")
    grid = (0, 69, 70, 71, 90, 91, 100)

    def score(name: str, kind: Column) -> Column:
        number = F.element_at(F.array(*[F.lit(n) for n in grid]), (kind - 1).cast("int"))
        return (
            F.when(kind == 0, F.lit("{}"))
            .when(kind == 1, F.lit(f'{{"{name}":null}}'))
            .otherwise(F.concat(F.lit(f'{{"{name}":'), number.cast("string"), F.lit("}")))
        )

    verification = F.when(key % 23 == 7, F.lit("[]")).otherwise(
        score("confidenceScore", key % 9)
    )
    base = _json_fields()
    body = F.concat(
        F.substring(base, F.lit(1), F.length(base) - 1),
        F.lit(',"verification":'),
        verification,
        F.when(
            key % 29 != 8,
            F.concat(
                F.lit(',"internal_qc":'),
                score("qualityScore", F.floor(key / 9).cast("bigint") % 9),
            ),
        ).otherwise(""),
        F.lit("}"),
    )
    return lead.select("lead_id", "companyName", body.alias("body"))


def model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of a model on leads: some fenced, some chatty, some empty, some cut."""
    lead = leads(spark, sf_dir)
    key = F.col("lead_id")
    body = _json_fields()
    fence = F.lit("```")
    text = (
        F.when(key % 7 == 0, F.concat(fence, F.lit("json\n"), body, F.lit("\n"), fence))
        .when(key % 11 == 0, F.concat(body, F.lit(" I hope this helps.")))
        .when(key % 13 == 0, F.lit(""))
        .when(key % 17 == 0, F.lit(None).cast("string"))
        .when(key % 19 == 0, _json_fields(opportunityScore=F.lit(7.5)))
        .otherwise(F.concat(F.lit("  "), body, F.lit("\n")))
    )
    part = F.array(F.struct(text.alias("text")))
    content = F.struct(part.alias("parts"))
    reply = F.to_json(
        F.struct(F.array(F.struct(content.alias("content"))).alias("candidates"))
    )
    return lead.select("lead_id", reply.alias("reply"))


def seen_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages without encryption have been seen before."""
    pages = table(spark, sf_dir, "pages").where(F.col("url").startswith("http:"))
    return pages.select(F.col("url").alias("article_url"))


def found_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of pages, those of every third page found twice."""
    pages = table(spark, sf_dir, "pages")
    again = F.when(F.col("page_id") % 3 == 0, 2).otherwise(1)
    copies = F.explode(F.sequence(F.lit(1), again)).alias("copy")
    return pages.select(F.col("url").alias("article_url"), "page_id", copies)


def event_times(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", from_utc_wall_clock(F.col("ts")))


def url_feed_of(events: DataFrame) -> DataFrame:
    return event_times(events).select(
        F.concat(F.lit("https://news.example.org/"), F.col("user_id")).alias("article_url"),
        "ts",
    )


def review_events_of(events: DataFrame) -> DataFrame:
    return event_times(events).select(
        (F.col("event_type") == "error").alias("review_required"), "ts"
    )


def verified_half(lead: DataFrame) -> DataFrame:
    """Lead, verification and the time at which that half is sent."""
    backed = lead.withColumns(
        {
            "corroboratingSources": F.col("corroborating"),
            "corroboratingUrls": F.array().cast("array<string>"),
        }
    )
    done = verify.with_verification(verify.with_reputation(backed), AS_OF)
    return done.select("lead_id", "verification", "ts")


def controlled_half(lead: DataFrame) -> DataFrame:
    """The other half, sent up to five minutes later."""
    done = quality.with_internal_qc(lead, AS_OF)
    later = F.timestamp_seconds(F.unix_timestamp("ts") + F.col("lead_id") % 301)
    return done.select("lead_id", "internal_qc", later.alias("ts"))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = scored(spark, sf_dir).where(F.col("decision") == "Manual Review")
    return review.queue_items(final, "lead_id")


def review_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of reviewers, some twice, some for no known item; one region has none yet."""
    key = F.col("lead_id")
    item_id = (
        F.when(key % 19 == 0, F.lit(None).cast("string"))
        .when(key % 17 == 0, F.concat(F.lit("unknown-"), key.cast("string")))
        .otherwise(F.col("id"))
    )
    action = (
        F.when(key % 3 == 1, "decline").when(key % 2 == 0, "approve").otherwise("update")
    )
    again = F.when(key % 10 == 0, 2).otherwise(1)
    score = F.col("opportunityScore").cast("string")
    form = queue(spark, sf_dir).where("region <> 'AMERICA'")
    return form.select("*", F.explode(F.sequence(F.lit(1), again)).alias("attempt")).select(
        item_id.alias("id"),
        key,
        "attempt",
        action.alias("action"),
        "companyName",
        "industry",
        F.when(F.col("attempt") == 2, F.concat(F.col("region"), F.lit(" NORTH")))
        .otherwise(F.col("region"))
        .alias("region"),
        F.when(action == "update", "Acquisition")
        .otherwise(F.col("opportunityType"))
        .alias("opportunityType"),
        "summary",
        F.when(key % 4 == 0, F.array_join("potentialNeed", "\n\n"))
        .otherwise(F.array_join("potentialNeed", "\n"))
        .alias("potentialNeed"),
        F.when(key % 6 == 0, "7abc")
        .when(key % 15 == 0, "n/a")
        .otherwise(score)
        .alias("opportunityScore"),
        "keyQuote",
        F.timestamp_seconds(F.lit(START_SECONDS) + key * 7 + F.col("attempt") * 60).alias(
            "submitted_at"
        ),
    )


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = review.normalised_actions(review_actions(spark, sf_dir))
    return actions.where("id is not null")


def source_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured source that each landed page came from, as a message."""
    catalog = F.array(*[F.array(F.lit(url), F.lit(kind)) for url, kind in config.SOURCES])
    source = F.element_at(
        catalog, (F.col("page_id") % len(config.SOURCES) + 1).cast("int")
    )
    record = F.struct(source[0].alias("source_url"), source[1].alias("source_type"))
    return table(spark, sf_dir, "pages").select(
        "page_id", envelope.encoded(F.to_json(record)).alias("data")
    )
