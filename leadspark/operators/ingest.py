"""From sources to relevant articles."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark import config
from leadspark.functions import text, url
from leadspark.operators.once import with_once

def cycle_starts(times: DataFrame, ts: str = "ts", step: str = config.CYCLE) -> DataFrame:
    """One row per cycle from the first to the last time in the input."""
    span = times.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    first = F.date_trunc("day", "first")
    cycles = F.sequence(first, F.col("last"), F.expr(f"interval {step}"))
    return (
        span.where("first is not null")
        .select(F.explode(cycles).alias("cycle_start"), "first")
        .where(F.col("cycle_start") > F.col("first") - F.expr(f"interval {step}"))
        .select("cycle_start")
    )


def busy_cycles(events: DataFrame, ts: str = "ts", step: str = config.CYCLE) -> DataFrame:
    """One row per cycle with events in it; works on streams with a watermark as well."""
    counts = events.groupBy(F.window(ts, step).alias("window")).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    return counts.select(F.col("window.start").alias("cycle_start"), "n_events")


def fan_out(
    cycles: DataFrame, sources: Sequence[tuple[str, str]] = config.SOURCES
) -> DataFrame:
    """One work item per source for each row; works on streams as well."""
    items = F.array(
        *[
            F.struct(F.lit(url).alias("source_url"), F.lit(kind).alias("source_type"))
            for url, kind in sources
        ]
    )
    return cycles.select("*", F.inline(items))


def article_refs(found: DataFrame, urls: str = "article_urls") -> DataFrame:
    """One row per discovered article URL, with its host; URLs without host have NULL."""
    exploded = found.withColumn("article_url", F.explode(urls)).drop(urls)
    return exploded.withColumn("source_domain", text.url_host(F.col("article_url")))


def page_links(pages: DataFrame) -> DataFrame:
    """Links of landed pages as absolute web addresses, in an array column."""
    return pages.select("page_id", url.links(F.col("url"), F.col("html")).alias("article_urls"))


def new_urls(
    refs: DataFrame, seen: DataFrame | None = None, order: str | None = None
) -> DataFrame:
    """Each URL once, without those seen before.

    Copies of a URL are folded before the shuffle; the row with the least `order` stays.
    """
    others = [name for name in refs.columns if name != "article_url"]
    first = sorted(others, key=lambda name: name != order)
    folded = refs.groupBy("article_url").agg(
        F.min(F.struct(*first) if first else F.lit(0)).alias("row")
    )
    once = folded.select("article_url", *[f"row.{name}" for name in others])
    if seen is None:
        return once
    return once.join(seen.select("article_url"), "article_url", "left_anti")


def keyword_counts(
    articles: DataFrame, keywords: Sequence[str] = config.KEYWORDS, column: str = "text"
) -> DataFrame:
    """How many texts each keyword occurs in; keywords without a text count 0."""
    counts = [
        F.count_if(F.contains("low", F.lit(keyword))).alias(f"k{index}")
        for index, keyword in enumerate(keywords)
    ]
    totals = articles.select(F.lower(column).alias("low")).agg(*counts)
    rows = [
        F.struct(F.lit(keyword).alias("keyword"), F.col(f"k{index}").alias("n_articles"))
        for index, keyword in enumerate(keywords)
    ]
    return totals.select(F.inline(F.array(*rows)))


def relevant(
    articles: DataFrame,
    keywords: Sequence[str] = config.KEYWORDS,
    column: str = "clean_text",
) -> DataFrame:
    """Articles whose text holds a keyword; an empty list keeps none."""
    return articles.where(text.has_keyword(F.col(column), tuple(keywords)))


def page_articles(pages: DataFrame) -> DataFrame:
    """Landed pages as articles: text, URL and host. Pages without a host are left out."""
    hosts = pages.withColumn("source_domain", text.url_host(F.col("url")))
    with_host = hosts.where(F.col("source_domain").isNotNull())
    return with_once(with_host, "clean_text", text.clean_text(F.col("html"))).select(
        "page_id", "clean_text", F.col("url").alias("source_url"), "source_domain"
    )
