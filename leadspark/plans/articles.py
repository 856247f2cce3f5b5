"""From landed pages to decided leads."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark import config
from leadspark.functions import checks
from leadspark.operators import extract, ingest, validate
from leadspark.schemas import ANALYSIS, ARTICLE


def relevant_articles(
    pages: DataFrame,
    seen: DataFrame | None = None,
    keywords: Sequence[str] = config.KEYWORDS,
) -> DataFrame:
    """New relevant articles.

    Only page numbers and URLs are shuffled to find new pages; the pages follow by number.
    """
    articles = ingest.page_articles(pages)
    if seen is not None:
        refs = pages.select(F.col("url").alias("article_url"), "page_id")
        fresh = ingest.new_urls(refs, seen, order="page_id").select("page_id")
        articles = articles.join(fresh, "page_id", "left_semi")
    return ingest.relevant(articles, keywords)


def checked_articles(articles: DataFrame) -> DataFrame:
    """Articles as records with their errors."""
    bodies = articles.withColumn("text", F.to_json(F.struct(*ARTICLE.fieldNames())))
    return validate.check(validate.parse(bodies), checks.ARTICLE)


def extracted(articles: DataFrame, model: extract.Model, *keep: str) -> DataFrame:
    """Checked replies of the model on articles. Write them to a table to use them twice."""
    good = checked_articles(articles).where("first_error is null")
    prompted = extract.with_prompt(good.select(*keep, *ARTICLE.fieldNames()))
    return extract.checked_reply(extract.with_reply(prompted, model))


def leads_from(checked: DataFrame, *keep: str) -> DataFrame:
    return validate.accepted(checked, ANALYSIS, *keep)
