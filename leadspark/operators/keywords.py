"""Keyword catalogs of any length: keywords are looked up by gram, not one by one.

Each keyword is filed under one gram of its longest word, the gram that fewest other
keywords have. Where the catalog is small enough to be sent to all tasks, each text looks up
its own grams, and the keywords found there are searched in the text; nothing of the texts
is shuffled. For longer catalogs the different words of all texts look up their grams, what
they find is searched in the word, and texts learn their keywords from their words by a
join; only keywords with a space in them are searched in the text as well. The catalog is a
table throughout.

Results are those of a substring search in the lower-cased text; keywords keep their case.
NULL texts and NULL keywords match nothing, the empty keyword matches every text, keywords
that repeat count once. Texts may repeat, and keys may repeat or be NULL.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadspark.config import BROADCAST_ROWS

#: Letters in a gram; keywords without so long a word are filed under a shorter run.
GRAM = 4


def _grams(word: Column, size: int, letter: str = ".") -> Column:
    """Different runs of `size` letters; one empty run for the size 0."""
    if size == 0:
        return F.when(word.isNotNull(), F.array(F.lit("")))
    pattern = f"(?s)(?=({letter}{{{size}}}))"
    return F.array_distinct(F.regexp_extract_all(word, F.lit(pattern), F.lit(1)))


def _filed(catalog: DataFrame, gram: int) -> DataFrame:
    """(keyword, part, size, gram): each keyword under its rarest gram in the catalog."""
    words = catalog.select("keyword").where("keyword IS NOT NULL").distinct()
    parts = F.transform(F.split("keyword", " "), lambda x: F.struct(F.length(x).alias("n"), x.alias("part")))
    words = words.select("keyword", F.array_max(parts).alias("longest"))
    words = words.select("keyword", "longest.part", F.least(F.lit(gram), "longest.n").alias("size"))
    own = F.coalesce(
        *[F.when(F.col("size") == size, _grams(F.col("part"), size)) for size in range(gram + 1)]
    )
    pairs = words.select("*", F.explode(own).alias("gram"))
    sizes = pairs.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ranked = pairs.join(sizes, "gram").groupBy("keyword", "part", "size")
    return ranked.agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))


def _sizes(catalog: DataFrame, gram: int) -> list[int]:
    """Sizes of the grams that keywords are filed under: at most gram + 1 numbers."""
    longest = F.array_max(F.transform(F.split("keyword", " "), F.length))
    sizes = catalog.select(F.least(F.lit(gram), longest).alias("size")).distinct().collect()
    return [row.size for row in sizes if row.size is not None]


def _looked_up(articles: DataFrame, catalog: DataFrame, column: str, gram: int, *keep: Column) -> DataFrame:
    """(keep, _keyword): each row and each keyword in its text once, without a shuffle of texts.

    A keyword has one gram and a row has different grams, so no pair comes twice.
    """
    filed = _filed(catalog, gram).select(
        F.col("gram").alias("_gram"), F.col("part").alias("_part"), F.col("keyword").alias("_keyword")
    )
    # Both are made below the explode(), once for each row and not for each gram.
    texts = articles.select(*keep, F.lower(F.col(column)).alias("_low"))
    texts = texts.withColumn("_words", F.array_join(F.array_distinct(F.split("_low", " ")), " "))
    grams = [_grams(F.col("_words"), size, "[^ ]") for size in _sizes(catalog, gram)]
    own = F.flatten(F.array(*grams)) if grams else F.array().cast("array<string>")
    asked = texts.select("*", F.explode(own).alias("_gram"))
    hits = asked.join(F.broadcast(filed), "_gram").where(F.contains("_words", "_part"))
    apart = ~F.contains("_keyword", F.lit(" "))
    return hits.where(apart | F.contains("_low", "_keyword")).drop("_low", "_words", "_gram", "_part")


def _is_small(catalog: DataFrame) -> bool:
    """Whether the catalog may be sent to all tasks."""
    return catalog.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _found(articles: DataFrame, catalog: DataFrame, column: str, gram: int) -> DataFrame:
    """(_text, _keyword), each once: keywords whose longest word is part of a word of the text."""
    own = F.array_distinct(F.split(F.lower(F.col(column)), " ")).alias("words")
    # The digest is made below the explode(), once for each text and not for each word.
    texts = articles.select(F.md5(F.col(column)).alias("_text"), own)
    words = texts.select("_text", F.explode("words").alias("word"))
    filed = _filed(catalog, gram)
    grams = [_grams(F.col("word"), size) for size in _sizes(catalog, gram)]
    own = F.flatten(F.array(*grams)) if grams else F.array().cast("array<string>")
    asked = words.select("word").distinct().select("word", F.explode(own).alias("gram"))
    hits = asked.join(filed, "gram").where(F.contains("word", "part"))
    known = hits.select("word", F.col("keyword").alias("_keyword"))
    return words.join(known, "word").select("_text", "_keyword").distinct()


def _held(texts: DataFrame, found: DataFrame, column: str) -> Column:
    apart = ~F.contains(found["_keyword"], F.lit(" "))
    whole = apart | F.contains(F.lower(texts[column]), found["_keyword"])
    return (F.md5(texts[column]) == found["_text"]) & whole


def matches(
    articles: DataFrame, catalog: DataFrame, key: str, column: str = "clean_text", gram: int = GRAM
) -> DataFrame:
    """(key, keyword): one row for each article and each keyword in its text."""
    if _is_small(catalog):
        hits = _looked_up(articles, catalog, column, gram, articles[key].alias(key))
        return hits.withColumnRenamed("_keyword", "keyword")
    found = _found(articles, catalog, column, gram)
    joined = articles.join(found, _held(articles, found, column))
    return joined.select(articles[key], found["_keyword"].alias("keyword"))


def relevant(
    articles: DataFrame, catalog: DataFrame, column: str = "clean_text", gram: int = GRAM
) -> DataFrame:
    """Articles whose text holds a keyword of the catalog; an empty catalog keeps none."""
    if _is_small(catalog):
        digest = F.md5(F.col(column)).alias("_text")
        found = _looked_up(articles, catalog, column, gram, digest).select("_text").distinct()
        return articles.join(found, F.md5(articles[column]) == found["_text"], "left_semi")
    found = _found(articles, catalog, column, gram)
    return articles.join(found, _held(articles, found, column), "left_semi")


def counts(
    articles: DataFrame, catalog: DataFrame, column: str = "clean_text", gram: int = GRAM
) -> DataFrame:
    """How many texts each keyword occurs in; keywords without a text count 0."""
    if _is_small(catalog):
        found = _looked_up(articles, catalog, column, gram).withColumnRenamed("_keyword", "keyword")
    else:
        found = matches(articles, catalog, column, column, gram)
    totals = found.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_articles"))
    words = catalog.select("keyword").where("keyword IS NOT NULL").distinct()
    joined = words.join(totals, "keyword", "left")
    return joined.select("keyword", F.coalesce("n_articles", F.lit(0)).alias("n_articles"))
