"""From sources to relevant articles."""

import json

import pytest
from pyspark.sql import functions as F

from leadspark import config
from leadspark.functions import text
from leadspark.operators import extract, ingest, keywords
from leadspark.sources import catalog


def test_one_work_item_per_source(spark):
    cycle = spark.createDataFrame([("2024-01-01",)], "cycle string")
    items = ingest.fan_out(cycle)
    assert items.count() == 14
    kinds = {row.source_type: row["count"] for row in items.groupBy("source_type").count().collect()}
    assert kinds == {"Scrape": 9, "API": 5}
    assert catalog.source_catalog(spark).count() == 14


def test_cycles_cover_the_span(spark):
    times = spark.sql(
        "select timestamp'2024-01-01 00:10:00' ts union all select timestamp'2024-01-01 01:30:00'"
    )
    starts = [row.cycle_start.strftime("%H:%M") for row in ingest.cycle_starts(times).collect()]
    assert starts == ["00:00", "00:30", "01:00", "01:30"]
    assert ingest.cycle_starts(times.where("false")).count() == 0


def test_cycles_with_events(spark):
    times = spark.sql(
        "select timestamp'2024-01-01 00:10:00' ts union all select timestamp'2024-01-01 00:29:00'"
    )
    row = ingest.fan_out(ingest.busy_cycles(times)).first()
    assert (row.cycle_start.hour, row.cycle_start.minute, row.n_events) == (0, 0, 2)


def test_catalogs_from_files(spark, tmp_path):
    path = tmp_path / "keywords.json"
    path.write_text(json.dumps({"keywords": ["finance", "ai"]}, indent=1))
    words = catalog.keyword_catalog(spark, str(path))
    assert [row.keyword for row in words.collect()] == ["finance", "ai"]
    many = tmp_path / "many"
    many.write_text('{"keywords": ["a b"]}\n{"keywords": []}\n{"keywords": [null, "c"]}\n')
    words = catalog.keyword_catalog(spark, str(many), lines=True)
    assert [row.keyword for row in words.collect()] == ["a b", None, "c"]


def test_two_articles_per_source(spark):
    source = "https://example.com"
    url = "https://example.com/news-story-{}?source=example.com"
    found = spark.createDataFrame(
        [(source, [url.format(123), url.format(456)])],
        "source_url string, article_urls array<string>",
    )
    rows = ingest.article_refs(found).collect()
    assert [row.article_url for row in rows] == [url.format(123), url.format(456)]
    assert {row.source_domain for row in rows} == {"example.com"}


@pytest.mark.parametrize(
    ("url", "host"),
    [
        ("https://www.Bloomberg.com/", "www.bloomberg.com"),
        ("http://user:pw@example.com:8080/a?b=c", "example.com"),
        ("https://my_host.example.org", "my_host.example.org"),
        ("https://example.com?x=1", "example.com"),
        ("https://example.com/a b|c", "example.com"),
        ("http://[::1]:80/", "[::1]"),
        (" https://example.com/ ", "example.com"),
        ("example.com/a", None),
        ("mailto:a@example.com", None),
        ("https:///path", None),
        ("https://exa mple.com/", None),
        (None, None),
    ],
)
def test_url_host(one, url, host):
    assert one(text.url_host(F.col("x")), row=(url,)) == host


@pytest.mark.parametrize(
    ("html", "clean"),
    [
        (
            '<nav><a href="/x">x</a></nav><article><h1>T</h1><p>fo<b>o</b> bar<br>baz</p>'
            "<!-- <article> --><script>var t='</p>';</script></article><footer>f</footer>",
            "T foo bar baz",
        ),
        ("<p>no article\n\n here</p>", "no article here"),
        ("<article></article>outside", ""),
        ("<article>a &amp; b &lt;c&gt; &amp;lt; &#8364;&#x41;&#39;</article>", "a & b <c> &lt; €A'"),
        ("<article>&#99999999; &# &#x; &#55555; &#128640;</article>", "&#99999999; &# &#x; &#55555; 🚀"),
        ('<article>a<div class="ad">buy</div>b</article>', "a b"),
        (None, None),
    ],
)
def test_clean_text(one, html, clean):
    assert one(text.clean_text(F.col("x")), row=(html,)) == clean


@pytest.mark.parametrize(
    ("content", "keywords", "hit"),
    [
        ("This is a sample article about business and tech.", ("business",), True),
        ("This is a sample article about sports and leisure.", ("finance",), False),
        ("BUSINESS", ("business",), True),
        ("business", ("Business",), False),
        ("she said", ("ai",), True),
        ("anything", (), False),
        ("anything", ("",), True),
    ],
)
def test_keywords(one, content, keywords, hit):
    assert one(text.has_keyword(F.col("x"), keywords), row=(content,)) is hit


def test_long_keyword_list_gives_the_same(spark):
    words = config.KEYWORDS + tuple(f"filler-{n}" for n in range(5000))
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    short = ingest.relevant(documents, column="text").select("doc_id").collect()
    frame = ingest.relevant(documents, words, "text").select("doc_id")
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    long = frame.collect()
    assert sorted(short) == sorted(long)
    assert len(short) == 136


def test_catalog_as_a_table_gives_the_same(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = config.KEYWORDS + tuple(f"filler-{n}" for n in range(5000))
    listed = spark.createDataFrame([(word,) for word in words], "keyword string")
    found = keywords.relevant(documents, listed, "text")
    literal = ingest.relevant(documents, words, "text")
    assert found.columns == documents.columns
    ids = sorted(row.doc_id for row in found.select("doc_id").collect())
    assert ids == sorted(row.doc_id for row in literal.select("doc_id").collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "filler-" not in plan
    got = {tuple(row) for row in keywords.counts(documents, listed, "text").collect()}
    assert {row for row in got if row[0] in config.KEYWORDS} == {
        tuple(row) for row in ingest.keyword_counts(documents).collect()
    }
    assert len(got) == len(set(words))


@pytest.mark.parametrize("gram", [1, 2, 4])
def test_catalog_matches_are_those_of_a_search(spark, gram):
    texts = [
        (1, "She said: BUSINESS"), (1, "a different text under one key"), (2, ""), (3, None),
        (None, "no key, but business"), (4, "abcabcab " * 3000 + "needle"), (5, "gr\u00fc\u00dfe \U0001f600\U0001f601 zoo"),
        (5, "a\nb\nc"), (6, "same"), (6, "same"),
    ]
    listed = [
        "ai", "business", "Business", "business", "needle", "cabc", "\u00fc\u00df", "\U0001f601", "\U0001f600\U0001f601 z",
        "a\nb", "", None, "x", "same", "abcabcab abcabcab abcabcab",
    ]
    frame = spark.createDataFrame(texts, "id int, clean_text string")
    words = spark.createDataFrame([(word,) for word in listed], "keyword string")
    got = [tuple(row) for row in keywords.matches(frame, words, "id", gram=gram).collect()]
    wanted = [
        (key, word)
        for key, content in texts
        for word in sorted({word for word in listed if word is not None})
        if content is not None and word in content.lower()
    ]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    none = words.where("keyword = 'absent'")
    assert keywords.relevant(frame, none, gram=gram).count() == 0
    assert keywords.counts(frame.where("false"), words, gram=gram).where("n_articles > 0").count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_catalogs_sent_and_joined_give_the_same(spark, monkeypatch, small):
    texts = [
        (1, "Gr\u00fc\u00dfe an ALLE an"), (1, "a b"), (2, ""), (3, None), (4, "same"), (4, "same"), (5, "\U0001f600abc x"),
        (6, "one\ntwo  three"),
    ]
    listed = ["an", "a", "?abc", "\u00dfe an", "alle", "Alle", "an an", "", None, "  ", "e\ntw", "same", "\U0001f600a"]
    frame = spark.createDataFrame(texts, "id int, clean_text string")
    words = spark.createDataFrame([(word,) for word in listed], "keyword string")
    monkeypatch.setattr(keywords, "BROADCAST_ROWS", 100 if small else 0)
    known = [word for word in listed if word is not None]
    held = [(key, word) for key, x in texts if x is not None for word in known if word in x.lower()]
    got = [tuple(row) for row in keywords.matches(frame, words, "id").collect()]
    assert sorted(got, key=str) == sorted(held, key=str)
    totals = {row.keyword: row.n_articles for row in keywords.counts(frame, words).collect()}
    assert totals == {word: sum(other == word for _, other in held) for word in known}
    some = words.where("keyword IN ('an', 'same')")
    kept = sorted(row.clean_text for row in keywords.relevant(frame, some).collect())
    assert kept == sorted(x for _, x in texts if x and ("an" in x.lower() or "same" in x))


def test_keywords_are_counted_without_a_shuffle_of_texts(spark):
    frame = spark.range(100).select(F.concat(F.lit("words of text "), "id").alias("clean_text"))
    words = spark.createDataFrame([("word",), ("ext 1",)], "keyword string")
    plan = keywords.counts(frame, words)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan
    assert "strategy=broadcast" in plan


def test_pages_are_cleaned_once(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    frame = ingest.relevant(ingest.page_articles(pages))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"script\b.*?</script") == 1
    assert frame.count() > 0


def test_new_urls_once_and_unseen(spark):
    refs = spark.createDataFrame(
        [("a", 3), ("a", 1), ("b", 2), ("c", 5)], "article_url string, page_id int"
    )
    seen = spark.createDataFrame([("b",)], "article_url string")
    fresh = ingest.new_urls(refs, seen, "page_id").collect()
    assert sorted((row.article_url, row.page_id) for row in fresh) == [("a", 1), ("c", 5)]


def test_prompt_is_literal(one):
    template = "Read: {{ARTICLE_TEXT}} end {{ARTICLE_TEXT}}"
    prompt = one(text.render_prompt(F.col("x"), template), row=("$& and $$",))
    assert prompt == "Read: $& and $$ end {{ARTICLE_TEXT}}"


def test_a_model_gets_texts_in_small_batches(spark):
    def model(batches):
        for batch in batches:
            yield batch.assign(reply=str(int(batch["clean_text"].str.len().sum())))

    frame = spark.range(0, 300, numPartitions=1).select(F.repeat(F.lit("words "), 20000).alias("clean_text"))
    rows = extract.with_reply(extract.with_prompt(frame), model).select("reply").collect()
    assert len(rows) == 300
    assert max(int(row.reply) for row in rows) < 4_000_000
