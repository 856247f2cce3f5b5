"""Input columns named as working or result columns; rows under one id; tables left behind."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from leadspark.llm import html_text, line_dedup, mixing, packing, quality_rules, simhash, toxicity
from leadspark.llm.shared import Workspace

NAMES = (
    "_row _gone _mark ord idx line h g w x _of text_hash fp root key _w _l _n _first "
    "_source _upto _part _parts _rank _nth _before _length _from _until _sequence _each _at cut d r"
).split()
RESULTS = "n_deleted copies copy_no shuffle_key n_words rule kept base_failed severity sequence_id offset".split()


@pytest.fixture(scope="module")
def clashing(docs):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return plain.withColumns({name: F.lit(f"is {name}") for name in (*NAMES, *RESULTS)})


def kept(frame, rows=None):
    """Every clashing column has its value in every row."""
    assert len({name.lower() for name in frame.columns}) == len(frame.columns)
    for row in frame.select(*NAMES).distinct().collect():
        assert row.asDict() == {name: f"is {name}" for name in NAMES}
    assert rows is None or frame.count() == rows


def test_line_dedup(clashing):
    kept(line_dedup.deduplicate(clashing), clashing.count())
    upper = clashing.select("doc_id", "text", F.lit("a").alias("_ROW"), F.lit("b").alias("_Gone"))
    assert line_dedup.deduplicate(upper).columns == [*upper.columns, "n_deleted"]


def test_keep_one(clashing):
    found = simhash.keep_one(clashing)
    assert found.columns == clashing.columns
    kept(found)


def test_quality(clashing, given):
    judged = quality_rules.judge(clashing, given("labels"))
    kept(judged, clashing.count())
    assert dict(judged.dtypes)["n_words"] == "bigint" and dict(judged.dtypes)["kept"] == "boolean"


def test_mixing(clashing):
    kept(mixing.mix(clashing, share=2.0))


def test_packing(clashing):
    pieces = clashing.withColumn("length", F.coalesce(F.length("text"), F.lit(0)).cast("long") % 50 + 1)
    placed = packing.pack(pieces, size=64)
    kept(placed, clashing.count())
    assert dict(placed.dtypes)["sequence_id"] == dict(placed.dtypes)["offset"] == "bigint"


def test_scores_and_pages(clashing):
    kept(toxicity.with_severity(clashing, toxicity.Model({"one": 1.0}, [0.0])), clashing.count())
    pages = clashing.withColumn("html", F.lit("<p>one two three"))
    texts = html_text.with_text(pages, html_text.Weights())
    kept(texts, clashing.count())
    assert {r["text"] for r in texts.select("text").collect()} == {"one two three"}


def test_pieces_without_ids_are_ranked_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 10)
    pieces = spark.range(0, 2000, 1, 4).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(5).cast("long").alias("length")
    )
    placed = packing.pack(pieces, size=64).collect()
    places = {(r["sequence_id"], r["offset"]) for r in placed}
    assert len(places) == 2000 and {at for _, at in places} <= set(range(0, 60, 5))
    assert len({s for s, _ in places}) == -(-2000 // 12)
    plan = packing.pack(pieces, size=64)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(_row" in plan


def test_samples_take_a_document_once(spark):
    rows = [(1, "bad words here")] * 500 + [(2, "good words"), (2, "other words"), (3, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (None, 1)], "doc_id long, grade int")
    found = toxicity.sample(docs, labels).collect()
    assert sorted((r["key"], r["grade"]) for r in found) == [(1, 1), (2, 0), (3, 0)]
    quality = labels.select("doc_id", F.col("grade").alias("quality"))
    assert quality_rules.fit(docs, quality) == []


def test_quality_counts_the_sample_once(spark, docs, given, capsys):
    quality_rules.with_statistics(docs).select("doc_id", *quality_rules.COUNTS).explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("split(") <= 2


def test_tables_behind_a_result(spark):
    work = Workspace(spark, "left")
    work.keep()  # nothing is there
    for name in ("a", "b", "c"):
        work.store(spark.range(2), name)
    work.keep("b")
    assert [x.name for x in Path(work.base.removeprefix("file:")).iterdir() if not x.name.startswith(".")] == ["b"]
