"""Human review, alerts and reports."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from leadspark import schemas
from leadspark.operators import decide, deliver, review
from leadspark.plans.lead_scoring import score_leads
from leadspark.sources import tables
from leadspark.streaming.scoring import outbox_table
from tests.samples import LEAD, lead

FORM = "companyName string, potentialNeed array<string>, opportunityScore int"


def test_pending_items(spark):
    queue = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "id string, name string")
    given = [("a",), ("a",), ("zzz",), (None,)]
    corrections = spark.createDataFrame(given, "id string")
    waiting = review.pending(queue, corrections)
    assert sorted(row.id for row in waiting.collect()) == ["b", "c"]
    assert tuple(review.queue_count(waiting).first()) == (2, False)
    assert tuple(review.queue_count(queue.where("false")).first()) == (0, True)


def test_own_id_wins(spark):
    items = spark.createDataFrame(
        [("key-1", "test-id-1", "TestCo"), ("key-2", None, "Other")],
        "store_key string, document_id string, companyName string",
    )
    rows = review.with_own_id(items, "store_key", "document_id").select("id", "companyName")
    assert [tuple(row) for row in rows.collect()] == [("test-id-1", "TestCo"), ("key-2", "Other")]


def test_ids_repeat(spark):
    rows = spark.createDataFrame([(1,), (2,)], "lead_id long")
    first, second = (review.queue_items(rows, "lead_id").collect() for _ in range(2))
    assert first == second
    assert len({row.id for row in first}) == 2


def test_form_view(spark):
    names = [name for name in review.FORM_TEXTS if name != "companyName"]
    empty = [F.lit(None).cast("string").alias(name) for name in names]
    rows = spark.createDataFrame(
        [(None, None, None), ("", ["a", None, "b"], 4)], FORM
    ).select("*", *empty)
    shown = review.form_view(rows).select(
        "title", "companyName", "potentialNeed", "opportunityScore", "summary"
    )
    assert [tuple(row) for row in shown.collect()] == [
        ("No Company Name", "", "", 0, ""),
        ("No Company Name", "", "a\n\nb", 4, ""),
    ]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("7", 7),
        ("7abc", 7),
        ("  -3.9", -3),
        ("+5", 5),
        ("0x1F", 31),
        ("-0x10", -16),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_leading_integer(one, text, number):
    assert one(review.leading_integer(F.col("x")), row=(text,)) == number


def actions(spark, rows):
    frame = spark.createDataFrame(
        rows, "id string, action string, potentialNeed string, opportunityScore string"
    )
    return review.normalised_actions(
        frame.select("*", *[F.lit("text").alias(name) for name in review.FORM_TEXTS])
    )


def test_actions(spark):
    rows = [
        ("a", "approve", "x\n\ny\n", "8"),
        ("b", "update", "", "7abc"),
        ("c", "decline", "x", "8"),
    ]
    got = actions(spark, rows).select(
        "id", "status", "corrected", "potentialNeed", "opportunityScore", "summary"
    )
    assert [tuple(row) for row in got.collect()] == [
        ("a", "approved", None, ["x", "y"], 8, "text"),
        ("b", "approved", True, [], 7, "text"),
        ("c", "declined", None, None, None, None),
    ]


def test_tuning_rows_use_the_last_answer(spark):
    fields = "companyName string, region string, opportunityScore int"
    queue = spark.createDataFrame(
        [("a", "A", "North", 5), ("b", "B", "South", 6), ("c", "C", "West", 7)],
        f"id string, {fields}",
    )
    at = datetime.datetime(2024, 1, 1)
    later = at + datetime.timedelta(minutes=1)
    corrections = spark.createDataFrame(
        [
            ("a", "approved", "A", "East", 5, later),
            ("a", "declined", None, None, None, at),
            ("b", "declined", None, None, None, at),
            ("zzz", "approved", "Z", "East", 5, at),
        ],
        f"id string, status string, {fields}, submitted_at timestamp",
    )
    rows = {row.id: row for row in review.tuning_rows(queue, corrections).collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"].label, rows["a"].changedFields) == (1, ["region"])
    assert (rows["b"].label, rows["b"].changedFields) == (0, [])


def scored(spark, *records):
    frame = spark.createDataFrame([tuple(r[n] for n in LEAD) for r in records], schemas.ANALYSIS)
    return score_leads(frame, as_of="2024-03-05T00:00:00.000Z", sources=F.lit(12))


def test_alert(spark):
    record = lead(companyName="TestCo", potentialNeed=["More tests", None, "Better coverage"])
    payload = json.loads(deliver.alerts(scored(spark, record)).first().payload)
    assert payload["text"] == "🔥 New Opportunity Hunted: TestCo"
    blocks = payload["blocks"]
    assert [block["type"] for block in blocks] == [
        "header", "section", "section", "section", "context",
    ]
    assert blocks[0]["text"] == {"type": "plain_text", "text": "🚀 TestCo"}
    assert set(blocks[1]) == {"type", "fields"} and len(blocks[1]["fields"]) == 2
    assert blocks[3]["text"]["text"] == (
        "*Potential Needs:*\n• More tests\n• \n• Better coverage"
    )
    assert set(blocks[4]) == {"type", "elements"}
    assert blocks[4]["elements"][1]["text"] == " | Confidence: *103%*"


def test_alerts_that_cannot_be_told(spark):
    frame = scored(spark, lead(potentialNeed=None), LEAD)
    assert deliver.alerts(frame).count() == 1
    assert [row.reason for row in deliver.undeliverable(frame).collect()] == [
        "potentialNeed:required"
    ]


def test_one_alert_per_lead(spark, tmp_path):
    outbox = outbox_table(spark, str(tmp_path / "outbox"), "lead_id", "long")
    schema = "lead_id long, payload string"
    outbox.add(spark.createDataFrame([(1, "a")], schema), 0)
    second = spark.createDataFrame([(1, "later"), (2, "c"), (2, "b")], schema)
    for _ in range(2):  # a batch that is run again adds nothing
        assert [tuple(row) for row in outbox.add(second, 1).collect()] == [(2, "b")]
    assert sorted(tuple(row) for row in outbox.rows().collect()) == [(1, "a"), (2, "b")]


def test_review_log(spark):
    frame = scored(spark, lead(sourceURL="https://my-sensational-blog.net/1"), LEAD)
    event = decide.review_log(frame).first().event
    assert json.loads(event) == {
        "review_required": True,
        "companyName": LEAD["companyName"],
        "summary": LEAD["summary"],
    }


def test_warehouse_round_trip(spark, tmp_path):
    final = scored(spark, LEAD, lead(sourceURL="https://reuters.com/1"))
    path = str(tmp_path / "final")
    tables.append_warehouse(final, path)
    tables.append_warehouse(final, path)
    stored = spark.read.parquet(path)
    assert {str(row.decision_date) for row in stored.collect()} == {"2024-03-05"}
    typed = tables.typed_warehouse(stored, schemas.FINAL_ANALYSIS)
    assert sorted(typed.distinct().collect()) == sorted(final.collect())
    assert typed.count() == 4


def test_reports(spark):
    final = scored(spark, LEAD, lead(region="Nordic", opportunityScore=4), lead(opportunityScore=8))
    assert deliver.lead_report(final).columns == [
        "companyName", "summary", "sourceURL", "opportunityScore",
    ]
    rows = {row.region: tuple(row)[1:] for row in deliver.region_scores(final).collect()}
    assert rows == {"Baltic": (2, 17, 8.5), "Nordic": (1, 4, 4.0)}
