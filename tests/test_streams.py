"""Streams over several batches give what one batch gives."""

import json
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from leadspark import fixtures
from leadspark.operators import decide
from leadspark.schemas import ANALYSIS
from leadspark.sources import tables
from leadspark.streaming import alerts, dedup, merge, scoring
from tests.samples import LEAD, envelope, lead

SF = "/root/testdata/sf0.001"


def feed(spark, frame, path, order, parts=4):
    """The frame as a stream of several files, one per batch, in order."""
    part = F.ntile(parts).over(Window.orderBy(order))
    numbered = frame.withColumn("part", part).cache()
    for number in range(1, parts + 1):
        rows = numbered.where(F.col("part") == number).drop("part")
        rows.coalesce(1).write.mode("append").parquet(str(path))
    return tables.file_stream(spark, str(path), frame.schema, maxFilesPerTrigger=1)


def test_review_alerts(spark, tmp_path):
    events = fixtures.review_events_of(fixtures.table(spark, SF, "events"))
    stream = feed(spark, events, tmp_path / "in", "ts")
    out = str(tmp_path / "out")
    alerts.start_review_alerts(stream, out, str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(out).select("batch").distinct().count() > 1
    got = alerts.current_alerts(spark, out).collect()
    assert sorted(got) == sorted(decide.review_alerts(events, "60 seconds").collect())


def test_alert_threshold(spark):
    rows = [("2024-01-01 00:00:10", True), ("2024-01-01 00:00:50", True),
            ("2024-01-01 00:01:00", True), ("2024-01-01 00:01:30", False)]
    events = spark.createDataFrame(rows, "ts string, review_required boolean").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )
    assert [row.n_events for row in decide.review_alerts(events, "60 seconds", 1).collect()] == [2]


def hot_urls(spark):
    ids = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("n"),
        F.timestamp_seconds(F.lit(fixtures.START_SECONDS) + F.col("id") * 60).alias("ts"),
    )
    return ids.select(F.concat(F.lit("u"), "n").alias("article_url"), "ts")


def test_urls_of_many_batches_are_those_of_one(spark, tmp_path):
    """Copies two days apart are found; a third of the feed is one URL."""
    rows = hot_urls(spark)
    stream = feed(spark, rows, tmp_path / "in", "ts", 5)
    path, state = str(tmp_path / "seen"), str(tmp_path / "state")
    dedup.start_new_urls(stream, path, state, together=2).awaitTermination()
    seen = dedup.seen_urls(spark, path)
    got = [tuple(row) for row in seen.rows().collect()]
    first = rows.groupBy("article_url").agg(F.min("ts").alias("ts"))
    assert sorted(got) == sorted(tuple(row) for row in first.collect())
    assert len(got) == 2001
    # The last batch once more: nothing new, nothing lost.
    before = sorted(tuple(row) for row in seen.batch(4).collect())
    assert 0 < len(before) < 600
    seen.add(rows.where(F.col("ts") >= min(row[1] for row in before)), 4)
    assert sorted(tuple(row) for row in seen.batch(4).collect()) == before
    assert seen.rows().count() == 2001


def halves(spark):
    lead_rows = fixtures.leads(spark, SF)
    return fixtures.verified_half(lead_rows), fixtures.controlled_half(lead_rows)


def merger_of(spark, path, verified, controlled, **options):
    feeds = zip(merge.HALVES, (verified, controlled), strict=True)
    types = {name: half.schema[name].dataType for name, half in feeds}
    return merge.HalfMerger(spark, str(path), types=types, **options)


def test_merge_of_halves(spark, tmp_path):
    verified, controlled = halves(spark)
    merger = merger_of(spark, tmp_path / "out", verified, controlled)
    feeds = feed(spark, verified, tmp_path / "v", "ts"), feed(spark, controlled, tmp_path / "c", "ts")
    merge.start_merge(merger, *feeds, str(tmp_path / "state")).awaitTermination()
    merger.finish(merge.last_batch(spark, merger.path))
    expected = decide.merge_partials(
        verified.drop("ts").unionByName(controlled.drop("ts"), allowMissingColumns=True)
    )
    assert sorted(merger.merged.rows().collect()) == sorted(expected.collect())
    assert merger.quarantine().count() == 0


def test_halves_are_worked_out_once(spark, tmp_path):
    verified, controlled = halves(spark)
    worked = spark.sparkContext.accumulator(0)
    same = F.udf(lambda x: worked.add(1) or x, "timestamp").asNondeterministic()
    merger = merger_of(spark, tmp_path / "out", verified, controlled)
    merger.add(merger.halves(verified.withColumn("ts", same("ts")), controlled), 0)
    assert worked.value == verified.count()


LONE = [
    # lead, minute of the verification, minute of the control: None never comes
    (1, 0, 5), (2, 0, None), (3, None, 1), (4, 0, 40), (5, 40, 0), (6, 3, 12), (7, 100, 100), (8, None, 99),
]


def lone_halves(spark):
    """Both feeds, and the batch in which each half arrives: every 20 minutes one."""
    half = {"verification": "struct<confidenceScore:int>", "internal_qc": "struct<qualityScore:int>"}
    made = []
    for (name, kind), at in zip(half.items(), (1, 2), strict=True):
        rows = [(x[0], (x[0],), x[at]) for x in LONE if x[at] is not None]
        frame = spark.createDataFrame(rows, f"lead_id long, {name} {kind}, minute int")
        ts = F.timestamp_seconds(F.lit(fixtures.START_SECONDS) + F.col("minute") * 60)
        made.append(frame.select("lead_id", name, ts.alias("ts"), (F.col("minute") / 20).cast("int").alias("batch")))
    return made


def test_lone_halves_go_to_quarantine(spark, tmp_path):
    verified, controlled = lone_halves(spark)
    merger = merger_of(spark, tmp_path / "out", verified, controlled)

    def batch(n):
        return merger.halves(*(x.where(F.col("batch") == n).drop("batch") for x in (verified, controlled)))

    for number in range(6):
        merger.add(batch(number), number)
        if number == 3:  # run again: the same
            merger.add(batch(number), number)
    # What has waited long enough is out before the end of the stream.
    early = {row.lead_id for row in merger.quarantine().collect()}
    assert early == {2, 3, 4, 5}
    # A copy of a half that was merged long ago.
    again = verified.where("lead_id = 1").drop("batch")
    merger.add(merger.halves(again, controlled.drop("batch").limit(0)), 6)
    merger.finish(6)
    assert {row.lead_id for row in merger.merged.rows().collect()} == {1, 6, 7}
    got = sorted((row.lead_id, row.half, row.reason) for row in merger.quarantine().collect())
    assert got == [
        (1, "verification", merge.REPEATED),
        (2, "verification", merge.LONE), (3, "internal_qc", merge.LONE),
        (4, "internal_qc", merge.LONE), (4, "verification", merge.LONE),
        (5, "internal_qc", merge.LONE), (5, "verification", merge.LONE),
        (8, "internal_qc", merge.LONE),
    ]
    assert merger.waiting(7).count() == 0
    raw = {row.lead_id: row.raw for row in merger.quarantine().collect()}
    assert raw[2] == '{"confidenceScore":2}'


def test_merged_leads_are_looked_up_once_a_batch(spark, tmp_path, monkeypatch):
    """For leads that fit and for lone halves together."""
    half = {"verification": "struct<confidenceScore:int>", "internal_qc": "struct<qualityScore:int>"}

    def feeds(verified, controlled):
        frames = []
        for (name, kind), rows in zip(half.items(), (verified, controlled), strict=True):
            frame = spark.createDataFrame([(k, (m,), m) for k, m in rows], f"lead_id long, {name} {kind}, minute int")
            ts = F.timestamp_seconds(F.lit(fixtures.START_SECONDS) + F.col("minute") * 60)
            frames.append(frame.select("lead_id", name, ts.alias("ts")))
        return frames

    merger = merger_of(spark, tmp_path / "out", *feeds([], []))
    seen, rows = [], merger.merged.rows
    monkeypatch.setattr(merger.merged, "rows", lambda *args: seen.append(args) or rows(*args))
    merger.add(merger.halves(*feeds([(1, 0), (None, 0), (2, 0)], [(1, 1), (None, 1), (2, 30)])), 0)
    assert seen == []
    # Merged leads come again, whole and in part, beside new ones.
    merger.add(merger.halves(*feeds([(1, 2), (3, 2), (None, 2)], [(1, 3), (3, 3), (5, 2)])), 1)
    assert len(seen) == 1
    merger.add(merger.halves(*feeds([(3, 60), (4, 60)], [(4, 60)])), 2)
    merger.finish(2)
    assert len(seen) == 3
    assert sorted(row.lead_id or 0 for row in merger.merged.rows().collect()) == [0, 1, 3, 4]
    got = sorted((row.lead_id or 0, row.half, row.reason) for row in merger.quarantine().collect())
    assert got == [
        (0, "verification", merge.LONE), (2, "internal_qc", merge.LONE), (2, "verification", merge.LONE),
        (3, "verification", merge.REPEATED), (5, "internal_qc", merge.LONE),
    ]


def corpus_of(spark, n):
    records = [lead(sourceURL=f"https://reuters.com/{i}") for i in range(n)]
    return spark.createDataFrame([tuple(r[k] for k in LEAD) for r in records], ANALYSIS)


MESSAGES = [
    (1, envelope(lead(sourceURL="https://reuters.com/1"))),
    (2, envelope(lead(sourceURL="https://reuters.com/new"))),
    (3, envelope(LEAD)),
    (4, envelope(lead(sourceURL="https://my-sensational-blog.net/1"))),
    (5, envelope({"invalid": "format"})),
    (6, "%%%"),
]
PLACES = {
    (1, "final-analysis"), (1, "final-leads"), (2, "final-analysis"), (2, "final-leads"),
    (3, "final-analysis"), (3, "final-leads"), (4, "final-analysis"),
    (5, "quarantine"), (6, "quarantine"),
}


def test_messages_find_their_places(spark):
    frame = spark.createDataFrame(MESSAGES, "msg_id int, data string")
    rows = scoring.routed(frame, "msg_id", corpus=corpus_of(spark, 12)).collect()
    assert {(row.msg_id, row.destination) for row in rows} == PLACES
    assert {row.decision for row in rows if row.msg_id == 4} == {"Rejected"}
    assert len(rows) == len(PLACES)


def test_stream_of_messages(spark, tmp_path):
    frame = spark.createDataFrame(MESSAGES, "msg_id int, data string")
    stream = feed(spark, frame, tmp_path / "in", "msg_id", 3)
    scorer = scoring.LeadScorer(spark, str(tmp_path / "out"), "msg_id", "integer", together=2)
    scorer.know(corpus_of(spark, 12))
    scoring.start_scoring(scorer, stream, str(tmp_path / "state")).awaitTermination()
    rows = scorer.routed().collect()
    assert {(row.msg_id, row.destination) for row in rows} == PLACES
    assert len({row.batch for row in rows}) > 1
    assert {row.msg_id for row in scorer.outbox.rows().collect()} == {1, 2, 3}
    # A batch that is run again, and a message that comes again, send no second alert.
    scorer.add(frame.where("msg_id > 4"), 2)
    assert sorted(scorer.routed().collect()) == sorted(rows)
    scorer.add(frame.where("msg_id < 3"), 3)
    assert sorted(row.msg_id for row in scorer.outbox.rows().collect()) == [1, 2, 3]


def test_evidence_grows_with_the_batches(spark, tmp_path):
    """Each batch sees the evidence of the batches up to its own, and no other buckets."""
    scorer = scoring.LeadScorer(spark, str(tmp_path / "out"), "msg_id", "integer", together=3)
    records = [lead(companyName=f"C{i % 3}", sourceURL=f"https://reuters.com/{i // 2}") for i in range(40)]
    seen = {}
    for number in range(4):
        part = list(enumerate(records))[number * 10 : number * 10 + 10]
        messages = [(i, envelope(x)) for i, x in part] + [(100 + number, "%%%")]
        scorer.add(spark.createDataFrame(messages, "msg_id int, data string"), number)
        for _, x in part:
            seen.setdefault(x["companyName"], set()).add(x["sourceURL"])
        rows = scorer.routed().where(F.col("batch") == number + 1).where("destination <> 'final-leads'").collect()
        got = {r.msg_id: json.loads(r.data)["verification"]["corroboratingSources"] for r in rows if r.reason is None}
        assert got == {i: len(seen[x["companyName"]] - {x["sourceURL"]}) for i, x in part}
        assert {r.msg_id for r in rows if r.reason} == {100 + number}
    leads = spark.createDataFrame([tuple(records[0][k] for k in LEAD)], ANALYSIS)
    plan = scorer.proof_for(leads, 9)._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_leads_do_not_back_themselves(spark, tmp_path):
    """Also where their host was trusted when the evidence was gathered, and no longer is."""
    path, records = str(tmp_path / "out"), [lead(sourceURL=f"https://{x}/1") for x in ("reuters.com", "old.com")]
    articles = spark.createDataFrame([tuple(x[k] for k in LEAD) for x in records], ANALYSIS)
    scoring.LeadScorer(spark, path, "msg_id", "integer", trusted=("reuters.com", "old.com")).know(articles)
    scorer = scoring.LeadScorer(spark, path, "msg_id", "integer", trusted=("reuters.com",))
    records.append(lead(sourceURL="https://reuters.com/2"))
    scorer.add(spark.createDataFrame([(i, envelope(x)) for i, x in enumerate(records)], "msg_id int, data string"), 0)
    rows = scorer.routed().where("destination <> 'final-leads'").collect()
    got = {r.msg_id: json.loads(r.data)["verification"]["corroboratingSources"] for r in rows}
    assert got == {0: 2, 1: 2, 2: 2}


def test_nothing_waits_without_python(spark, tmp_path):
    merger = merge.HalfMerger(spark, str(tmp_path))
    assert merger.waiting(-1).schema == merger.state
    assert merger.waiting(-1).count() == 0
    assert "RDD" not in merger.waiting(-1)._jdf.queryExecution().executedPlan().toString()


def test_stage_names():
    assert tables.stage_path("/x", "final-leads") == "/x/final-leads"
    with pytest.raises(ValueError):
        tables.stage_path("/x", f"no-{uuid.uuid4()}")
