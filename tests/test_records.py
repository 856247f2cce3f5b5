"""Envelopes, strict JSON and the rules at the borders."""

import json

import pytest
from pyspark.sql import functions as F

from leadspark import schemas
from leadspark.functions import checks, envelope
from leadspark.operators import extract, validate
from leadspark.schemas import ANALYSIS
from tests.samples import ARTICLE, LEAD, lead
from tests.samples import envelope as wrapped


def first_error(spark, record, expected):
    text = record if isinstance(record, str) else json.dumps(record)
    bodies = validate.parse(spark.createDataFrame([(text,)], "text string"))
    return validate.check(bodies, expected).first().first_error


@pytest.mark.parametrize(
    ("text", "good"),
    [
        ('{"a":1}', True),
        (' \n{"a":1}\t', True),
        ("3", True),
        ("null", True),
        ('"x"', True),
        ("[1,2]", True),
        ("", False),
        (" ", False),
        ("{'a':1}", False),
        ('{"a":1} xyz', False),
        ('{"a":1},', False),
        ("1,2", False),
        ("1],[2", False),
        ('1},{"v":2', False),
        ('1, "v":2', False),
        ("invalid json", False),
        ("NaN", False),
        ('```json\n{"a":1}\n```', False),
        ('1,"#end-of-record#"] x', False),
        ('{"a":"#end-of-record#"}', True),
        ('{"a":"#end-of-record#"} x', False),
        ('1,"\\u0023end-of-record#"],', False),
        ('1,"\\u0023end-of-record#"] x', False),
        ('{"a":"\\u0023"}', True),
    ],
)
def test_json_is_strict(one, text, good):
    assert one(envelope.strict_json(F.col("x")).isNotNull(), row=(text,)) is good


def test_json_is_parsed_once(spark):
    frame = spark.createDataFrame([("e30=",)], "data string")
    checked = validate.check(validate.decode(frame), checks.ANALYSIS)
    for part in (validate.accepted(checked, ANALYSIS), validate.quarantined(checked, "stage")):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parse_json") + plan.count("parseJson") == 1, plan


def test_repeated_key_keeps_the_last(one):
    value = F.try_variant_get(envelope.strict_json(F.col("x")), "$.a", "int")
    assert one(value, row=('{"a":1,"a":2}',)) == 2


@pytest.mark.parametrize(
    ("data", "text"),
    [
        ("YWJj", "abc"),
        ("YWI=", "ab"),
        ("YWI", "ab"),
        ("YW Jj", "abc"),
        ("fn5-fn5_", "~~~~~\x7f"),
        ("/w==", "�"),
        ("", ""),
    ],
)
def test_lenient_base64(one, data, text):
    assert one(envelope.decoded_text(F.col("x")), row=(data,)) == text


def test_envelope_that_is_not_json(spark):
    rows = [(wrapped("this is not json"),), ("%%%",), (wrapped(LEAD),), (None,)]
    decoded = validate.decode(spark.createDataFrame(rows, "data string"))
    assert [row.rejected for row in decoded.collect()] == [
        "not_json", "not_base64", None, "not_base64",
    ]


@pytest.mark.parametrize(
    ("record", "error"),
    [
        (LEAD, None),
        (lead(potentialNeed=[]), None),
        (lead(opportunityScore="9"), None),
        (lead(opportunityScore=9.0), None),
        (lead(sourceURL="mailto:desk@example.com"), None),
        ({"invalid": "format"}, "companyName:required"),
        (lead(region=...), "region:required"),
        (lead(region=None), "region:string"),
        (lead(region=5), "region:string"),
        (lead(region=""), "region:empty"),
        (lead(potentialNeed="Cranes"), "potentialNeed:array"),
        (lead(potentialNeed=None), "potentialNeed:array"),
        (lead(potentialNeed=["Cranes", None]), "potentialNeed:items"),
        (lead(potentialNeed=[None]), "potentialNeed:items"),
        (lead(potentialNeed=["Cranes", ""]), "potentialNeed:items"),
        (lead(potentialNeed=["Cranes", 5]), "potentialNeed:items"),
        (lead(potentialNeed=[5]), "potentialNeed:items"),
        (lead(opportunityScore=0), "opportunityScore:min"),
        (lead(opportunityScore=11), "opportunityScore:max"),
        (lead(opportunityScore=7.5), "opportunityScore:integer"),
        (lead(opportunityScore="nine"), "opportunityScore:number"),
        (lead(opportunityScore=True), "opportunityScore:number"),
        (lead(opportunityScore=None), "opportunityScore:number"),
        (lead(sourceURL="example.com/news"), "sourceURL:uri"),
        (lead(sourceURL="https://example.com/a b"), "sourceURL:uri"),
        (lead(note="extra"), "note:unknown"),
        (lead(note=None), "note:unknown"),
        ([LEAD], "record:object"),
        ("null", "record:object"),
        ("{", "not_json"),
    ],
)
def test_analysis_rules(spark, record, error):
    assert first_error(spark, record, checks.ANALYSIS) == error


@pytest.mark.parametrize(
    ("record", "error"),
    [
        (ARTICLE, None),
        ({"invalid": "format"}, "clean_text:required"),
        (ARTICLE | {"clean_text": ""}, "clean_text:empty"),
        (ARTICLE | {"source_url": "no uri"}, "source_url:uri"),
        (ARTICLE | {"lang": "en"}, "lang:unknown"),
    ],
)
def test_article_rules(spark, record, error):
    assert first_error(spark, record, checks.ARTICLE) == error


@pytest.mark.parametrize(
    ("extra", "error"),
    [
        ({"verification": {}, "internal_qc": {"a": [1]}}, None),
        ({"verification": {}}, "internal_qc:required"),
        ({"verification": [], "internal_qc": {}}, "verification:object"),
        ({"verification": None, "internal_qc": {}}, "verification:object"),
        ({"verification": {}, "internal_qc": {}, "id": 1}, "id:unknown"),
    ],
)
def test_enriched_rules(spark, extra, error):
    assert first_error(spark, LEAD | extra, checks.ENRICHED) == error


@pytest.mark.parametrize(
    ("record", "good"),
    [
        ({"id": "a", "companyName": "X"}, True),
        ({"id": 7}, True),
        ({"id": True}, True),
        ({"id": []}, True),
        ({"companyName": "X"}, False),
        ({"id": None}, False),
        ({"id": ""}, False),
        ({"id": 0}, False),
        ({"id": 0.0}, False),
        ({"id": False}, False),
    ],
)
def test_correction_needs_an_id(spark, record, good):
    assert first_error(spark, record, checks.CORRECTION) == (None if good else "id:required")


def test_good_and_bad_part_ways(spark):
    rows = [(1, wrapped(LEAD)), (2, wrapped({"invalid": "format"})), (3, "%%%")]
    messages = spark.createDataFrame(rows, "id int, data string")
    checked = validate.check(validate.decode(messages), checks.ANALYSIS)
    good = validate.accepted(checked, schemas.ANALYSIS, "id").collect()
    assert [row.asDict() for row in good] == [{"id": 1} | LEAD]
    bad = validate.quarantined(checked, "internal-qc", "text", "id").collect()
    assert [(row.id, row.stage, row.reason) for row in bad] == [
        (2, "internal-qc", "companyName:required"),
        (3, "internal-qc", "not_base64"),
    ]


def reply(text):
    return json.dumps({"candidates": [{"content": {"parts": [{"text": text}]}}]})


def test_replies(spark):
    texts = [reply(json.dumps(LEAD)), reply("invalid json"), "{}", reply(json.dumps([LEAD]))]
    frame = spark.createDataFrame([(text,) for text in texts], "reply string")
    assert [row.first_error for row in extract.checked_reply(frame).collect()] == [
        None, "not_json", "no_text", "record:object",
    ]


def test_model_runs_on_batches_and_keeps_columns(spark):
    rows = [(7, "Acme plans an expansion. More.", "https://example.com/a", "example.com")]
    frame = spark.createDataFrame(
        rows, "page_id int, clean_text string, source_url string, source_domain string"
    )
    replies = extract.with_reply(extract.with_prompt(frame), extract.field_model)
    checked = extract.checked_reply(replies)
    row = validate.accepted(checked, schemas.ANALYSIS, "page_id").first()
    assert (row.page_id, row.companyName, row.opportunityType) == (7, "Acme", "Expansion")
