"""Registered queries on training data: each runs, and those with SQL give its rows."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from leadspark.llm.queries import ORACLES, QUERIES
from scripts.check import TABLES, compare

from test_repair import plain_report  # noqa: I001
from test_spelling import plain_variants, plain_words

SF = "/root/testdata/sf0.001"


def test_entry_has_them():
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    if name in ORACLES:
        database = duckdb.connect()
        for table in TABLES:
            database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        verdict, _ = compare(spark, database, QUERIES[name], ORACLES[name], SF)
        assert verdict.startswith("ok"), verdict
    else:
        frame = QUERIES[name](spark, SF)
        assert frame.count() > 0
        assert len(set(frame.columns)) == len(frame.columns)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_query(spark, given):
    talks = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    for row in sorted(given("conversations").collect()):
        talks.setdefault(row["conv_id"], []).append((row["role"], row["text"] or ""))
    got = {r["conv_id"]: r for r in QUERIES["op11_chat"](spark, SF).collect()}
    assert got.keys() == talks.keys()
    for conv, turns in talks.items():
        trained = "".join(x for r, x in turns if r == "assistant")
        told = "".join(f"{r}\n{x}\n" for r, x in turns)
        row = got[conv]
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), sha(told))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(trained), sha(trained))
        assert row["formatted_chars"] >= len(told)


def test_repair_query(spark, given):
    rows = [tuple(r) for r in given("conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op12_repair"](spark, SF).collect()}
    assert got == plain_report(rows)


def test_spelling_query(spark, given):
    rows = [tuple(r) for r in given("documents").select("doc_id", "text").collect()]
    got = {tuple(r) for r in QUERIES["op13_spelling"](spark, SF).collect()}
    assert got == plain_variants(plain_words(rows))
