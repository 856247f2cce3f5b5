"""Every registered query beside its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from leadspark.oracles import ORACLES
from leadspark.queries import QUERIES
from scripts.check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    """Those on training data are tested in a folder of their own."""
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, database, name):
    verdict, _ = compare(spark, database, QUERIES[name], ORACLES[name], SF)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert {row.decision for row in entry.entry(spark).select("decision").distinct().collect()} == {
        "Approved", "Manual Review", "Rejected",
    }
