"""Tables that keep one row for each key."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadspark.sources import keyed as keyed_tables
from leadspark.sources.keyed import KeyedTable

SCHEMA = StructType().add("k", "string").add("n", "long").add("v", "string")


@pytest.fixture
def keyed(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, ["k"], buckets=8)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(table):
    return sorted((tuple(row) for row in table.collect()), key=str)


def test_batches_add_up_to_the_first_row_of_each_key(spark, keyed):
    random.seed(1)
    batches = [
        [(random.choice([None, "", "a", "b"]) if i % 9 == 0 else f"k{random.randint(0, 80)}", i, "x") for i in range(60)]
        for _ in range(5)
    ]
    known = {}
    for number, batch in enumerate(batches):
        fresh = {}
        for k, n, v in batch:
            if k not in known:
                fresh[k] = min(fresh.get(k, (n, v)), (n, v))
        known |= fresh
        got = keyed.add(frame(spark, batch), number)
        assert rows_of(got) == sorted(((k, *x) for k, x in fresh.items()), key=str)
    want = sorted(((k, *x) for k, x in known.items()), key=str)
    assert rows_of(keyed.rows()) == want
    # A batch that is run again changes nothing, nor does it see what came later.
    for number in (4, 2, 0):
        before = rows_of(keyed.batch(number))
        assert rows_of(keyed.add(frame(spark, batches[number]), number)) == before
    assert rows_of(keyed.rows()) == want
    keyed.compact(2)
    assert rows_of(keyed.rows()) == want
    assert rows_of(keyed.add(frame(spark, batches[4]), 4)) == rows_of(keyed.batch(4))
    keyed.compact(4)
    assert rows_of(keyed.rows()) == want
    assert keyed._folders() == {"b": [3, 4], "w": [2, 4]} or sorted(keyed._folders()["w"]) == [2, 4]
    keyed.add(frame(spark, [("new", 1, "y"), ("k1", 1, "y")]), 5)
    assert ("new", 1, "y") in rows_of(keyed.rows())


def test_empty_batches(spark, keyed):
    assert keyed.rows().count() == 0
    keyed.add(frame(spark, []), 0)
    assert keyed.rows().count() == 0
    keyed.compact(0)
    keyed.add(frame(spark, [("a", 1, None)]), 1)
    assert rows_of(keyed.rows()) == [("a", 1, None)]


def test_only_the_buckets_of_a_batch_are_read(spark, keyed):
    keyed.add(frame(spark, [(f"k{i}", i, "x") for i in range(100)]), 0)
    one = keyed.buckets_of(frame(spark, [("k7", 0, "")]))
    assert len(one) == 1
    some = keyed.rows(buckets=one)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    files = {row[0] for row in some.select(F.input_file_name()).collect()}
    assert len(files) == 1
    assert 0 < some.count() < 100
    assert "k7" in {row.k for row in some.collect()}


def test_rows_with_new_keys_only_are_not_joined(spark, keyed):
    keyed.add(frame(spark, [("a", 1, "x")]), 0)
    new, some = frame(spark, [("b", 2, "x"), (None, 3, "x")]), frame(spark, [("a", 2, "x"), ("b", 2, "x")])
    assert "Join" not in keyed._without_known(new, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(keyed._without_known(some, 1)) == [("b", 2, "x")]


def test_known_rows_are_looked_up_once(spark, keyed):
    """Rows meet the keys found again, and not once more all keys that are known."""
    assert keyed.known(frame(spark, [("a", 1, "x")]), 0) is None
    keyed.add(frame(spark, [("a", 1, "x"), (None, 1, "x"), ("c", 1, "x")]), 0)
    some = frame(spark, [("a", 2, "x"), ("b", 2, "x"), (None, 2, "x")])
    known = keyed.known(some, 1).persist()
    assert {row.k for row in known.collect()} == {"a", None}
    new = keyed._without_known(some, 1, known)
    assert new.inputFiles() == []
    assert rows_of(new) == [("b", 2, "x")]
    known.unpersist()


def test_known_keys_are_not_broadcast_by_a_guess(spark, keyed, monkeypatch):
    """Packed files look small: millions of keys would go through the memory of the driver."""
    def plan(table):
        return table._jdf.queryExecution().executedPlan().toString()

    keyed.add(frame(spark, [("a", 1, "x"), (None, 1, "x"), ("c", 1, "x")]), 0)
    some = frame(spark, [("a", 2, "x"), ("b", 2, "x"), (None, 2, "x")])
    known = keyed.known(some, 1)
    assert "SortMergeJoin" in plan(known) and "Broadcast" not in plan(known)
    assert {row.k for row in known.collect()} == {"a", None}
    # Those found again are counted first.
    for most, join in ((100, "BroadcastHashJoin"), (1, "SortMergeJoin")):
        monkeypatch.setattr(keyed_tables, "BROADCAST_ROWS", most)
        new = keyed._without_known(some, 1, known.persist())
        assert plan(new).split("InMemory")[0].count(join) >= 1
        assert rows_of(new) == [("b", 2, "x")]
        known.unpersist()


def test_unfinished_batches_are_not_seen(spark, keyed, tmp_path):
    keyed.add(frame(spark, [("a", 1, "x")]), 0)
    (tmp_path / "table" / "part=b1" / "bucket=0").mkdir(parents=True)
    assert rows_of(keyed.rows()) == [("a", 1, "x")]
