import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone string, _u string, words int"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    passage = "\n".join(f"shared line number {i} of a passage that comes twice" for i in range(5))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 10),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 10),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a", 10),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, " \t\n \r\n", "en", "b", 6),
        (None, "no id here, but mail me at a.b@c.example or +1 (555) 123-4567 please", "en", "b", 3),
        (7, long, "en", "b", len(long)),
        (8, f"start of one\n{passage}\nend of one", "en", "a", 1),
        (9, f"another start\n\n{passage}\n\nanother end", "en", "a", 1),
        (10, "x\nx\nx\nx\nx\nx\nx", "en", "a", 1),
        (11, "É À ÜBER straße 10.0.0.255 4111 1111 1111 1111 Zz@q.r", "de", "c", 1),
        (12, "one", "en", "c", 1),
        (13, "one two", "en", "c", 1),
    ]
    frame = spark.createDataFrame([(*row, "g", "u", 7) for row in rows], SCHEMA)
    return frame.repartition(3, F.coalesce("doc_id", F.lit(0)))


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def given(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
