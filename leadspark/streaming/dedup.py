"""Each URL of a feed once, however far apart its copies come."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leadspark.sources.keyed import KeyedTable

SEEN = StructType().add("article_url", "string").add("ts", "timestamp")


def seen_urls(spark: SparkSession, path: str) -> KeyedTable:
    """The URLs seen so far, with the time of their first copy in the batch they came in."""
    return KeyedTable(spark, path, SEEN, ["article_url"])


def start_new_urls(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    url: str = "article_url",
    ts: str = "ts",
    together: int = 64,
) -> StreamingQuery:
    """Add the URLs of a feed to those seen; `seen_urls(...).batch(n)` has the new ones of a
    batch. After each `together` batches the table is put together.

    Copies are folded in each task before they meet, so that a URL that fills much of the
    feed is one row for each task.
    """
    narrow = feed.select(F.col(url).alias("article_url"), F.col(ts).alias("ts"))
    seen = seen_urls(feed.sparkSession, path)

    def add(batch: DataFrame, number: int) -> None:
        seen.add(batch, number)
        if number % together == together - 1:
            seen.compact(number)

    return (
        narrow.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
