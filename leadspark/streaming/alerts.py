"""Count review events per window while they come in."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadspark.config import REVIEW_WINDOW
from leadspark.operators.decide import review_alerts
from leadspark.sources.tables import write_batch


def start_review_alerts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window: str = REVIEW_WINDOW,
    delay: str = "10 minutes",
    threshold: int = 0,
) -> StreamingQuery:
    """Write the windows that changed with every batch, the last open one included."""
    counts = review_alerts(events.withWatermark("ts", delay), window, threshold)
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda rows, batch_id: write_batch(rows, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of each window."""
    written = spark.read.parquet(path)
    return written.groupBy("window_start").agg(
        F.max_by("n_events", "batch").alias("n_events")
    )
