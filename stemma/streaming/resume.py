"""Incremental work: a log that is only ever appended to, read as a stream, and what it leaves to do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stemma.sources import schemas


def log_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New lines of a JSON log as they are appended; ``fetched_at`` as a timestamp."""
    lines = spark.readStream.schema(schemas.FETCH_LOG).json(folder)
    return lines.withColumn("at", F.col("fetched_at").try_cast("timestamp"))


def first_entries(log: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first entry of each page; the state of pages older than the delay is dropped."""
    return log.withWatermark("at", delay).dropDuplicatesWithinWatermark(["page_id"])


def status_counts(log: DataFrame, window: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Requests by window and status."""
    return log.withWatermark("at", delay).groupBy(F.window("at", window), "status").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


def append_new(stream: DataFrame, target: str, checkpoint: str, key: str, label: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Label the first row of each key and append it to the target table, batch by batch.

    The keys seen are the stream's state, kept in the checkpoint and not read from the target, so a batch costs its own rows.
    A batch replaces its own folder of the target, so one that is repeated after a failure adds nothing. The target belongs
    to one checkpoint.
    """

    def batch(rows: DataFrame, number: int) -> None:
        label(rows).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    return stream.dropDuplicates([key]).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_json_log(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append rows to a JSON log."""
    return stream.writeStream.format("json").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
