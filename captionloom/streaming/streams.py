"""Structured Streaming forms of a few operators. Batch and stream share their expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_new_files(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def unseen(events: DataFrame, ident: str, time: str, delay: str) -> DataFrame:
    """Each id once, as long as its repeats come within the delay; state older than that is dropped."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([ident])


def bucket_counts(events: DataFrame, time: str, delay: str = "1 minute", size: str = "30 seconds") -> DataFrame:
    """Events and their summed value by tumbling bucket and type."""
    rows = events.withWatermark(time, delay).groupBy(F.window(time, size), "event_type")
    return rows.agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value")).select("window.start", "event_type", "events", "value")


def islands(events: DataFrame, key: str, time: str, gap: str = "1 minute", delay: str = "1 minute") -> DataFrame:
    """Sessions of a key, closed by a pause of the given length."""
    rows = events.withWatermark(time, delay).groupBy(key, F.session_window(time, gap))
    return rows.agg(F.count(F.lit(1)).alias("events")).select(key, "session_window.start", "session_window.end", "events")


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Works off what is there, batch by batch, and stops; the checkpoint lets the next run go on from there."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
