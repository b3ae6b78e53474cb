"""Streams over call and revision records; each function works on a stream or on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def windowed_stages(events: DataFrame, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Calls, total and largest latency by stage and window; records later than the watermark are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if timed.isStreaming else timed
    out = timed.groupBy(F.window("ts", window).alias("w"), F.col("event_type").alias("stage")).agg(F.count("*").alias("calls"), F.sum("value").alias("total"), F.max("value").alias("largest"))
    return out.select(F.col("w.start").alias("window_start"), "stage", "calls", "total", "largest")


def latest_revisions(revisions: DataFrame) -> DataFrame:
    """The text of the highest revision of each section, as updates arrive."""
    return revisions.groupBy("doc_id", "section").agg(F.max("revision").alias("revision"), F.max_by("text", "revision").alias("text"))


def append_history(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run history as a file sink in append mode: exactly once, also over restarts."""
    return records.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
