"""Streaming counterparts of batch operators (an extension: the batch semantics stay the same).

State is bounded by watermarks; sinks write idempotently by batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_jsonl(spark: SparkSession, folder: str, schema: StructType, per_batch: int = 100) -> DataFrame:
    """New JSON-lines files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).json(folder)


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """(start, key, n) per tumbling window; rows later than ``late`` are dropped."""
    return (
        events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
    )


def sessions(events: DataFrame, time: str, key: str, gap: str = "5 minutes", late: str = "30 minutes") -> DataFrame:
    """(key, start, end, n) of sessions that a pause of ``gap`` ends."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.session_window(time, gap), key)
        .agg(F.count("*").alias("n"))
        .select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
    )


def first_seen(events: DataFrame, time: str, key: str, late: str = "1 hour") -> DataFrame:
    """Rows whose key has not been seen within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def append_batches(stream: DataFrame, path: str, checkpoint: str):
    """Write each micro-batch to a folder of its own, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
