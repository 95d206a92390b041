"""Pages as a stream: files in, parsed pages out, and windowed counts with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def box_stream(spark: SparkSession, folder: str, schema: str, batch_files: int = 16) -> DataFrame:
    """Detections written as Parquet files, ``batch_files`` a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", batch_files).parquet(folder)


def parse_stream(pages: DataFrame, parse: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch transform to each micro-batch; pages are complete within a file, so within a batch.

    A batch's result is written to a folder of its number, so a repeated batch replaces itself.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        parse(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return pages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts of a key in tumbling windows; events later than ``late`` behind the newest are dropped by the watermark."""
    counted = events.withWatermark(time, late).groupBy(F.window(time, window), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("start"), key, "n")
