"""Streams: files that arrive are turned into rows once, and bursts become sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def process_files(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame]) -> None:
    """Transform the files that are new since the last call and append them to the target; the checkpoint remembers."""
    rows = transform(spark.readStream.schema(schema).json(source))
    query = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def sessions(events: DataFrame, key: str, time: str, gap: str = "20 seconds", late: str = "10 minutes") -> DataFrame:
    """Sessions of a key that a gap of silence ends, for streams and tables; rows later than `late` are dropped by streams."""
    counted = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return counted.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
