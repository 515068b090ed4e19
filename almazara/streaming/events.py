"""Windowed aggregates that run on tables and on streams (beyond the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tumbling(df: DataFrame, ts: str, width: str, keys: list[str], value: str, late: str = "1 hour") -> DataFrame:
    """(window_start, keys, n, total) of tumbling windows; on a stream, rows later than ``late`` are dropped."""
    rows = df.withWatermark(ts, late) if df.isStreaming else df
    out = rows.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sessions(df: DataFrame, ts: str, gap: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """(keys, session_start, session_end, n): runs of rows of a key less than ``gap`` apart."""
    rows = df.withWatermark(ts, late) if df.isStreaming else df
    out = rows.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def first_seen(df: DataFrame, ts: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Rows whose key was not seen within the watermark."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def run_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write what a stream has, once, to Parquet; the checkpoint lets the next run go on from there."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()


def read_new_files(spark: SparkSession, path: str, schema: str, max_files: int = 1000) -> DataFrame:
    """Stream of the Parquet files of a folder, in bounded batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
