"""Structured Streaming over the landing zone and over event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_files(spark: SparkSession, root: str, source: str, dataset: str, suffix: str = "*.json", max_files: int = 1000) -> DataFrame:
    """New bodies of a dataset as they land, whole, with path and content."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = reader.option("pathGlobFilter", suffix).option("maxFilesPerTrigger", max_files).load(f"{root}/{source}/{dataset}/*/*/*")
    return files.filter(~F.col("path").endswith(".meta.json")).select("path", "content")


def stream_table(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("pathGlobFilter", "*.parquet").parquet(path)


def dedup_late(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key within a delay; state older than the watermark is forgotten."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(df: DataFrame, time: str, delay: str, length: str, slide: str | None = None, by: str | None = None) -> DataFrame:
    """Counts and sums over event-time windows; late rows beyond the delay don't count."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    keys = [window.alias("w"), *([F.col(by)] if by else [])]
    out = df.withWatermark(time, delay).groupBy(*keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *([by] if by else []), "n")


def append_vintages(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append whatever is there now as further vintages, then stop; files already taken aren't taken again."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()
