"""Parquet tables: reads that tolerate gaps and drift, pruned ranges, and atomic writes."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

#: Names that a writer in progress may leave behind.
RESERVED = re.compile(r"\.parquet\.tmp_[0-9a-f]+$")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. Zoneless instants are read as UTC by the scan itself, so filters on them still reach it."""
    path = f"{folder}/{name}.parquet"
    df = spark.read.parquet(path)
    if not any(isinstance(f.dataType, TimestampNTZType) for f in df.schema):
        return df
    zoned = StructType([StructField(f.name, TimestampType() if isinstance(f.dataType, TimestampNTZType) else f.dataType, f.nullable) for f in df.schema])
    return spark.read.schema(zoned).parquet(path)


def read_path(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet under a path, columns united by name; no files give an empty table of `schema`."""
    if RESERVED.search(path):
        raise ValueError(f"reserved name: {path}")
    try:
        reader = spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "false")
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema or StructType())


def in_date_range(df: DataFrame, column: str, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Inclusive on both ends; instants are bounded as instants, so that the scan can prune by them."""
    instant = df.schema[column].dataType.simpleString() == "timestamp"
    c = F.col(column)
    if start is not None:
        a = F.lit(start).cast("date")
        df = df.filter(c >= (a.cast("timestamp") if instant else a))
    if end is not None:
        b = F.lit(end).cast("date")
        df = df.filter(c < F.date_add(b, 1).cast("timestamp") if instant else c <= b)
    return df


def read_range(spark: SparkSession, path: str, start: date | None, end: date | None, column: str = "settlement_date", schema: StructType | None = None, widen_months: int = 1) -> DataFrame:
    """Rows dated start to end from a year=/month= tree; only those months, and `widen_months` beside them, are listed."""
    df = read_path(spark, path, schema)
    if {"year", "month"} <= set(df.columns):
        month = F.col("year") * 12 + F.col("month")
        if start is not None:
            df = df.filter((F.col("year") >= (start.year - 1)) & (month >= start.year * 12 + start.month - widen_months))
        if end is not None:
            df = df.filter((F.col("year") <= (end.year + 1)) & (month <= end.year * 12 + end.month + widen_months))
    return in_date_range(df, column, start, end) if column in df.columns else df


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def covering_partition(wanted: DataFrame, partitions: DataFrame, days: int) -> DataFrame:
    """(want, got): the newest partition `day` at most `days` before each `want`, or null.

    Each partition is offered to the days that it can cover, so the join is on equality.
    """
    offers = partitions.select(F.col("day").alias("got"), F.explode(F.sequence("day", F.date_add("day", days))).alias("want"))
    return wanted.join(offers.groupBy("want").agg(F.max("got").alias("got")), "want", "left")


def write(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Zstandard Parquet; with partitions, only those present are replaced."""
    if RESERVED.search(path):
        raise ValueError(f"reserved name: {path}")
    writer = df.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_silver(df: DataFrame, path: str, day: str = "partition_date", append_only: bool = False, vintage: str = "", order: tuple[str, ...] = (), csv: str | None = None) -> None:
    """One directory a day, replaced as a whole, rows in `order` within each file.

    Where every vintage stays, each has a directory of its own below the day, named `vintage`, so that
    a rerun over the same files replaces its own rows alone. `csv` names a folder for a copy as CSV.
    """
    dated = df.withColumns({"year": F.year(day), "month": F.month(day)})
    dated = dated.withColumn("vintage", F.lit(vintage or "all")) if append_only else dated
    parts = ("year", "month", day, *(("vintage",) if append_only else ()))
    inner = [c for c in order if c in df.columns]
    dated = dated.sortWithinPartitions(*parts, *inner) if inner else dated
    write(dated, path, parts)
    if csv:
        df.write.mode("overwrite").csv(csv, header=True)


def write_gold(df: DataFrame, path: str) -> int:
    """By year and date if there is one; an empty table writes nothing. Returns the number of rows, counted while writing."""
    if df.isEmpty():
        return 0
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    day = next((c for c in ("settlement_date", "date") if c in df.columns), None)
    write(rows.withColumn("year", F.year(day)), path, ("year", day)) if day else write(rows, path)
    return seen.get["n"]


def export_csv(df: DataFrame, path: str, start: str | None = None, end: str | None = None, limit: int | None = None) -> None:
    """A view as CSV, bounded on its first known date column."""
    if ".." in path.split("/"):
        raise ValueError("the path may not leave its folder")
    day = next((c for c in ("settlement_date", "gas_day", "timestamp_utc", "date") if c in df.columns), None)
    if day and (start or end):
        df = in_date_range(df, day, start, end)
    (df.limit(limit) if limit is not None else df).write.mode("overwrite").csv(path, header=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that driver and executors share (spark.checkpoint.dir); it goes with the session."""
    import tempfile
    import uuid

    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="wattmill-")
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return path
