"""Row counts, null rates, ranges, duplicate keys and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

FLOATS = ("double", "float")


def _missing(df: DataFrame, column: str):
    c = F.col(column)
    return c.isNull() | F.isnan(c) if df.schema[column].dataType.simpleString() in FLOATS else c.isNull()


def null_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, n_rows, n_missing, missing_rate) in one pass; NaN counts as missing in float columns."""
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    wide = df.agg(F.count("*").alias("n"), *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(columns)])
    rate = F.when(F.col("n_rows") > 0, F.col("n_missing") / F.col("n_rows")).otherwise(F.lit(0.0))
    return wide.select(F.col("n").alias("n_rows"), F.inline(pairs)).select("column_name", "n_rows", "n_missing", rate.alias("missing_rate"))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """(n_rows, n_out): nulls and NaN are out of range."""
    c = F.col(column)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(~c.between(low, high), F.lit(True))).alias("n_out"))


def row_count(df: DataFrame, minimum: int) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("passed", F.col("n_rows") >= minimum)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows have, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def gaps(df: DataFrame, column: str, minutes: float, tolerance: float = 1.0) -> DataFrame:
    """(previous, current, gap_minutes) where neighbours in time lie off the step by more than the tolerance.

    The order is global. Instants are ordered inside day-long buckets, and each bucket's first
    takes the last of the one before from a per-bucket summary, so no task orders all rows.
    """
    ts = F.col(column)
    rows = df.filter(ts.isNotNull()).select(ts.alias("current"), ts.cast("date").alias("_day"))
    ends = rows.groupBy("_day").agg(F.max("current").alias("_last"))
    ends = ends.select("_day", F.lag("_last").over(W.orderBy("_day")).alias("_before"))  # one row a day
    inside = F.lag("current").over(W.partitionBy("_day").orderBy("current"))
    paired = rows.withColumn("_in", inside).join(ends, "_day")
    step = paired.select(F.coalesce("_in", "_before").alias("previous"), "current")
    off = (F.unix_micros("current") - F.unix_micros("previous")) / 60_000_000
    return step.withColumn("gap_minutes", off).filter(F.abs(F.col("gap_minutes") - minutes) > tolerance)


def conflicts(df: DataFrame, keys: list[str]) -> DataFrame:
    """(n_rows, n_keys, n_conflicts): rows beyond one a key; keys may hold nulls."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*keys)).alias("n_keys")).withColumn("n_conflicts", F.col("n_rows") - F.col("n_keys"))


def varying_columns(df: DataFrame) -> list[str]:
    """Columns with more than one value, in one pass: least and greatest differ. Maps don't count."""
    found = [f.name for f in df.schema if not f.dataType.simpleString().startswith("map")]
    row = df.agg(*[(F.min(c) < F.max(c)).alias(f"v{i}") for i, c in enumerate(found)]).first()
    return [c for i, c in enumerate(found) if row[f"v{i}"]]


def key_columns(df: DataFrame, time: str) -> list[str]:
    """The key of rows that state none: time and the varying columns that aren't numbers."""
    numbers = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    return [time, *[c for c in varying_columns(df) if c != time and c not in numbers]]


def coverage(df: DataFrame, time: str, signal: list[str] | None = None) -> DataFrame:
    """First and last instant, the number of days with events and, over `signal` columns, distinct rows to all, to six digits."""
    ratio = [F.round(F.count_distinct(F.struct(*signal)) / F.count("*"), 6).alias("dedup_ratio")] if signal else []
    return df.agg(F.min(time).alias("first_at"), F.max(time).alias("last_at"), F.count_distinct(F.col(time).cast("date")).alias("n_days"), *ratio)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The codes or days that a column holds, ascending; null isn't one."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def rule_counts(df: DataFrame, rules: dict) -> DataFrame:
    """Fail-soft validation: rows that break each rule are counted, never dropped."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])


def report(df: DataFrame, dataset: str, keys: list[str] | None = None, time: str | None = None, minutes: float = 30, minimum: int = 1) -> DataFrame:
    """(dataset, check_name, subject, value, passed) of all checks that apply."""
    numeric = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float", "int", "bigint")]
    # row count and null rates from one scan
    wide = df.agg(F.count("*").alias("n"), *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(numeric)])
    n = F.col("n").cast("double")
    line = lambda check, subject, value, passed: F.struct(F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), value.alias("value"), passed.alias("passed"))
    rate = lambda i: F.when(F.col("n") > 0, F.col(f"m{i}") / F.col("n")).otherwise(F.lit(0.0))
    lines = [line("row_count", "*", n, F.col("n") >= minimum), *[line("null_rate", c, rate(i), rate(i) <= 0.05) for i, c in enumerate(numeric)]]
    parts = [wide.select(F.inline(F.array(*lines)))]
    if time:
        parts.append(gaps(df, time, minutes).agg(F.count("*").alias("n")).select(F.lit("gaps").alias("check_name"), F.lit(time).alias("subject"), F.col("n").cast("double").alias("value"), (F.col("n") == 0).alias("passed")))
    if keys:
        parts.append(duplicate_keys(df, keys).agg(F.count("*").alias("n")).select(F.lit("duplicates").alias("check_name"), F.lit(",".join(keys)).alias("subject"), F.col("n").cast("double").alias("value"), (F.col("n") == 0).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(dataset).alias("dataset"), "check_name", "subject", "value", "passed")
