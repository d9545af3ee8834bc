"""Sparse curves spread onto a regular grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def forward_fill(df: DataFrame, keys: list[str], time: str, values: list[str], step: str, end: str | None = None) -> DataFrame:
    """Every step from a series' first instant to its last (or to before its `end` column), gaps taking the last declared values.

    Several rows of one instant all stay, and rows off the grid or past the end are emitted as
    declared. Nothing precedes the first. Grids are made per key; the work is one window over
    declared and missing rows of a key, without a join.
    """
    stop = F.max(F.col(end)) - F.expr(step) if end else F.max(time)
    span = df.groupBy(*keys).agg(F.min(time).alias("_a"), F.greatest(stop, F.min(time)).alias("_b"))
    grid = span.select(*keys, F.explode(F.expr(f"sequence(_a, _b, {step})")).alias(time), F.lit(False).alias("_declared"))
    rows = df.select(*keys, time, *values, F.lit(True).alias("_declared"))
    both = rows.unionByName(grid, allowMissingColumns=True)
    # declared rows come first within an instant; the grid's row is kept only where none is declared
    at = W.partitionBy(*keys, time)
    kept = both.withColumn("_any", F.max("_declared").over(at)).filter("_declared or not _any")
    order = W.partitionBy(*keys).orderBy(time).rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.last(F.when(F.col("_declared"), F.struct(*values)), ignorenulls=True).over(order)
    filled = kept.withColumn("_last", last)
    return filled.select(*keys, time, *[F.when(F.col("_declared"), F.col(v)).otherwise(F.col("_last")[v]).alias(v) for v in values])
