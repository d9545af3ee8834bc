"""Event time, availability and lineage columns of a silver row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import gas_day_instant, settlement_period_to_utc

RESERVED = ("event_time", "available_at", "source_run_id", "dataset_version")


def event_time(df: DataFrame, target: date | None = None, gas: str | None = None) -> Column:
    """From the row's instant, its gas day, its settlement period, or else the target date."""
    if gas and gas in df.columns:
        return gas_day_instant(F.col(gas))
    if "timestamp_utc" in df.columns:
        return F.col("timestamp_utc")
    if {"settlement_date", "settlement_period"} <= set(df.columns):
        return settlement_period_to_utc(F.col("settlement_date"), F.col("settlement_period"))
    return F.lit(target).cast("date").cast("timestamp")


def available_at(df: DataFrame, stamp: Column) -> Column:
    """Row by row: the publication instant, else the ingest stamp."""
    if "published_at" not in df.columns:
        return stamp
    if df.schema["published_at"].dataType.simpleString() != "timestamp":
        raise TypeError("published_at must be a timestamp")
    return F.coalesce(F.col("published_at"), stamp)


def stamp_rows(df: DataFrame, run_id: str, version: str, stamp: Column, target: date | None = None, gas: str | None = None) -> DataFrame:
    """The four reserved columns."""
    made = {"event_time": event_time(df, target, gas), "available_at": available_at(df, stamp), "source_run_id": F.lit(run_id), "dataset_version": F.lit(version)}
    return df.withColumns(made)
