"""Which partition owns a row: request windows and the filters by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import parse_minute


def parse_window_end(text: Column) -> Column:
    """ISO with a zone, or twelve digits in UTC."""
    iso = F.when(text.rlike(r"T.*(Z|[+-]\d{2}:?\d{2})$"), F.coalesce(F.try_to_timestamp(text), parse_minute(text)))
    return F.coalesce(iso, F.when(text.rlike(r"^\d{12}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmm"))))


def request_windows(sidecars: DataFrame, source: str, dataset: str, start_param: str, end_param: str) -> DataFrame:
    """Sidecars with window_start, window_end and reason (null if sound)."""
    start, end = (F.col("request_params").getItem(p) for p in (start_param, end_param))
    a, b = parse_window_end(start), parse_window_end(end)
    reason = (
        F.when((F.col("source") != source) | (F.col("dataset") != dataset), "WRONG_IDENTITY")
        .when(F.col("request_params").isNull() | start.isNull() | end.isNull(), "MISSING_PARAM")
        .when(a.isNull() | b.isNull(), "UNPARSEABLE_PARAM")
        .when(a >= b, "EMPTY_WINDOW")
    )
    return sidecars.withColumns({"window_start": a, "window_end": b, "reason": reason})


def partition_window(windows: DataFrame) -> DataFrame:
    """One row (window_start, window_end, usable): the hull of all windows, usable only if every sidecar is sound."""
    usable = F.coalesce(F.bool_and(F.col("reason").isNull()), F.lit(False))
    return windows.agg(F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"), usable.alias("usable"))


def durable_chunks(files: DataFrame) -> DataFrame:
    """(window_start, window_end, durable) from files with those, page, total_pages and has_body: all bodies there, and pages 1 to the most."""
    pages = F.array_sort(F.collect_set(F.coalesce("page", F.lit(1))))
    wanted = F.sequence(F.lit(1), F.max(F.coalesce("total_pages", F.lit(1))).cast("int"))
    durable = F.bool_and("has_body") & (pages.cast("array<int>") == wanted)
    return files.groupBy("window_start", "window_end").agg(durable.alias("durable"))


def covering_is_durable(chunks: DataFrame, instant: Column) -> DataFrame:
    """The chunks that hold an instant and are durable."""
    return chunks.filter((F.col("window_start") <= instant) & (instant < F.col("window_end")) & F.col("durable"))


def closed_filter(df: DataFrame, column: str, end: Column, neighbour_owns: Column) -> DataFrame:
    """Drop rows at or after `end` that the neighbour owns; nulls stay.

    A drop of every row is refused: all stay. The verdict needs one total, which joins back as a
    single row, so rows are scanned twice but never gathered.
    """
    late = F.coalesce((F.col(column) >= end) & neighbour_owns, F.lit(False))
    marked = df.withColumn("_late", late)
    totals = marked.agg((F.coalesce(F.bool_and("_late"), F.lit(False))).alias("_all"))
    return marked.join(F.broadcast(totals)).filter(~F.col("_late") | F.col("_all")).drop("_late", "_all")


def half_open_filter(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Keep [start, end) and nulls; a drop of every row is carried out, for the caller to judge."""
    ts = F.col(column)
    return df.filter(ts.isNull() | ((ts >= start) & (ts < end)))


def window_counts(df: DataFrame, column: str, start: Column, end: Column, *keys: str) -> DataFrame:
    """Kept, dropped and undated rows of a half-open window, in one aggregation."""
    ts = F.col(column)
    kept = (ts >= start) & (ts < end)
    aggs = (F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"), F.count_if(ts.isNull()).alias("undated"))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def on_day_or_undated(day: Column, target: Column) -> Column:
    """Fail-open: rows of the day, and rows whose date can't be read."""
    return day.isNull() | (day == target)


def overlaps_day(start: Column, end: Column, day: Column) -> Column:
    """An event covers a day; one bound stands for both, none keeps the row."""
    return F.coalesce((F.coalesce(start, end) <= day) & (day <= F.coalesce(end, start)), F.lit(True))


def classify_event(start: Column, end: Column, reference: Column, first: Column, last: Column) -> Column:
    """overlap, outside or undated, by event dates if any, else by a reference date."""
    dated = start.isNotNull() | end.isNotNull()
    crosses = (F.coalesce(start, end) <= last) & (F.coalesce(end, start) >= first)
    inside = reference.between(first, last)
    return F.when(dated, F.when(crosses, "overlap").otherwise("outside")).when(reference.isNull(), "undated").when(inside, "overlap").otherwise("outside")


def request_contains(start: Column, end: Column, day: Column) -> Column:
    """Whether a request's own dates hold a day; one that states none does."""
    return F.coalesce(day.between(start, end), F.lit(True))


#: Request parameters that bound a fetch, by source.
WINDOW_PARAMS = {"entsoe": ("periodStart", "periodEnd"), "elexon": ("publishDateTimeFrom", "publishDateTimeTo")}


#: Publication-window datasets that are exempt from the closed filter.
CLOSED_EXEMPT = ("fuelinst", "temp", "boal", "disbsad", "mid", "netbsad", "freq", "market_depth", "system_prices", "pn", "bmunits_reference")
CLOSED_COLUMN = {"remit": "timestamp_utc"}


def closed_window_column(dataset: str) -> str | None:
    """The column that a dataset's publication window bounds, or None if it is exempt."""
    return None if dataset in CLOSED_EXEMPT else CLOSED_COLUMN.get(dataset, "published_at")
