"""State tables: watermarks, run logs and manifests, rewritten rather than updated in place."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hours of overlap and of the furthest look back.
OVERLAP_HOURS, MAX_LOOKBACK_HOURS, DEFAULT_LOOKBACK_HOURS = 72, 168, 24


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and old rows whose key has no new one."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def status_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def raise_watermarks(old: DataFrame, new: DataFrame) -> DataFrame:
    """(source, dataset, last_end): a watermark never goes back."""
    return old.unionByName(new).groupBy("source", "dataset").agg(F.max("last_end").alias("last_end"))


def window_start(frontier: Column, end: Column, overlap: int = OVERLAP_HOURS, lookback: int = MAX_LOOKBACK_HOURS) -> Column:
    return F.greatest(frontier - F.make_interval(hours=F.lit(overlap)), end - F.make_interval(hours=F.lit(lookback)))


@dataclass(frozen=True)
class Snapshot:
    """What a read of a watermark found: present, absent or unreadable."""

    status: str
    value: datetime | None = None
    version: int = 0


@dataclass(frozen=True)
class FetchWindow:
    """A window to fetch, whether the watermark may advance to its end, and why (not)."""

    start: datetime
    end: datetime
    may_advance: bool
    reason: str
    snapshot: Snapshot


def incremental_window(
    snapshot: Snapshot,
    now: datetime,
    end: datetime,
    default_start: datetime,
    overlap: timedelta = timedelta(hours=OVERLAP_HOURS),
    lookback: timedelta = timedelta(hours=MAX_LOOKBACK_HOURS),
) -> FetchWindow:
    """The window from the watermark less the overlap, no further back than the lookback.

    The watermark may advance only if the window covers all from the old one to `end`, and `end`
    isn't in the future.
    """
    frontier = snapshot.value if snapshot.status == "present" else None
    wanted = frontier - overlap if frontier is not None else default_start
    floor = end - lookback
    start = max(wanted, floor)
    if snapshot.status == "unreadable":
        return FetchWindow(start, end, False, "FRONTIER_UNREADABLE", snapshot)
    if end > now:
        return FetchWindow(start, end, False, "FUTURE_END", snapshot)
    if frontier is not None and start > frontier:
        return FetchWindow(start, end, False, "UNFETCHED_GAP", snapshot)
    return FetchWindow(start, end, True, "CLAMPED_NO_GAP" if wanted < floor else "HEALTHY", snapshot)


def may_record(window: FetchWindow, responses: list[tuple[int, int | None]], skipped: int) -> bool:
    """Whether a fetch lets the watermark advance: the window may, nothing was skipped, and some response
    (status, number of records, None if not counted) brought data."""
    return window.may_advance and not skipped and any(status < 400 and records != 0 for status, records in responses)


def runs_since(log: DataFrame, instant: Column) -> DataFrame:
    """Number of runs that started strictly later."""
    return log.filter(F.col("started_at") > instant).agg(F.count("*").alias("n"))


def recent_runs(log: DataFrame, now: Column, limit: int = 20) -> DataFrame:
    """The last day's runs, newest first, with their length in seconds."""
    length = F.round((F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1_000_000, 1)
    return log.filter(F.col("started_at") >= now - F.expr("INTERVAL 24 HOURS")).withColumn("seconds", length).orderBy(F.desc("started_at"), "run_id").limit(limit)
