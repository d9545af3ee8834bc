"""Settlement, gas-day and instant arithmetic as Column functions (session zone must be UTC)."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONDON = "Europe/London"
#: Placeholders that stand for no instant, and the fallback formats, in order.
EMPTY_INSTANTS = ("", "-", "n/a", "na", "null", "none")
FALLBACK_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MMM d yyyy hh:mma", "d/M/yyyy HH:mm:ss", "d/M/yyyy")


def day_start_utc(day: Column) -> Column:
    """The instant of London midnight on a date."""
    return F.to_utc_timestamp(day.cast("timestamp"), LONDON)


def settlement_period_to_utc(day: Column, period: Column) -> Column:
    """Start of a half-hour settlement period; period 1 starts at London midnight, periods are 30 real minutes."""
    return day_start_utc(day) + F.make_interval(mins=(period.cast("int") - 1) * 30)


def settlement_periods_in_day(day: Column) -> Column:
    """46, 48 or 50, by the clock changes."""
    seconds = F.unix_timestamp(day_start_utc(F.date_add(day, 1))) - F.unix_timestamp(day_start_utc(day))
    return (seconds / 1800).cast("int")


def settlement_date(ts: Column) -> Column:
    """London date of an instant."""
    return F.from_utc_timestamp(ts, LONDON).cast("date")


def settlement_period(ts: Column) -> Column:
    """Period number, rounding half to even: meant for exact period starts."""
    seconds = (F.unix_micros(ts) - F.unix_micros(day_start_utc(settlement_date(ts)))) / 1_000_000
    return F.rint(seconds / 1800).cast("int") + 1


def settlement_period_floor(ts: Column) -> Column:
    """Period that contains an instant."""
    seconds = F.unix_timestamp(ts) - F.unix_timestamp(day_start_utc(settlement_date(ts)))
    return F.floor(seconds / 1800).cast("int") + 1


def period_is_valid(day: Column, period: Column) -> Column:
    """Whether the day has the period; null is false."""
    return F.coalesce(period.between(F.lit(1), settlement_periods_in_day(day)), F.lit(False))


def gas_day_instant(day: Column) -> Column:
    """06:00 UTC, without daylight saving."""
    return day.cast("timestamp") + F.expr("INTERVAL 6 HOURS")


def gas_day(ts: Column) -> Column:
    """The gas day that an instant falls in."""
    return (ts - F.expr("INTERVAL 6 HOURS")).cast("date")


def iso_weekday(ts: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(ts) + 1


def parse_instant(text: Column) -> Column:
    """`...Z` to the second, else null."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


def parse_minute(text: Column) -> Column:
    """`...Z` to the minute, else null."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm'Z'"))


def parse_published(text: Column) -> Column:
    """Base, fractional and offset forms; blank or unparseable is null. A zone must be there."""
    clean = F.nullif(F.trim(text), F.lit(""))
    zoned = clean.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, F.try_to_timestamp(clean))


def parse_lenient(text: Column) -> Column:
    """ISO, or one of the fallback formats; placeholders are null, naive instants are UTC."""
    clean = F.trim(text)
    clean = F.when(~F.lower(clean).isin(*EMPTY_INSTANTS), clean)
    iso = F.when(clean.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.regexp_replace(clean, r"^(\d{4}-\d{2}-\d{2}) ", "$1T")))
    return F.coalesce(iso, *[F.try_to_timestamp(clean, F.lit(f)) for f in FALLBACK_FORMATS])


def parse_document_instant(text: Column) -> Column:
    """Four lenient forms of a document's instants; a trailing Z is dropped and the rest read as UTC."""
    clean = F.regexp_replace(F.trim(text), "Z$", "")
    return F.coalesce(*[F.try_to_timestamp(clean, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")])


def strict_instant(text: Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ss") -> Column:
    """Raises on what doesn't parse, and on a zone suffix."""
    zoned = text.rlike(r"([Zz]|[+-]\d{2}:?\d{2})$") & text.contains("T")
    return F.when(zoned, F.raise_error(F.concat(F.lit("instant has a zone suffix: "), text)).cast("timestamp")).otherwise(F.to_timestamp(text, fmt))


def safe_date(text: Column) -> Column:
    """The first ten characters as a date, else null."""
    return F.substring(text, 1, 10).try_cast("date")


def safe_instant(text: Column) -> Column:
    """An instant, or a date's midnight, else null."""
    return F.coalesce(F.try_to_timestamp(text), safe_date(text).cast("timestamp"))


def date_range(spark, first: date, last: date) -> DataFrame:
    """One row for each day, both ends included."""
    days = F.sequence(F.lit(first), F.lit(last))
    return spark.range(1).toDF("_").select(F.explode(days).alias("day"))


def day_subwindows(start: Column, end: Column) -> Column:
    """Array of (start, end): [start, end) cut at UTC midnights; empty if start >= end."""
    days = F.sequence(start.cast("date"), (end - F.expr("INTERVAL 1 MICROSECOND")).cast("date"))
    cut = F.transform(days, lambda d: F.struct(F.greatest(start, d.cast("timestamp")).alias("start"), F.least(end, F.date_add(d, 1).cast("timestamp")).alias("end")))
    return F.when(start < end, cut).otherwise(F.array().cast("array<struct<start:timestamp,end:timestamp>>"))


def parse_lookback(text: str) -> timedelta:
    """`24h`, `7d` or `30m`."""
    found = re.fullmatch(r"\s*(\d+)\s*([hdm])\s*", text.lower())
    if not found:
        raise ValueError(f"not a lookback: {text!r}")
    return timedelta(**{{"h": "hours", "d": "days", "m": "minutes"}[found[2]]: int(found[1])})


def python_subwindows(start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
    """day_subwindows for planning on the driver; both ends must be in UTC."""
    if any(x.utcoffset() != timedelta(0) for x in (start, end)):
        raise ValueError("both ends must be aware and in UTC")
    out = []
    while start < end:
        midnight = datetime(start.year, start.month, start.day, tzinfo=timezone.utc) + timedelta(days=1)
        out.append((start, min(end, midnight)))
        start = min(end, midnight)
    return out
