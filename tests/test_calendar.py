from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wattmill.functions import calendar as C


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("day", "periods"), [("2024-03-31", 46), ("2024-06-01", 48), ("2024-10-27", 50)])
def test_day_length_and_round_trip(spark, day, periods):
    d = F.lit(day).cast("date")
    assert one(spark, C.settlement_periods_in_day(d)) == periods
    rows = spark.range(1, periods + 1).select(F.col("id").cast("int").alias("p")).withColumn("t", C.settlement_period_to_utc(d, F.col("p")))
    got = rows.select("p", C.settlement_period(F.col("t")).alias("q"), C.settlement_date(F.col("t")).cast("string").alias("d")).collect()
    assert all(r.p == r.q and r.d == day for r in got)


def test_summer_day_starts_the_evening_before(spark):
    assert one(spark, C.settlement_period_to_utc(F.lit("2024-06-01").cast("date"), F.lit(1)).cast("string")) == "2024-05-31 23:00:00"


def test_half_even_rounding(spark):
    at = lambda t: F.lit(t).cast("timestamp")
    assert one(spark, C.settlement_period(at("2024-01-01 00:15:00"))) == 1
    assert one(spark, C.settlement_period(at("2024-01-01 00:45:00"))) == 3
    assert one(spark, C.settlement_period_floor(at("2024-01-01 00:45:00"))) == 2


def test_validity(spark):
    d = F.lit("2024-03-31").cast("date")
    assert not one(spark, C.period_is_valid(d, F.lit(47)))
    assert not one(spark, C.period_is_valid(d, F.lit(None).cast("int")))
    assert one(spark, C.period_is_valid(d, F.lit(46)))


@pytest.mark.parametrize(
    ("text", "want"),
    [("2024-01-02", "2024-01-02 00:00:00"), ("2024-01-02 03:04:05", "2024-01-02 03:04:05"), ("Jan 2 2024 03:04PM", "2024-01-02 15:04:00"), ("02/01/2024", "2024-01-02 00:00:00"), ("2024-01-02T03:04:05+01:00", "2024-01-02 02:04:05"), (" N/A ", None), ("", None), ("soon", None)],
)
def test_lenient(spark, text, want):
    assert one(spark, C.parse_lenient(F.lit(text)).cast("string")) == want


def test_published_needs_a_zone(spark):
    assert one(spark, C.parse_published(F.lit("2024-01-02T03:04:05.250Z")).cast("string")) == "2024-01-02 03:04:05.25"
    assert one(spark, C.parse_published(F.lit("2024-01-02 03:04:05"))) is None


def test_strict_raises(spark):
    with pytest.raises(Exception, match="zone suffix"):
        one(spark, C.strict_instant(F.lit("2024-01-02T03:04:05Z")))
    with pytest.raises(Exception):
        one(spark, C.strict_instant(F.lit("soon")))


def test_subwindows(spark):
    at = lambda t: F.lit(t).cast("timestamp")
    got = one(spark, C.day_subwindows(at("2024-01-01 22:00:00"), at("2024-01-03 00:00:00")))
    assert [str(w.start)[5:16] + ">" + str(w.end)[5:16] for w in got] == ["01-01 22:00>01-02 00:00", "01-02 00:00>01-03 00:00"]
    assert one(spark, C.day_subwindows(at("2024-01-02 00:00:00"), at("2024-01-01 00:00:00"))) == []
    u = timezone.utc
    assert len(C.python_subwindows(datetime(2024, 1, 1, 22, tzinfo=u), datetime(2024, 1, 3, tzinfo=u))) == 2
    with pytest.raises(ValueError):
        C.python_subwindows(datetime(2024, 1, 1), datetime(2024, 1, 2))


def test_small_ones(spark):
    assert C.parse_lookback("7d") == timedelta(days=7)
    assert [r.day for r in C.date_range(spark, date(2024, 1, 1), date(2024, 1, 3)).collect()] == [date(2024, 1, i) for i in (1, 2, 3)]
    assert one(spark, C.iso_weekday(F.lit("2024-01-07").cast("timestamp"))) == 7
    assert str(one(spark, C.gas_day(F.lit("2024-01-02 05:59:00").cast("timestamp")))) == "2024-01-01"
