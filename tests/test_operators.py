from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wattmill.functions import scalars as S
from wattmill.operators import bitemporal, quality, state, vintage, windows
from wattmill.operators.fill import forward_fill


def test_latest_prefers_time_then_run(spark):
    rows = spark.createDataFrame([(1, "II", "2024-01-01", 10.0), (1, "SF", "2024-01-02", 11.0), (1, "R1", "2024-01-02", 12.0), (2, None, None, 13.0), (2, "II", None, 14.0)], "settlement_period int, run_type string, at string, v double")
    rows = rows.withColumns({"available_at": F.col("at").cast("timestamp"), "settlement_date": F.lit("2024-01-01").cast("date")})
    got = vintage.latest_by(rows, vintage.LATEST_SPECS["elexon", "system_prices"]).select("settlement_period", "v").collect()
    assert {tuple(r) for r in got} == {(1, 12.0), (2, 14.0)}


def test_latest_without_its_key_is_left_alone(spark):
    rows = spark.createDataFrame([(1,), (1,)], "x int")
    assert vintage.latest_by(rows, vintage.LATEST_SPECS["elexon", "remit"]).count() == 2


def test_keep_last_treats_nulls_as_equal(spark):
    rows = spark.createDataFrame([(None, "a", 0, 1), (None, "a", 1, 2), (None, "b", 0, 3), (1, "a", 0, 4)], "k int, path string, ordinal int, v int")
    assert {(r.k, r.v) for r in vintage.dedup_keep_last(rows, ["k"], ["path", "ordinal"]).collect()} == {(None, 3), (1, 4)}


def test_available_at_is_row_wise(spark):
    rows = spark.sql("SELECT timestamp'2024-01-01' AS timestamp_utc, timestamp'2024-01-02' AS published_at UNION ALL SELECT timestamp'2024-01-01', null")
    out = bitemporal.stamp_rows(rows, "r", "1", F.lit("2024-01-05").cast("timestamp"))
    assert sorted(str(r.available_at)[:10] for r in out.collect()) == ["2024-01-02", "2024-01-05"]
    with pytest.raises(TypeError):
        bitemporal.stamp_rows(rows.withColumn("published_at", F.lit("x")), "r", "1", F.current_timestamp())


def test_closed_refuses_a_total_drop(spark):
    rows = spark.createDataFrame([(1, "2024-01-03"), (2, "2024-01-04"), (3, None)], "i int, t string").withColumn("t", F.col("t").cast("timestamp"))
    end = F.lit("2024-01-03").cast("timestamp")
    keep = lambda df, owns=True: {r.i for r in windows.closed_filter(df, "t", end, F.lit(owns)).collect()}
    assert keep(rows) == {3}
    assert keep(rows.filter("i < 3")) == {1, 2}
    assert keep(rows, False) == {1, 2, 3}
    assert {r.i for r in windows.half_open_filter(rows, "t", F.lit("2024-01-01").cast("timestamp"), end).collect()} == {3}


def test_request_windows(spark):
    rows = [("s", "d", {"from": "2024-01-01T00:00Z", "to": "202401020000"}), ("s", "d", {"from": "x", "to": "y"}), ("s", "d", {"from": "202401020000", "to": "202401010000"}), ("s", "e", {"from": "202401010000", "to": "202401020000"}), ("s", "d", {})]
    got = windows.request_windows(spark.createDataFrame(rows, "source string, dataset string, request_params map<string,string>"), "s", "d", "from", "to")
    assert [r.reason for r in got.collect()] == [None, "UNPARSEABLE_PARAM", "EMPTY_WINDOW", "WRONG_IDENTITY", "MISSING_PARAM"]
    assert windows.partition_window(got.filter("reason is null")).first().usable
    assert not windows.partition_window(got).first().usable


def test_durable_chunks(spark):
    rows = [("a", "b", 1, 2, True), ("a", "b", 2, 2, True), ("c", "d", 1, 2, True), ("e", "f", None, None, False)]
    got = windows.durable_chunks(spark.createDataFrame(rows, "window_start string, window_end string, page int, total_pages int, has_body boolean"))
    assert {r.window_start: r.durable for r in got.collect()} == {"a": True, "c": False, "e": False}


def test_quality(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, float("nan")), (None, None), (2, 9.0)], "k int, v double")
    assert {r.column_name: r.n_missing for r in quality.null_rates(rows).collect()} == {"k": 1, "v": 2}
    assert quality.out_of_range(rows, "v", 0, 5).first().n_out == 3
    assert [tuple(r) for r in quality.duplicate_keys(rows, ["k"]).collect()] == [(2, 2)]
    assert tuple(quality.conflicts(rows, ["k"]).first()) == (4, 3, 1)


def test_gaps_cross_midnight(spark):
    times = ["2024-01-01 23:00:00", "2024-01-01 23:30:00", "2024-01-02 00:00:00", "2024-01-02 01:30:00", "2024-01-04 00:00:00"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").withColumn("t", F.col("t").cast("timestamp"))
    assert sorted(r.gap_minutes for r in quality.gaps(rows, "t", 30).collect()) == [90.0, 2790.0]


def test_forward_fill(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 2, 2.0), ("a", 2, 3.0), ("a", 9, 4.0)], "k string, h int, v double").withColumn("t", F.timestamp_seconds(F.col("h") * 3600))
    rows = rows.withColumn("e", F.timestamp_seconds(F.lit(5 * 3600)))
    out = forward_fill(rows, ["k"], "t", ["v"], "INTERVAL 1 HOUR", "e").orderBy("t", "v").select((F.unix_timestamp("t") / 3600).cast("int"), "v").collect()
    got = [tuple(r) for r in out]
    assert got[:4] == [(0, 1.0), (1, 1.0), (2, 2.0), (2, 3.0)] and [h for h, _ in got[4:]] == [3, 4, 9] and got[-1] == (9, 4.0)


U = timezone.utc
NOW = datetime(2024, 1, 10, tzinfo=U)


@pytest.mark.parametrize(
    ("snapshot", "end", "may", "reason"),
    [
        (state.Snapshot("present", NOW - timedelta(hours=10)), NOW, True, "HEALTHY"),
        (state.Snapshot("present", NOW - timedelta(hours=120)), NOW, True, "CLAMPED_NO_GAP"),
        (state.Snapshot("present", NOW - timedelta(hours=200)), NOW, False, "UNFETCHED_GAP"),
        (state.Snapshot("unreadable"), NOW, False, "FRONTIER_UNREADABLE"),
        (state.Snapshot("absent"), NOW + timedelta(hours=1), False, "FUTURE_END"),
    ],
)
def test_incremental_window(snapshot, end, may, reason):
    got = state.incremental_window(snapshot, NOW, end, end - timedelta(hours=24))
    assert (got.may_advance, got.reason) == (may, reason)
    assert got.start >= end - timedelta(hours=168)


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(S.slug(F.lit("  Öl & Gas (mix) "))) == "l_gas_mix"
    assert one(S.currency(F.lit(" "))) == "EUR" and one(S.currency(F.lit(" GBP"))) == "GBP"
    assert one(S.enum(F.lit(None).cast("string"), S.RESERVE_TYPE)) == "unmapped"
    assert one(S.enum_or_raw(F.lit("Z9"), S.OUTAGE_TYPE)) == "Z9"
    assert one(S.to_gwh_day(F.lit(2.0), F.lit(" MWh/h"))) == pytest.approx(0.048)
    assert one(S.to_gwh_day(F.lit(2.0), F.lit("therm"))) is None
    assert one(S.percent_full(F.lit(5.0), F.lit(0.0))) is None and one(S.percent_full(F.lit(9.0), F.lit(4.0))) == 100.0
    assert one(S.heating_degrees(F.lit(None).cast("double"))) is None and one(S.heating_degrees(F.lit(20.0))) == 0.0
    assert one(S.link_slug(F.lit("https://x/y?turl=abc&z=1"))) == "abc" and one(S.link_slug(F.lit("https://x/y/last/"))) == "last"
    assert one(S.usable_value(F.lit("NaN"))) is False and one(S.usable_value(F.lit(" "))) is True
    assert one(S.mask_secret(F.lit("http://a?key=1&b=2"))) == "http://a?key=***&b=2"
    assert S.snake_case("gasDayStart") == "gas_day_start" and S.snake_case("EIC code-name") == "eic_code_name"


def test_names_that_meet(spark):
    df = spark.createDataFrame([(None, "b", ""), ("a", "b", "c")], "gasDay string, gas_day string, other string")
    assert [r.gas_day for r in S.normalise_names(df).collect()] == ["b", "a"]


def test_what_lets_a_watermark_advance():
    window = state.incremental_window(state.Snapshot("present", NOW - timedelta(hours=10)), NOW, NOW, NOW)
    assert state.may_record(window, [(200, None), (500, 0)], 0) and state.may_record(window, [(200, 4)], 0)
    assert not state.may_record(window, [(200, 4)], 1) and not state.may_record(window, [(404, 4), (200, 0)], 0) and not state.may_record(window, [], 0)


def test_ties_have_one_winner(spark):
    rows = [(1, "2024-01-01", x) for x in "cab"]
    df = spark.createDataFrame(rows, "mrid int, available_at string, v string")
    spec = vintage.LATEST_SPECS["elexon", "remit"]
    for part in (1, 3):
        assert vintage.latest_by(df.repartition(part), spec, vintage.total_order(df, spec)).first().v == "c"
    assert vintage.dedup_signal(df.withColumn("at", F.lit("x")), ["mrid"], ["v"]).first().v == "a"


def test_columns_that_vary(spark):
    df = spark.createDataFrame([("a", 1, "x", "2024-01-01"), ("b", 2, "x", "2024-01-02")], "c string, n int, same string, t string")
    assert quality.varying_columns(df) == ["c", "n", "t"] and quality.key_columns(df, "t") == ["t", "c"]
    assert quality.coverage(df.withColumn("t", F.col("t").cast("timestamp")), "t", ["same"]).first().dedup_ratio == 0.5
