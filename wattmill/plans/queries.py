"""Each operator on the driver's tables, beside SQL that gives the same rows.

The tables hold no energy data, so orders and events stand in for vintages and measurements.
Instants leave as microseconds since 1970.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import scalars as S
from ..operators import bitemporal, quality, state, vintage, windows
from ..operators.fill import forward_fill
from ..sources import tables
from . import gold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def us(c: Column | str) -> Column:
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


def _client(spark, d, *names: str):
    """The client over an empty lake, with the driver's tables as views."""
    from .serving import Client

    for n in names:
        tables.read(spark, d, n).createOrReplaceTempView(f"t_{n}")
    return Client(spark, f"{d}/no-lake")


STATUS = (("P", 1), ("O", 2), ("F", 3))
ORDERS = vintage.LatestSpec(("o_custkey",), ("o_orderdate",), rank_column="o_orderstatus", rank=STATUS)
_RANK = "CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 WHEN 'F' THEN 3 ELSE 0 END"


@query(f"""
SELECT o_custkey, o_orderkey, o_orderstatus, epoch_us(o_orderdate) AS ordered_us FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, {_RANK} DESC, o_orderkey DESC) = 1""")
def latest_vintage_orders(spark, d):
    out = vintage.latest_by(tables.read(spark, d, "orders"), ORDERS, ("o_orderkey",))
    return out.select("o_custkey", "o_orderkey", "o_orderstatus", us("o_orderdate").alias("ordered_us"))


@query("""
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1""")
def latest_vintage_lineitem(spark, d):
    spec = vintage.LatestSpec(("l_partkey",), ("l_shipdate",), optional_keys=("l_suppkey",))
    return vintage.latest_by(tables.read(spark, d, "lineitem"), spec, ("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")


@query("""
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_keep_last_events(spark, d):
    return vintage.dedup_keep_last(tables.read(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("""
SELECT c_nationkey, c_mktsegment, c_custkey FROM (SELECT *, c_custkey AS ordinal FROM customer)
QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY ordinal DESC) = 1""")
def dedup_whole_rows_customer(spark, d):
    rows = tables.read(spark, d, "customer").select("c_nationkey", "c_mktsegment", "c_custkey")
    return vintage.dedup_whole_rows(rows, ["c_custkey"])


_LOCAL = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London')"


@query(f"""
SELECT event_id, CAST(CAST({_LOCAL} AS DATE) AS VARCHAR) AS settlement_date,
  CAST(floor((epoch_us(ts) - epoch_us((CAST(CAST({_LOCAL} AS DATE) AS TIMESTAMP) AT TIME ZONE 'Europe/London'))) / 1800000000.0) AS INTEGER) + 1 AS settlement_period
FROM events""")
def settlement_period_events(spark, d):
    ts = F.col("ts")
    return tables.read(spark, d, "events").select("event_id", C.settlement_date(ts).cast("string").alias("settlement_date"), C.settlement_period_floor(ts).alias("settlement_period"))


@query("""
SELECT CAST(o_orderdate::DATE AS VARCHAR) AS day, CAST(o_orderkey % 46 + 1 AS INTEGER) AS period, o_orderkey,
  epoch_us((CAST(o_orderdate::DATE AS TIMESTAMP) AT TIME ZONE 'Europe/London')) + (o_orderkey % 46) * 1800000000 AS start_us,
  CAST((epoch_us((CAST(o_orderdate::DATE + 1 AS TIMESTAMP) AT TIME ZONE 'Europe/London')) - epoch_us((CAST(o_orderdate::DATE AS TIMESTAMP) AT TIME ZONE 'Europe/London'))) // 1800000000 AS INTEGER) AS n_periods
FROM orders""")
def period_start_utc_orders(spark, d):
    day, period = F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 46 + 1).cast("int")
    return tables.read(spark, d, "orders").select(day.cast("string").alias("day"), period.alias("period"), "o_orderkey", us(C.settlement_period_to_utc(day, period)).alias("start_us"), C.settlement_periods_in_day(day).alias("n_periods"))


@query("""
WITH s AS (SELECT o_orderkey, epoch_us((CAST(o_orderdate::DATE AS TIMESTAMP) AT TIME ZONE 'Europe/London')) AS a, epoch_us((CAST(o_orderdate::DATE AS TIMESTAMP) AT TIME ZONE 'Europe/London')) + (o_orderkey % 46) * 1800000000 AS u FROM orders)
SELECT o_orderkey, CAST((u - a) // 1800000000 + 1 AS INTEGER) AS period FROM s""")
def settlement_round_trip_orders(spark, d):
    day, period = F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 46 + 1).cast("int")
    return tables.read(spark, d, "orders").select("o_orderkey", C.settlement_period(C.settlement_period_to_utc(day, period)).alias("period"))


@query("""
SELECT CAST(CAST(ts - INTERVAL 6 HOURS AS DATE) AS VARCHAR) AS gas_day, event_type, count(*) AS n, epoch_us(CAST(CAST(ts - INTERVAL 6 HOURS AS DATE) AS TIMESTAMP) + INTERVAL 6 HOURS) AS start_us
FROM events GROUP BY ALL""")
def gas_day_events(spark, d):
    days = tables.read(spark, d, "events").groupBy(C.gas_day(F.col("ts")).alias("gas_day"), "event_type").agg(F.count("*").alias("n"))
    return days.withColumn("start_us", us(C.gas_day_instant(F.col("gas_day")))).withColumn("gas_day", F.col("gas_day").cast("string"))


@query("""
SELECT event_id, o_period, p BETWEEN 1 AND n AS valid FROM (
  SELECT event_id, CAST(event_id % 51 AS INTEGER) AS o_period, CAST(event_id % 51 AS INTEGER) AS p,
    (epoch_us((CAST(ts::DATE + 1 AS TIMESTAMP) AT TIME ZONE 'Europe/London')) - epoch_us((CAST(ts::DATE AS TIMESTAMP) AT TIME ZONE 'Europe/London'))) // 1800000000 AS n FROM events)""")
def period_validity_events(spark, d):
    p = (F.col("event_id") % 51).cast("int")
    return tables.read(spark, d, "events").select("event_id", p.alias("o_period"), C.period_is_valid(F.col("ts").cast("date"), p).alias("valid"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN epoch_us(o_orderdate) ELSE -1 END AS a_us, CASE WHEN o_orderkey % 3 <> 2 THEN epoch_us(o_orderdate) ELSE -1 END AS b_us FROM orders""")
def lenient_instants_orders(spark, d):
    at = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(at, "dd/MM/yyyy HH:mm:ss")).when(F.col("o_orderkey") % 3 == 1, F.lit(" N/A ")).otherwise(F.lit("not a date"))
    zoned = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("o_orderkey") % 3 == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
    return tables.read(spark, d, "orders").select("o_orderkey", F.coalesce(us(C.parse_lenient(text)), F.lit(-1)).alias("a_us"), F.coalesce(us(C.parse_published(zoned)), F.lit(-1)).alias("b_us"))


@query("""
WITH latest AS (
  SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1)
SELECT l_orderkey, l_extendedprice - l_quantity AS spread, abs(l_quantity - 25) AS abs_imbalance,
  CAST(hour(l_shipdate) AS INTEGER) AS hour_of_day, CAST(isodow(l_shipdate) AS INTEGER) AS day_of_week FROM latest""")
def gold_spread_features(spark, d):
    rows = tables.read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("available_at"), F.col("l_shipdate").alias("timestamp_utc"),
        F.col("l_extendedprice").alias("system_buy_price"), F.col("l_quantity").alias("system_sell_price"), (F.col("l_quantity") - 25).alias("net_imbalance_volume"),
    )
    latest = vintage.latest_by(rows, vintage.LatestSpec(("l_orderkey",)), ("l_linenumber", "system_buy_price", "system_sell_price"))
    return gold.spread_features(latest).select("l_orderkey", "spread", "abs_imbalance", "hour_of_day", "day_of_week")


@query(f"""
WITH latest AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, {_RANK} DESC, o_orderkey DESC) = 1)
SELECT o_custkey, o_orderkey, o_totalprice, c_mktsegment, c_acctbal FROM latest LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 12) c ON o_custkey = c_custkey""")
def imbalance_context_join(spark, d):
    latest = vintage.latest_by(tables.read(spark, d, "orders"), ORDERS, ("o_orderkey",)).withColumnRenamed("o_custkey", "_key")
    context = tables.read(spark, d, "customer").filter("c_nationkey < 12").withColumnRenamed("c_custkey", "_key")
    return gold.with_context(latest, context, "_key").select(F.col("_key").alias("o_custkey"), "o_orderkey", "o_totalprice", "c_mktsegment", "c_acctbal")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys_lineitem(spark, d):
    return quality.duplicate_keys(tables.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, k FROM (SELECT user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN ts::DATE END AS k FROM events))) AS n_keys,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN ts::DATE END AS k FROM events)) AS n_conflicts FROM events""")
def residual_key_conflicts(spark, d):
    rows = tables.read(spark, d, "events").withColumn("k", F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("date")))
    return quality.conflicts(rows, ["user_id", "event_type", "k"])


@query("SELECT epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(DISTINCT ts::DATE) AS n_days FROM events")
def event_coverage(spark, d):
    return quality.coverage(tables.read(spark, d, "events"), "ts").select(us("first_at").alias("first_us"), us("last_at").alias("last_us"), "n_days")


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'old' ELSE 'new' END AS origin FROM orders""")
def manifest_upsert(spark, d):
    rows = tables.read(spark, d, "orders")
    old, new = (rows.filter(f"o_orderstatus IN ({k})").select("o_orderkey", "o_custkey", F.lit(n).alias("origin")) for k, n in (("'F', 'O'", "old"), ("'O', 'P'", "new")))
    return state.upsert(old, new, ["o_orderkey"])


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def status_counts(spark, d):
    return state.status_counts(tables.read(spark, d, "orders"), "o_orderstatus").withColumnRenamed("o_orderstatus", "status")


@query("""
WITH r AS (SELECT CASE WHEN event_id % 10 <> 0 THEN value END AS value, CASE WHEN event_id % 4 <> 0 THEN user_id END AS user_id FROM events)
SELECT 'value' AS column_name, count(*) AS n_rows, count(*) - count(value) AS n_missing, (count(*) - count(value)) / count(*) AS missing_rate FROM r
UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), (count(*) - count(user_id)) / count(*) FROM r""")
def null_rate_report(spark, d):
    e = tables.read(spark, d, "events")
    value = F.when(F.col("event_id") % 20 == 0, F.lit(float("nan"))).when(F.col("event_id") % 10 != 0, F.col("value"))
    return quality.null_rates(e.select(value.alias("value"), F.when(F.col("event_id") % 4 != 0, F.col("user_id")).alias("user_id")), ["value", "user_id"])


@query("SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT (l_discount BETWEEN 0.02 AND 0.08)) AS n_out FROM lineitem")
def range_check_lineitem(spark, d):
    return quality.out_of_range(tables.read(spark, d, "lineitem"), "l_discount", 0.02, 0.08)


@query("SELECT count(*) AS n_rows, count(*) >= 100 AS passed FROM orders")
def row_count_check(spark, d):
    return quality.row_count(tables.read(spark, d, "orders"), 100)


@query("""
SELECT epoch_us(p) AS previous_us, epoch_us(ts) AS current_us FROM (SELECT ts, lag(ts) OVER (ORDER BY ts) AS p FROM events)
WHERE abs((epoch_us(ts) - epoch_us(p)) / 60000000.0 - 5) > 1""")
def time_series_gaps_events(spark, d):
    return quality.gaps(tables.read(spark, d, "events"), "ts", 5).select(us("previous").alias("previous_us"), us("current").alias("current_us"))


@query("""
SELECT 'orders' AS dataset, 'row_count' AS check_name, '*' AS subject, CAST(count(*) AS DOUBLE) AS value, count(*) >= 1 AS passed FROM orders
UNION ALL SELECT 'orders', 'null_rate', 'o_orderkey', (count(*) - count(o_orderkey)) / count(*), (count(*) - count(o_orderkey)) / count(*) <= 0.05 FROM orders
UNION ALL SELECT 'orders', 'null_rate', 'o_custkey', (count(*) - count(o_custkey)) / count(*), (count(*) - count(o_custkey)) / count(*) <= 0.05 FROM orders
UNION ALL SELECT 'orders', 'null_rate', 'o_totalprice', (count(*) - count(CASE WHEN o_orderstatus <> 'P' THEN 1 END)) / count(*), (count(*) - count(CASE WHEN o_orderstatus <> 'P' THEN 1 END)) / count(*) <= 0.05 FROM orders
UNION ALL SELECT 'orders', 'duplicates', 'o_custkey', CAST(count(*) AS DOUBLE), count(*) = 0 FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def quality_report(spark, d):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return quality.report(tables.read(spark, d, "orders").withColumn("o_totalprice", price), "orders", ["o_custkey"])


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT coalesce(o_totalprice > 1000, false)) AS price, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS status FROM orders""")
def fail_soft_rules(spark, d):
    return quality.rule_counts(tables.read(spark, d, "orders"), {"price": F.col("o_totalprice") > 1000, "status": F.col("o_orderstatus").isin("F", "O")})


@query("""
WITH e AS (SELECT event_type, date_trunc('hour', ts) AS h, max(event_id) AS event_id FROM events GROUP BY 1, 2),
span AS (SELECT event_type, min(h) AS a, max(h) AS b FROM e GROUP BY 1),
grid AS (SELECT event_type, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS h FROM span)
SELECT grid.event_type, epoch_us(grid.h) AS hour_us, last_value(e.event_id IGNORE NULLS) OVER (PARTITION BY grid.event_type ORDER BY grid.h ROWS UNBOUNDED PRECEDING) AS event_id
FROM grid LEFT JOIN e ON e.event_type = grid.event_type AND e.h = grid.h""")
def sparse_curve_forward_fill(spark, d):
    e = tables.read(spark, d, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("h")).agg(F.max("event_id").alias("event_id"))
    out = forward_fill(e, ["event_type"], "h", ["event_id"], "INTERVAL 1 HOUR")
    return out.select("event_type", us("h").alias("hour_us"), "event_id")


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'planned' WHEN 'O' THEN 'unplanned' ELSE 'unmapped' END AS mapped,
  CASE o_orderstatus WHEN 'F' THEN 'planned' WHEN 'O' THEN 'unplanned' ELSE o_orderstatus END AS passed FROM orders""")
def enum_map_unmapped(spark, d):
    names = {"F": "planned", "O": "unplanned"}
    return tables.read(spark, d, "orders").select("o_orderkey", S.enum(F.col("o_orderstatus"), names).alias("mapped"), S.enum_or_raw(F.col("o_orderstatus"), names).alias("passed"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'EUR' WHEN p_partkey % 3 = 1 THEN 'EUR' ELSE 'GBP' END AS currency,
  trim(regexp_replace(lower('  ' || p_name || ' -- ' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part""")
def currency_and_slug(spark, d):
    raw = F.when(F.col("p_partkey") % 3 == 0, F.lit("  ")).when(F.col("p_partkey") % 3 == 2, F.lit(" GBP "))
    name = F.concat(F.lit("  "), "p_name", F.lit(" -- "), "p_brand")
    return tables.read(spark, d, "part").select("p_partkey", S.currency(raw).alias("currency"), S.slug(name).alias("slug"))


@query("""
SELECT p_partkey, p_size * CASE p_partkey % 4 WHEN 0 THEN 1e-6 WHEN 1 THEN 24e-6 WHEN 2 THEN 1e-3 END AS gwh_day FROM part WHERE p_partkey % 4 <> 3""")
def unit_normalise(spark, d):
    unit = F.element_at(F.array(*[F.lit(x) for x in (" kWh/d", "KWH/h", "MWh/day ", "therms")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = tables.read(spark, d, "part").withColumn("unit", unit).filter(S.known_unit(F.col("unit")))
    return rows.select("p_partkey", S.to_gwh_day(F.col("p_size"), F.col("unit")).alias("gwh_day"))


@query("""
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN greatest(0.0, 15.5 - value) END AS hdd, CASE WHEN event_id % 9 <> 0 THEN greatest(0.0, value - 22.0) END AS cdd,
  CASE WHEN event_id % 9 <> 0 THEN round(1013.0 * 100 / (287.05 * (value + 273.15)), 9) END AS density FROM events""")
def degree_days_density(spark, d):
    t = F.when(F.col("event_id") % 9 != 0, F.col("value"))
    return tables.read(spark, d, "events").select("event_id", S.heating_degrees(t).alias("hdd"), S.cooling_degrees(t).alias("cdd"), F.round(S.air_density(F.lit(1013.0), t), 9).alias("density"))


@query("""
SELECT p_partkey, CASE WHEN p_size - 5 > 0 THEN least(greatest(p_retailprice / (p_size - 5) * 100, 0), 100) END AS pct FROM part""")
def percent_full_parts(spark, d):
    return tables.read(spark, d, "part").select("p_partkey", S.percent_full(F.col("p_retailprice"), F.col("p_size") - 5).alias("pct"))


_START, _END = datetime(2024, 1, 10), datetime(2024, 1, 20)


@query("SELECT event_id FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-20' AND user_id % 2 = 0)")
def window_filter_closed(spark, d):
    return windows.closed_filter(tables.read(spark, d, "events"), "ts", F.lit(_END), F.col("user_id") % 2 == 0).select("event_id")


@query("SELECT event_id FROM events WHERE event_id % 11 = 0 OR (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20')")
def window_filter_half_open(spark, d):
    rows = tables.read(spark, d, "events").withColumn("ts", F.when(F.col("event_id") % 11 != 0, F.col("ts")))
    return windows.half_open_filter(rows, "ts", F.lit(_START), F.lit(_END)).select("event_id")


@query("""
SELECT event_type, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20') AS kept,
  count(*) FILTER (WHERE NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20')) AS dropped, CAST(0 AS BIGINT) AS undated FROM events GROUP BY 1""")
def window_accounting(spark, d):
    return windows.window_counts(tables.read(spark, d, "events"), "ts", F.lit(_START), F.lit(_END), "event_type")


@query("""
WITH b AS (SELECT event_type, min(ts) AS a, max(ts) AS z FROM events GROUP BY 1),
g AS (SELECT event_type, a, z, unnest(generate_series(CAST(a::DATE AS TIMESTAMP), CAST(z::DATE AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM b)
SELECT event_type, epoch_us(greatest(a, d)) AS start_us, epoch_us(least(z, d + INTERVAL 1 DAY)) AS end_us FROM g WHERE greatest(a, d) < z""")
def subwindows_per_day(spark, d):
    b = tables.read(spark, d, "events").groupBy("event_type").agg(F.min("ts").alias("a"), F.max("ts").alias("z"))
    cut = b.select("event_type", F.explode(C.day_subwindows(F.col("a"), F.col("z"))).alias("w"))
    return cut.select("event_type", us("w.start").alias("start_us"), us("w.end").alias("end_us"))


@query("""
WITH p AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders WHERE isodow(o_orderdate) = 1), w AS (SELECT DISTINCT o_orderdate::DATE AS want FROM orders)
SELECT CAST(want AS VARCHAR) AS want, CAST(max(day) AS VARCHAR) AS got FROM w LEFT JOIN p ON day <= want AND day >= want - 35 GROUP BY 1""")
def covering_partition_asof(spark, d):
    days = tables.read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    out = tables.covering_partition(days.select(F.col("day").alias("want")).distinct(), days.filter(C.iso_weekday(F.col("day")) == 1).distinct(), 35)
    return out.select(F.col("want").cast("string"), F.col("got").cast("string"))


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_shipdate::DATE <= DATE '1998-06-15' AND CASE WHEN l_linenumber % 3 = 0 THEN l_shipdate::DATE ELSE l_shipdate::DATE + 10 END >= DATE '1998-06-15' OR l_linenumber = 7""")
def overlap_filter(spark, d):
    start, seven = F.col("l_shipdate").cast("date"), F.col("l_linenumber") == 7
    end = F.when(F.col("l_linenumber") % 3 != 0, F.date_add(start, 10))
    keep = windows.overlaps_day(F.when(~seven, start), F.when(~seven, end), F.lit("1998-06-15").cast("date"))
    return tables.read(spark, d, "lineitem").filter(keep).select("l_orderkey", "l_linenumber")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 'undated' WHEN o_orderdate::DATE BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
  OR (o_orderkey % 4 = 1 AND o_orderdate::DATE + 30 BETWEEN DATE '1998-01-01' AND DATE '1999-01-29') THEN 'overlap' ELSE 'outside' END AS class FROM orders""")
def classify_windows_orders(spark, d):
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 4
    start, end, ref = F.when(k.isin(0, 1), day), F.when(k == 1, F.date_add(day, 30)), F.when(k == 2, day)
    a, b = (F.lit(x).cast("date") for x in ("1998-01-01", "1998-12-31"))
    return tables.read(spark, d, "orders").select("o_orderkey", windows.classify_event(start, end, ref, a, b).alias("class"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE event_id % 3 WHEN 0 THEN CAST(json_extract(props, '$.k') AS DOUBLE) / 2 ELSE -1.0 END AS half FROM events")
def json_props_extract(spark, d):
    text = F.when(F.col("event_id") % 3 == 0, (F.get_json_object("props", "$.k").cast("double") / 2).cast("string")).when(F.col("event_id") % 3 == 1, F.lit("")).otherwise(F.lit("n/a"))
    p = F.from_json(F.to_json(F.struct(F.get_json_object("props", "$.k").cast("long").alias("k"), text.alias("half"))), "k long, half string")
    return tables.read(spark, d, "events").withColumn("p", p).select("event_id", "p.k", F.coalesce(S.safe_double(F.col("p.half")), F.lit(-1.0)).alias("half"))


@query("""
SELECT o_orderkey AS id, o_totalprice AS amount, NULL::VARCHAR AS event_type FROM orders UNION ALL SELECT event_id, value, event_type FROM events""")
def union_by_name(spark, d):
    a = tables.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    b = tables.read(spark, d, "events").select("event_type", F.col("event_id").alias("id"), F.col("value").alias("amount"))
    return tables.union_all([a, b])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'")
def date_range_orders(spark, d):
    rows = tables.in_date_range(tables.read(spark, d, "orders"), "o_orderdate", "1997-01-01", "1997-03-31")
    return rows.select("o_orderkey", "o_custkey")


@query("SELECT * EXCLUDE (ts, props) FROM events")
def serving_exclude(spark, d):
    return _client(spark, d, "events").query("SELECT * EXCLUDE (ts, props) FROM t_events")


@query("""
SELECT o_orderkey, epoch_us(o_orderdate) AS event_us, epoch_us(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE TIMESTAMP '2024-01-01' END) AS available_us, 'run-1' AS source_run_id, '1.0.0' AS dataset_version FROM orders""")
def bitemporal_stamp(spark, d):
    at = F.col("o_orderdate")
    rows = tables.read(spark, d, "orders").select("o_orderkey", at.alias("timestamp_utc"), F.when(F.col("o_orderkey") % 2 == 0, at + F.expr("INTERVAL 1 DAY")).alias("published_at"))
    out = bitemporal.stamp_rows(rows, "run-1", "1.0.0", F.lit(datetime(2024, 1, 1)))
    return out.select("o_orderkey", us("event_time").alias("event_us"), us("available_at").alias("available_us"), "source_run_id", "dataset_version")


@query("""
SELECT user_id, event_type, event_id FROM events WHERE ts <= TIMESTAMP '2024-01-15' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def point_in_time_asof(spark, d):
    rows = tables.read(spark, d, "events").withColumnRenamed("ts", "available_at")
    return vintage.point_in_time(rows, vintage.LatestSpec(("user_id", "event_type")), F.lit(datetime(2024, 1, 15)), ("event_id",)).select("user_id", "event_type", "event_id")


@query("""
SELECT event_type AS dataset, epoch_us(greatest(max(ts), TIMESTAMP '2024-01-29 12:00:00')) AS last_end_us,
  epoch_us(greatest(greatest(max(ts), TIMESTAMP '2024-01-29 12:00:00') - INTERVAL 72 HOURS, TIMESTAMP '2024-02-01' - INTERVAL 168 HOURS)) AS start_us FROM events GROUP BY 1""")
def watermark_frontier(spark, d):
    e = tables.read(spark, d, "events")
    old = e.select(F.lit("test").alias("source"), F.col("event_type").alias("dataset"), F.lit(datetime(2024, 1, 29, 12)).alias("last_end")).distinct()
    new = e.groupBy(F.lit("test").alias("source"), F.col("event_type").alias("dataset")).agg(F.max("ts").alias("last_end"))
    out = state.raise_watermarks(old, new)
    return out.select("dataset", us("last_end").alias("last_end_us"), us(state.window_start(F.col("last_end"), F.lit(datetime(2024, 2, 1)))).alias("start_us"))


@query("""
SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = s_nationkey AND c_acctbal > 9900)""")
def unseen_units_anti_join(spark, d):
    return _client(spark, d, "supplier", "nation", "region", "customer").query("""
        SELECT s_suppkey, n_name, r_name FROM t_supplier LEFT ANTI JOIN t_customer ON c_nationkey = s_nationkey AND c_acctbal > 9900
        JOIN t_nation ON s_nationkey = n_nationkey JOIN t_region ON n_regionkey = r_regionkey""")


@query("""
SELECT coalesce(c_nationkey, -1) AS nation, coalesce(c_mktsegment, '*') AS segment, count(*) AS n FROM customer GROUP BY CUBE (c_nationkey, c_mktsegment)""")
def ad_hoc_cube(spark, d):
    return _client(spark, d, "customer").query("SELECT coalesce(c_nationkey, -1) AS nation, coalesce(c_mktsegment, '*') AS segment, count(*) AS n FROM t_customer GROUP BY CUBE (c_nationkey, c_mktsegment)")
