"""Sources, documents, payload recipes, sinks and the client on the driver's tables, beside SQL that gives the same rows.

Bodies and sidecars are made from whole tables in the shape in which the landing zone is listed, so
the operators that read them run as they do on files. Instants leave as microseconds since 1970.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import scalars as S
from ..operators import quality, state, vintage, windows
from ..sources import bronze, market_xml, tables
from ..streaming import ingest
from . import gold, retention, rules, runs, serving, silver
from .queries import query, us
from .registry import DATASETS, column_type, dataset, vendor_names


def bodies(rows: DataFrame, content: Column, stem: Column, day: Column | None = None, source: str | Column = "s", name: str | Column = "d", modified: Column | None = None, ext: str = ".json") -> DataFrame:
    """Rows as listed files."""
    col = lambda x: F.lit(x) if isinstance(x, str) else x
    day = F.lit("2024-06-01").cast("date") if day is None else day
    modified = F.lit(datetime(2024, 6, 1)) if modified is None else modified
    raw = content.cast("binary")
    made = rows.select(modified.alias("modified_at"), F.octet_length(raw).cast("long").alias("length"), raw.alias("content"), col(source).alias("source"), col(name).alias("dataset"), day.alias("day"), stem.cast("string").alias("stem"), F.lit(ext).alias("ext"))
    return made.withColumn("path", F.concat_ws("/", "source", "dataset", F.date_format("day", "yyyy/MM/dd"), F.concat("stem", "ext")))


def listed(pairs: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in pairs.items()]))


@query("""
SELECT event_id, value, CASE WHEN user_id % 4 = 3 THEN 0 ELSE row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 END AS ordinal FROM events""")
def json_shapes_events(spark, d):
    """Envelope, bare list, another list beside meta, a record alone; each user has a broken body too."""
    e = tables.read(spark, d, "events")
    one = F.struct("event_id", "value")
    by = e.groupBy("user_id").agg(F.to_json(F.array_sort(F.collect_list(one))).alias("r")).withColumn("k", F.col("user_id") % 4)
    text = F.when(F.col("k") == 0, F.concat(F.lit('{"data":'), "r", F.lit("}"))).when(F.col("k") == 1, F.col("r")).otherwise(F.concat(F.lit('{"meta":[1],"other":'), "r", F.lit("}")))
    files = bodies(by.filter("k < 3"), text, F.col("user_id")).unionByName(bodies(by, F.lit("{broken"), F.col("user_id") + 1000))
    files = files.unionByName(bodies(e.filter("user_id % 4 = 3"), F.concat(F.lit('{"data":'), F.to_json(one), F.lit("}")), F.col("event_id") + 100_000))
    r = bronze.json_records(files).withColumn("f", F.from_json("record", "event_id long, value double"))
    return r.select("f.event_id", "f.value", F.col("ordinal").cast("long").alias("ordinal"))


def _vouching(spark, d):
    o = tables.read(spark, d, "orders").withColumn("k", F.col("o_orderkey") % 5)
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    side = F.when(F.col("k") == 1, F.lit("{nope")).when(F.col("k") == 2, listed({"page": F.lit(1)})).when(F.col("k") == 3, listed({"written_at": F.lit("never")})).otherwise(listed({"available_at": F.lit("?"), "written_at": at}))
    stem = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    kind = {"day": F.col("o_orderdate").cast("date"), "name": F.concat(F.lit("c"), "o_custkey"), "modified": F.timestamp_seconds(F.unix_timestamp("o_orderdate") + F.col("o_orderkey"))}
    return bodies(o, F.lit("[]"), stem, **kind).unionByName(bodies(o.filter("k > 0"), side, stem, ext=".meta.json", **kind))


@query("""
SELECT coalesce(['NO_SIDECAR', 'UNREADABLE_SIDECAR', 'NO_TIMESTAMP_KEY', 'UNPARSEABLE_TIMESTAMP'][o_orderkey % 5 + 1], 'sound') AS reason, count(*) AS n,
  CASE WHEN o_orderkey % 5 = 4 THEN epoch_us(max(o_orderdate)) ELSE -1 END AS last_us FROM orders GROUP BY o_orderkey % 5""")
def vouched_bodies_orders(spark, d):
    out = bronze.vouched(_vouching(spark, d)).groupBy(F.coalesce("reason", F.lit("sound")).alias("reason")).agg(F.count("*").alias("n"), F.max("stamp").alias("at"))
    return out.select("reason", "n", F.coalesce(us("at"), F.lit(-1).cast("long")).alias("last_us"))


@query("""
SELECT 'c' || o_custkey AS dataset, CAST(o_orderdate::DATE AS VARCHAR) AS day, lpad(CAST(max(o_orderkey) AS VARCHAR), 12, '0') AS stem FROM orders WHERE o_orderkey % 5 = 4 GROUP BY ALL""")
def newest_vouched_orders(spark, d):
    return bronze.newest_vouched(_vouching(spark, d)).select("dataset", F.col("day").cast("string"), "stem")


@query("""SELECT 'c' || o_custkey AS dataset, CAST(max_by(o_orderdate::DATE, epoch(o_orderdate) + o_orderkey) AS VARCHAR) AS day FROM orders GROUP BY 1""")
def latest_directory_orders(spark, d):
    return bronze.latest_directory(_vouching(spark, d)).select("dataset", F.col("day").cast("string"))


@query("""SELECT epoch_us(min(o_orderdate)) AS first_us, epoch_us(max(o_orderdate)) AS last_us, count(*) AS n_files FROM orders WHERE o_orderkey % 5 = 4""")
def stamp_span_orders(spark, d):
    return bronze.stamp_span(_vouching(spark, d)).select(us("first_stamp").alias("first_us"), us("last_stamp").alias("last_us"), "n_files")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN epoch_us(o_orderdate) ELSE -1 END AS published_us, CASE WHEN o_orderkey % 2 = 0 THEN epoch_us(o_orderdate) ELSE -1 END AS issued_us FROM orders""")
def portal_provenance_orders(spark, d):
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("wind_"), F.date_format("o_orderdate", "yyyyMMddHHmm"), F.lit(".csv"))).otherwise(F.lit("wind.csv"))
    params = F.create_map(F.lit("last_modified"), F.when(F.col("o_orderkey") % 3 > 0, at), F.lit("filename"), name)
    o = tables.read(spark, d, "orders")
    files = bodies(o, listed({"request_params": params}), F.col("o_orderkey"), ext=".meta.json")
    side = bronze.sidecars(files)
    gone = F.lit(-1).cast("long")
    return side.select(F.col("stem").cast("long").alias("o_orderkey"), F.coalesce(us(bronze.published_from(F.col("meta"))), gone).alias("published_us"), F.coalesce(us(bronze.issue_time(F.col("meta"))), gone).alias("issued_us"))


@query("""SELECT p_brand AS path, p_partkey, '"' || p_name || '", ' || p_type || chr(10) || 'x' AS label, CAST(p_retailprice AS DOUBLE) AS price FROM part""")
def csv_contract_part(spark, d):
    """A file a brand; labels hold quotes, commas and line breaks; the header has blanks and a byte order mark."""
    label = F.concat(F.lit('"'), "p_name", F.lit('", '), "p_type", F.lit("\nx"))
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), F.concat(F.lit('"'), F.replace(label, F.lit('"'), F.lit('""')), F.lit('"')), F.col("p_retailprice").cast("string"))
    by = tables.read(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    text = F.concat(F.lit("﻿id, label ,price\r\n"), F.array_join("lines", "\r\n"), F.lit("\r\n\r\n"))
    rows = bronze.csv_rows(by.select(F.col("p_brand").alias("path"), text.cast("binary").alias("content")), ("id", "label", "price"))
    return rows.select("path", F.col("id").cast("long").alias("p_partkey"), "label", S.safe_double(F.col("price")).alias("price"))


# -- market documents

_STARTS = ("2024-01-31T00:00Z", "2024-01-31T00:00:00Z", "2024-01-31 00:00:00", "2024-01-31")
_STEPS = ("PT15M", "PT30M", "PT60M", "P1D", "P7D", "P1M", "P1Y", "PT7M")


def _nth(values: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (i % len(values) + 1).cast("int"))


def _tagged(tag: str | Column, inner: Column) -> Column:
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.concat(F.lit("<"), tag, F.lit(">"), inner, F.lit("</"), tag, F.lit(">"))


def _points(rows: DataFrame, key: str, position: Column, value: Column, order: Column, tag: str = "price.amount") -> DataFrame:
    """(key, points): a document's points in order; a null position or value has no element."""
    inner = F.concat(F.coalesce(_tagged("position", position.cast("string")), F.lit("")), F.coalesce(_tagged(tag, value), F.lit("")))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), _tagged("Point", inner).alias("x")))), lambda s: s["x"]), "").alias("points"))


def _orders_documents(spark, d) -> DataFrame:
    o = tables.read(spark, d, "orders").withColumn("rn", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")))
    value = F.when(F.col("rn") % 11 == 0, F.lit("x")).when(F.col("rn") % 7 == 0, F.lit("")).otherwise(F.col("o_totalprice").cast("string"))
    p = _points(o, "o_custkey", F.when(F.col("rn") % 13 > 0, F.col("rn")), value, F.col("rn"))
    k = F.col("o_custkey")
    start, tag = _nth(_STARTS, k), _nth(market_xml.PERIODS, k)
    interval = F.when(k % 2 == 0, _tagged("timeInterval", _tagged("start", start))).otherwise(_tagged("timeInterval.start", start))
    period = _tagged(tag, F.concat(interval, _tagged("resolution", _nth(_STEPS, k)), F.col("points")))
    # of variants of one attribute the last counts
    series = F.concat(_tagged("mRID", k.cast("string")), _tagged("In_Domain.mRID", F.lit("first")), _tagged("in_Domain.mRID", F.lit("10YFR-RTE------C")), _tagged("curveType", F.lit("A01")), period, _tagged("Reason", _tagged("code", F.concat(F.lit("B"), k))))
    text = F.concat(F.lit('<?xml version="1.0"?><Publication_MarketDocument xmlns="urn:'), k, F.lit('">'), _tagged("mRID", F.concat(F.lit("D"), k)), _tagged("createdDateTime", F.lit("2024-06-01T10:00:00Z")), _tagged("docStatus", _tagged("value", F.lit("A05"))), _tagged("TimeSeries", series), F.lit("</Publication_MarketDocument>"))
    return bodies(p, text, k, ext=".xml")


_ORDER_STEP = """CASE o_custkey % 8 WHEN 0 THEN TIMESTAMP '2024-01-31' + to_minutes(15 * (rn - 1)) WHEN 1 THEN TIMESTAMP '2024-01-31' + to_minutes(30 * (rn - 1)) WHEN 2 THEN TIMESTAMP '2024-01-31' + to_hours(rn - 1)
  WHEN 3 THEN TIMESTAMP '2024-01-31' + to_days(CAST(rn - 1 AS INTEGER)) WHEN 4 THEN TIMESTAMP '2024-01-31' + to_days(CAST(7 * (rn - 1) AS INTEGER)) WHEN 5 THEN TIMESTAMP '2024-01-31' + to_months(CAST(rn - 1 AS INTEGER))
  WHEN 6 THEN TIMESTAMP '2024-01-31' + to_years(CAST(rn - 1 AS INTEGER)) ELSE TIMESTAMP '2024-01-31' + to_hours(rn - 1) END"""


@query(f"""
SELECT CAST(o_custkey AS VARCHAR) AS series, rn AS position, epoch_us({_ORDER_STEP}) AS at_us, CASE WHEN rn % 7 = 0 THEN -1.0 ELSE o_totalprice END AS value, 'D' || o_custkey AS document_mrid,
  '10YFR-RTE------C' AS in_domain, 'B' || o_custkey AS reason_code, 'A05' AS document_status_doc, '2024-06-01T10:00:00Z' AS document_created_at
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn % 13 > 0 AND rn % 11 > 0""")
def market_documents_orders(spark, d):
    """A document a customer: four ways to write an instant, eight resolutions, three names of a period, values that are no number or empty."""
    out = market_xml.read_documents(_orders_documents(spark, d))
    return out.select(F.col("timeseries_mrid").alias("series"), "position", us("timestamp_utc").alias("at_us"), F.nanvl("value", F.lit(-1.0)).alias("value"), "document_mrid", "in_domain", "reason_code", "document_status_doc", "document_created_at")


@query("""
WITH e AS (SELECT event_type, event_id, CAST(epoch(date_trunc('hour', ts)) - epoch(TIMESTAMP '2024-01-01') AS BIGINT) // 3600 + 1 AS p FROM events),
m AS (SELECT event_type, p, max(event_id) AS last FROM e GROUP BY ALL),
g AS (SELECT event_type, unnest(generate_series(min(p), 744)) AS p FROM m GROUP BY 1),
f AS (SELECT g.event_type, g.p, m.last, last_value(m.last IGNORE NULLS) OVER (PARTITION BY g.event_type ORDER BY g.p) AS v FROM g LEFT JOIN m ON m.event_type = g.event_type AND m.p = g.p)
SELECT event_type, p AS position, CAST(event_id AS DOUBLE) AS value FROM e UNION ALL SELECT event_type, p, CAST(v AS DOUBLE) FROM f WHERE last IS NULL""")
def market_curves_events(spark, d):
    """Sparse curves of January: gaps take the last declared value, all declared ones stay."""
    hour = (F.unix_timestamp(F.date_trunc("hour", "ts")) - F.unix_timestamp(F.lit(datetime(2024, 1, 1)))) / 3600
    e = tables.read(spark, d, "events").withColumn("p", hour.cast("long") + 1)
    p = _points(e, "event_type", F.col("p"), F.col("event_id").cast("string"), F.struct("p", "event_id"), "quantity")
    interval = F.lit("<timeInterval><start>2024-01-01T00:00Z</start><end>2024-02-01T00:00Z</end></timeInterval><resolution>PT60M</resolution>")
    series = F.concat(_tagged("mRID", F.col("event_type")), F.lit("<curveType>A03</curveType>"), _tagged("Period", F.concat(interval, F.col("points"))))
    files = bodies(p, _tagged("GL_MarketDocument", _tagged("TimeSeries", series)), F.col("event_type"), ext=".xml")
    return market_xml.read_documents(files, "quantity").select(F.col("timeseries_mrid").alias("event_type"), "position", "value")


@query("""
SELECT CAST(s_nationkey AS VARCHAR) AS nation, count(*) AS n, sum(CASE WHEN s_nationkey % 6 = 5 THEN 2.0 * s_acctbal ELSE s_acctbal END) AS total FROM supplier WHERE s_nationkey % 6 IN (0, 1, 5) GROUP BY 1""")
def market_refusals_supplier(spark, d):
    """Unsound, entity-bearing and ambiguous documents give no rows; bids may come under another series and value name."""
    s = tables.read(spark, d, "supplier")
    k = F.col("s_nationkey")
    tag = F.when(k % 6 == 5, F.lit("quantity.quantity")).otherwise(F.lit("quantity"))
    value = F.when(k % 6 == 5, F.col("s_acctbal") * 2).otherwise(F.col("s_acctbal")).cast("string")
    twice = F.when(k % 6 == 4, _tagged("quantity.quantity", value)).otherwise(F.lit(""))
    point = _tagged("Point", F.concat(_tagged("position", F.col("s_suppkey").cast("string")), _tagged(tag, value), twice))
    by = s.groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list(point)), "").alias("points"))
    period = _tagged("Period", F.concat(F.lit("<timeInterval><start>2024-01-01T00:00Z</start></timeInterval><resolution>PT60M</resolution>"), F.col("points")))
    name = F.when(k % 6 == 5, F.lit("Bid_TimeSeries")).otherwise(F.lit("TimeSeries"))
    series = _tagged(name, F.concat(_tagged("mRID", k.cast("string")), period))
    more = F.when(k % 6 == 3, F.lit("<Bid_TimeSeries/>")).otherwise(F.lit(""))
    doctype = F.when(k % 6 == 2, F.concat(F.lit("<!--"), F.repeat(F.lit("x"), 5000), F.lit('--><!DOCTYPE a [<!ENTITY b "c">]>'))).otherwise(F.lit(""))
    text = F.concat(doctype, _tagged(F.when(k % 6 == 0, F.lit("Balancing_MarketDocument")).otherwise(F.lit("ReserveBid_MarketDocument")), F.concat(series, more)))
    found = market_xml.read_documents(bodies(by, text, k, ext=".xml").unionByName(bodies(by, F.lit("<broken"), k + 100, ext=".xml")), "quantity")
    return found.groupBy(F.col("timeseries_mrid").alias("nation")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("""
SELECT 'N' || s_nationkey AS area_code, u || s_suppkey AS unit_mrid, CASE u WHEN 'U' THEN s_name ELSE 'g' END AS unit_name FROM supplier, (VALUES ('U'), ('G')) t(u)""")
def market_units_supplier(spark, d):
    """Master data: units of series, then generating units inside them that weren't seen."""
    unit = F.concat(_tagged("biddingZone_Domain.mRID", F.concat(F.lit("N"), "s_nationkey")), _tagged("GeneratingUnit_PowerSystemResources", F.concat(_tagged("mRID", F.concat(F.lit("G"), "s_suppkey")), F.lit("<name>g</name>"))), _tagged("registeredResource.mRID", F.concat(F.lit("U"), "s_suppkey")), _tagged("registeredResource.name", F.col("s_name")))
    by = tables.read(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.collect_list(_tagged("TimeSeries", unit)), "").alias("x"))
    found = market_xml.read_units(bodies(by, _tagged("Configuration_MarketDocument", F.col("x")), F.col("s_nationkey"), ext=".xml"))
    return silver.transform(found, dataset("entsoe", "generation_units_master_data")).select("area_code", "unit_mrid", "unit_name")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS series, CAST(n_nationkey AS DOUBLE) AS value, CAST(n AS BIGINT) AS ordinal FROM nation, range(2) t(n)""")
def market_archives_nation(spark, d):
    """Zip payloads: an entry is a body; entries that aren't XML are passed over."""
    import pyarrow as pa

    def zipped(batches):
        import io
        import zipfile

        for batch in batches:
            made = []
            for text in batch.column(1).to_pylist():
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w") as z:
                    for name in ("b.xml", "a.XML", "c.txt"):
                        z.writestr(name, text)
                made.append(out.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["k", "z"])

    k = F.col("n_nationkey").cast("string")
    series = F.concat(_tagged("mRID", k), F.lit("<Period><timeInterval><start>2024-01-01</start></timeInterval>"), _tagged("Point", F.concat(F.lit("<position>1</position>"), _tagged("DayAhead_Price.amount", k))), F.lit("</Period>"))
    n = tables.read(spark, d, "nation").select(k.alias("k"), _tagged("Publication_MarketDocument", _tagged("TimeSeries", series)).alias("t"))
    found = market_xml.read_documents(bodies(n.mapInArrow(zipped, "k string, z binary"), F.col("z"), F.col("k"), ext=".zip"))
    return found.select(F.col("timeseries_mrid").alias("series"), "value", "ordinal")


# -- all declared datasets, on the rows of one table


def _expected_point(d, column: str) -> str | None:
    """SQL for a text column of a market document's silver row, for nation n."""
    fixed = {"currency": "'EUR'", "reserve_type": "'afrr'", "business_type": "'A96'", "area_name": "''", "resolution": "'PT60M'"}
    if column in fixed:
        return fixed[column]
    if column == "direction":
        return "'unmapped'" if d.options.get("directions") == "imbalance" else "'up'"
    if column == "outage_type":
        return "'unmapped'" if d.options.get("outages") == "mapped" else "'A96'"
    if column in d.options.get("constants", {}):
        return f"'{d.options['constants'][column]}'"
    source = {"area_code": "control_area_domain", "in_area_code": "in_domain", "out_area_code": "out_domain", "acquiring_area_code": "acquiring_domain", "connecting_area_code": "connecting_domain", "bid_mrid": "timeseries_mrid"}.get(column, column)
    if source in market_xml.PLAIN:
        return f"'{source}-' || n_nationkey"
    return {"document_mrid": "'doc'", "reason_code": "''"}.get(source)


_XML = [d for d in DATASETS.values() if d.recipe == "xml"]
_TEXTS = {d.name: [c for c in d.columns if _expected_point(d, c)] for d in _XML}


@query(" UNION ALL ".join(f"SELECT '{d.name}' AS dataset, n_nationkey::BIGINT AS n, {' || chr(124) || '.join(_expected_point(d, c) for c in _TEXTS[d.name])} AS texts, CAST(n_nationkey + 0.5 AS DOUBLE) AS value, 1717200000000000 + 3600000000 * n_nationkey AS at_us FROM nation" for d in _XML))
def market_datasets_nation(spark, d):
    """Every declared dataset of market documents, on one document for each nation."""
    fixed = {"currency_unit": "EUR", "business_type": "A96", "flow_direction": "A01", "curve_type": "A01"}
    n = F.col("n_nationkey").cast("string")
    attributes = [_tagged(tags[0], F.lit(fixed[a]) if a in fixed else F.concat(F.lit(f"{a}-"), n)) for a, tags in market_xml.PLAIN.items()]
    value = (F.col("n_nationkey") + 0.5).cast("string")
    point = _tagged("Point", F.concat(_tagged("position", (F.col("n_nationkey") + 1).cast("string")), _tagged("quantity", value), _tagged("price.amount", value)))
    period = _tagged("Period", F.concat(F.lit("<timeInterval><start>2024-06-01T00:00Z</start></timeInterval><resolution>PT60M</resolution>"), point))
    text = _tagged("X_MarketDocument", F.concat(F.lit("<mRID>doc</mRID>"), _tagged("TimeSeries", F.concat(*attributes, period))))
    files = bodies(tables.read(spark, d, "nation"), text, n, ext=".xml")
    path = tables.scratch(spark, "points")
    tables.write(market_xml.read_documents(files, "quantity").withColumn("n", F.regexp_extract("timeseries_mrid", "([0-9]+)$", 1).cast("long")), f"{path}/p")
    points = spark.read.parquet(f"{path}/p")
    out = []
    for x in _XML:
        made = silver.transform(points, x)
        measure = next(c for c in x.columns if c.endswith(("price_eur_mwh", "amount_eur", "_mw", "_mwh")))
        at = us("timestamp_utc")
        out.append(made.select(F.lit(x.name).alias("dataset"), F.col(measure).alias("value"), at.alias("at_us"), F.concat_ws("|", *_TEXTS[x.name]).alias("texts"), ((at - 1717200000000000) / 3600000000).cast("long").alias("n")))
    return tables.union_all(out)


_JSON = [d for d in DATASETS.values() if d.recipe == "json"]
_SKIP = ("timestamp_utc", "data_provider", "ingested_at")


def _json_value(d, column: str) -> tuple[str, str] | None:
    """(SQL for what a vendor sends, SQL for what silver holds as text) for a declared column."""
    kind = column_type(column)
    if column in _SKIP:
        return None
    if column == "settlement_period":
        return "CAST(n_nationkey + 1 AS VARCHAR)", "CAST(n_nationkey + 1 AS VARCHAR)"
    if kind == "date":
        return "'2024-06-01'", "'2024-06-01'"
    if kind == "timestamp":
        return "'2024-06-01T10:30:00Z'", "'2024-06-01 10:30:00'"
    if kind == "int":
        return "CAST(n_nationkey AS VARCHAR)", "CAST(n_nationkey AS VARCHAR)"
    if kind == "double":
        return "CAST(n_nationkey AS VARCHAR) || '.25'", "CAST(n_nationkey AS VARCHAR) || '.25'"
    if kind == "boolean":
        return "'true'", "'true'"
    return f"'{column[:3]}' || n_nationkey", f"'{column[:3]}' || n_nationkey"


def _shared_fields(d) -> set[str]:
    """Columns that take the same vendor field as an earlier one of the dataset."""
    seen, out = set(), set()
    for c in d.columns:
        if c not in _SKIP:
            names = set(vendor_names(c))
            if names & seen:
                out.add(c)
            seen |= names
    return out


_PLAIN = {d.name: [c for c in d.columns if _json_value(d, c) and c not in _shared_fields(d)] for d in _JSON}


@query(" UNION ALL ".join(f"SELECT '{d.source}.{d.name}' AS dataset, {' || chr(124) || '.join(_json_value(d, c)[1] for c in _PLAIN[d.name])} AS texts FROM nation" for d in _JSON if any(column_type(k) not in ("date", "timestamp") for k in d.key)))
def json_datasets_nation(spark, d):
    """Every declared JSON dataset whose key tells the nations apart, on one record for each nation under the vendor's own names."""
    n = tables.read(spark, d, "nation")
    out = []
    for x in _JSON:
        if not any(column_type(k) not in ("date", "timestamp") for k in x.key):
            continue
        fields = {vendor_names(c)[0]: _json_value(x, c)[0] for c in _PLAIN[x.name]}
        helper = {"start_time": "startTime", "measured_at": "measurementTime", "published_at": "publishTime"}.get(x.clock)
        if helper and helper not in fields:
            fields[helper] = "'2024-06-01T10:30:00Z'"
        record = F.to_json(F.struct(*[F.expr(sql.replace("VARCHAR", "STRING")).alias(k) for k, sql in fields.items()]))
        files = bodies(n, F.concat(F.lit('{"data":['), record, F.lit("]}")), F.col("n_nationkey"))
        made = silver.transform(bronze.json_records(files), x)
        out.append(made.select(F.lit(f"{x.source}.{x.name}").alias("dataset"), F.concat_ws("|", *[F.col(c).cast("string") for c in _PLAIN[x.name]]).alias("texts")))
    return tables.union_all(out)


# -- nested payloads


def _records(rows: DataFrame, record: Column, stem: Column, meta: Column | None = None) -> DataFrame:
    files = bodies(rows, F.concat(F.lit('{"data":['), record, F.lit("]}")), stem)
    if meta is None:
        return bronze.json_records(files)
    side = bodies(rows, meta, stem, ext=".meta.json")
    return bronze.json_records(bronze.vouched(files.unionByName(side)))


def _minutes(n: Column) -> Column:
    """An instant of 2024 to the minute, as carbon payloads write it."""
    return F.date_format(F.timestamp_seconds(F.lit(1704067200) + n * 60), "yyyy-MM-dd'T'HH:mm'Z'")


@query("""
SELECT (1704067200 + event_id * 60) * 1000000 AS from_us, (1704067200 + event_id * 60 + 1800) * 1000000 AS to_us, value AS forecast, CASE WHEN event_id % 3 > 0 THEN value + 1 ELSE -1 END AS actual, event_type AS intensity_index FROM events""")
def carbon_intensity_events(spark, d):
    k = F.col("event_id")
    inner = F.struct(F.col("value").alias("forecast"), F.when(k % 3 > 0, F.col("value") + 1).alias("actual"), F.col("event_type").alias("index"))
    r = F.to_json(F.struct(_minutes(k).alias("from"), _minutes(k + 30).alias("to"), inner.alias("intensity")))
    out = silver.transform(_records(tables.read(spark, d, "events"), r, k), dataset("neso", "carbon_intensity"))
    return out.select(us("timestamp_utc").alias("from_us"), us("period_end_utc").alias("to_us"), F.col("forecast_gco2_kwh").alias("forecast"), F.coalesce("actual_gco2_kwh", F.lit(-1.0)).alias("actual"), "intensity_index")


@query("SELECT trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '_', 'g'), '_') AS fuel, s_acctbal AS factor FROM supplier")
def carbon_factors_supplier(spark, d):
    s = tables.read(spark, d, "supplier")
    out = silver.transform(_records(s, F.to_json(F.create_map("s_name", "s_acctbal")), F.col("s_suppkey")), dataset("neso", "intensity_factors"))
    return out.select("fuel", F.col("factor_gco2_kwh").alias("factor"))


@query("SELECT (1704067200 + user_id * 60) * 1000000 AS from_us, event_type AS fuel, CAST(count(*) AS DOUBLE) AS pct FROM events GROUP BY user_id, event_type")
def carbon_generation_events(spark, d):
    mix = tables.read(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.collect_list(F.struct(F.col("event_type").alias("fuel"), F.col("n").alias("perc"))).alias("generationmix"))
    r = F.to_json(F.struct(_minutes(F.col("user_id")).alias("from"), _minutes(F.col("user_id") + 30).alias("to"), "generationmix"))
    out = silver.transform(_records(mix, r, F.col("user_id")), dataset("neso", "generation"))
    return out.select(us("timestamp_utc").alias("from_us"), "fuel", F.col("generation_pct").alias("pct"))


@query("""
SELECT n_nationkey::BIGINT AS regionid, n_name AS shortname, CAST(n_nationkey + 0.5 AS DOUBLE) AS forecast, CASE WHEN n_nationkey % 5 > 0 THEN fuel ELSE '' END AS fuel, CASE WHEN n_nationkey % 5 > 0 THEN pct ELSE -1 END AS pct
FROM nation, (VALUES ('gas', 40.0::DOUBLE), ('wind', 60.0)) t(fuel, pct) WHERE n_nationkey % 5 > 0 OR fuel = 'gas'""")
def carbon_regions_nation(spark, d):
    """Periods that hold regions, and regions that hold periods; a region without a mix gives one row."""
    n = tables.read(spark, d, "nation")
    k = F.col("n_nationkey")
    mix = F.when(k % 5 > 0, F.array(*[F.struct(F.lit(f).alias("fuel"), F.lit(p).alias("perc")) for f, p in (("gas", 40), ("wind", 60))])).otherwise(F.array().cast("array<struct<fuel:string,perc:int>>"))
    level = F.struct((k + 0.5).alias("forecast"), F.lit("low").alias("index"))
    region = F.struct(k.alias("regionid"), F.col("n_name").alias("shortname"), level.alias("intensity"), mix.alias("generationmix"))
    span = (_minutes(F.col("n_regionkey")).alias("from"), _minutes(F.col("n_regionkey") + 30).alias("to"))
    by = n.filter("n_regionkey % 2 = 0").groupBy("n_regionkey").agg(F.collect_list(region).alias("regions"))
    a = _records(by, F.to_json(F.struct(*span, "regions")), F.col("n_regionkey"))
    period = F.struct(*span, level.alias("intensity"), mix.alias("generationmix"))
    b = _records(n.filter("n_regionkey % 2 = 1"), F.to_json(F.struct(k.alias("regionid"), F.col("n_name").alias("shortname"), F.array(period).alias("data"))), k + 100)
    out = silver.transform(a.unionByName(b), dataset("neso", "regional_current"))
    return out.select(F.col("regionid").cast("long"), "shortname", F.col("forecast_gco2_kwh").alias("forecast"), F.coalesce("fuel", F.lit("")).alias("fuel"), F.coalesce("generation_pct", F.lit(-1.0)).alias("pct"))


@query("""
SELECT 'company' AS entity_level, n_name AS entity_name, '' AS company_name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'facility', s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def inventory_nation(spark, d):
    """Regions hold nations as companies, and these suppliers as facilities: one level deeper for each region; listings hold them side by side."""
    s = tables.read(spark, d, "supplier").join(tables.read(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    company = s.groupBy("n_regionkey", "n_nationkey", "n_name").agg(F.collect_list(F.struct(F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("eic"))).alias("facilities"))
    company = company.select("n_regionkey", F.struct(F.col("n_name").alias("name"), F.concat(F.lit("n"), "n_nationkey").alias("code"), "facilities").alias("c"))
    by = company.groupBy("n_regionkey").agg(F.collect_list("c").alias("cs"))
    deep = F.to_json(F.struct(F.col("cs").alias("Europe")))
    for r in range(1, 5):
        deep = F.when(F.col("n_regionkey") >= r, F.concat(F.lit('{"name":"group","x":'), deep, F.lit("}"))).otherwise(deep)
    x = dataset("gie_agsi", "about_summary")
    out = silver.transform(_records(by, deep, F.col("n_regionkey")), x)
    return out.select("entity_level", "entity_name", F.coalesce("company_name", F.lit("")).alias("company_name"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS point_label, o_totalprice AS capacity_value, epoch_us(o_orderdate) - CASE WHEN o_orderkey % 2 = 0 THEN 7200000000 ELSE 0 END AS at_us FROM orders""")
def dynamic_columns_orders(spark, d):
    """Columns found in the payload: names meet after normalising, numbers and instants are told by name, the last record of an id stays."""
    o = tables.read(spark, d, "orders")
    k = F.col("o_orderkey")
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    new = F.to_json(F.struct(k.cast("string").alias("id"), F.when(k % 2 == 0, F.concat(at, F.lit("+02:00"))).alias("periodFrom"), F.when(k % 2 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("period from"), F.col("o_totalprice").cast("string").alias("capacityValue"), F.col("o_orderpriority").alias("point-label")))
    old = F.to_json(F.struct(k.cast("string").alias("id"), F.lit("stale").alias("pointLabel")))
    files = bodies(o, F.concat(F.lit('{"meta":{},"interruptions":['), old, F.lit(","), new, F.lit("]}")), k)
    out = silver.transform(bronze.json_records(files, "interruptions"), dataset("entsog", "interruptions"))
    return out.select("id", "point_label", "capacity_value", us("timestamp_utc").alias("at_us"))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS point_key, CASE WHEN p_partkey % 13 = 1 THEN -1 ELSE p_size * CASE p_partkey % 5 WHEN 0 THEN 1e-6 WHEN 1 THEN 1e-3 WHEN 2 THEN 24e-3 ELSE 1e-6 END END AS gwh
FROM part WHERE p_partkey % 5 <> 4 AND p_partkey % 7 <> 0 AND p_partkey % 13 NOT IN (2, 3)""")
def gas_flows_part(spark, d):
    """Physical flows: other indicators, unknown units, broken and infinite values go; a blank value stays as none."""
    k = F.col("p_partkey")
    unit = F.element_at(F.array(F.lit("kWh/d"), F.lit(" MWh/day"), F.lit("MWH/h"), F.lit(None), F.lit("therm")), (k % 5 + 1).cast("int"))
    value = F.when(k % 13 == 1, F.lit(" ")).when(k % 13 == 2, F.lit("x")).when(k % 13 == 3, F.lit("Infinity")).otherwise(F.col("p_size").cast("string"))
    r = F.to_json(F.struct(F.when(k % 7 == 0, F.lit("GCV")).when(k % 7 < 4, F.lit("Physical Flow")).alias("indicator"), k.cast("string").alias("pointKey"), F.lit("2024-06-01T06:00:00+02:00").alias("periodFrom"), unit.alias("unit"), value.alias("value")))
    out = silver.transform(_records(tables.read(spark, d, "part"), r, k), dataset("entsog", "physical_flows"))
    return out.select("point_key", F.coalesce("flow_gwh_per_day", F.lit(-1.0)).alias("gwh"))


@query("""
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'facility' WHEN 1 THEN 'company' WHEN 2 THEN 'country' ELSE 'EU' END AS entity_level, CAST(o_orderkey AS VARCHAR) AS entity_code, CAST(o_orderdate::DATE AS VARCHAR) AS gas_day, o_totalprice AS stored, CASE WHEN o_orderkey % 4 <= 2 THEN 'DE' ELSE '' END AS country_code FROM orders""")
def gas_storage_orders(spark, d):
    """Storage reports take their level and country from the request; the last record of a day and entity stays."""
    k = F.col("o_orderkey")
    params = F.map_filter(F.create_map(F.lit("facility"), F.when(k % 4 == 0, F.lit("f")), F.lit("company"), F.when(k % 4 <= 1, F.lit("c")), F.lit("country"), F.when(k % 4 <= 2, F.lit("DE")), F.lit("type"), F.when(k % 4 == 3, F.lit("EU"))), lambda _, v: v.isNotNull())
    meta = listed({"written_at": F.lit("2024-06-02T01:00:00Z"), "request_params": params})
    one = lambda v: F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("gasDayStart"), k.cast("string").alias("code"), v.cast("string").alias("gasInStorage"), F.lit("").alias("full")))
    rows = _records(tables.read(spark, d, "orders"), F.concat(one(F.lit(0)), F.lit(","), one(F.col("o_totalprice")), F.lit(',{"gasDayStart":"x"}')), k, meta)
    out = silver.transform(rows, dataset("gie_agsi", "storage"))
    return out.select("entity_level", "entity_code", F.col("gas_day").cast("string"), F.col("gas_in_storage_gwh").alias("stored"), "country_code")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS country_code, p_retailprice AS level, CAST(p_size - 5 AS DOUBLE) AS capacity, CASE WHEN p_size > 5 THEN least(greatest(p_retailprice / (p_size - 5) * 100, 0), 100) ELSE -1 END AS pct FROM part""")
def lng_terminals_part(spark, d):
    limits = F.struct(F.lit("1").alias("lng"), (F.col("p_size") - 5).cast("string").alias("gwh"))
    r = F.to_json(F.struct(F.lit("2024-06-01").alias("gasDayStart"), F.col("p_partkey").cast("string").alias("code"), F.col("p_retailprice").cast("string").alias("lngInventory"), limits.alias("dtmi")))
    out = silver.transform(_records(tables.read(spark, d, "part"), r, F.col("p_partkey")), dataset("gie_alsi", "lng"))
    return out.select("country_code", F.col("lng_in_storage_gwh").alias("level"), F.col("dtmi_gwh").alias("capacity"), F.coalesce("lng_pct_full", F.lit(-1.0)).alias("pct"))


@query("""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT 'u' || user_id AS location, 1717200000000000 + i * 3600000000 AS at_us, value AS temperature, CASE WHEN i < n - 1 THEN round(value / 3.6, 9) ELSE -1 END AS wind_mps, round(greatest(0.0, 15.5 - value), 9) AS hdd FROM e""")
def weather_arrays_events(spark, d):
    """Hourly arrays become rows; the wind is one hour short, which pads with null."""
    by = tables.read(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "value"))).alias("v"))
    times = F.transform(F.sequence(F.lit(0), F.size("v") - 1), lambda i: F.date_format(F.timestamp_seconds(F.lit(1717200000) + i * 3600), "yyyy-MM-dd'T'HH:mm"))
    values = F.transform("v", lambda x: x["value"])
    hourly = F.struct(times.alias("time"), values.alias("temperature_2m"), F.slice(values, 1, F.size("v") - 1).alias("wind_speed_10m"))
    rows = by.select(F.col("user_id").cast("string").alias("path"), F.lit(0).alias("ordinal"), F.to_json(F.struct(F.lit(51.5).alias("latitude"), hourly.alias("hourly"))).alias("record"), F.concat(F.lit("u"), "user_id").alias("location"))
    out = silver.transform(rows, dataset("open_meteo", "historical_demand"))
    return out.select("location", us("timestamp_utc").alias("at_us"), F.col("temperature_2m_c").alias("temperature"), F.coalesce(F.round("wind_speed_10m_mps", 9), F.lit(-1.0)).alias("wind_mps"), F.round("hdd_k", 9).alias("hdd"))


@query("""SELECT p_brand AS bmu_id, count(*) AS n, sum(p_retailprice) AS mw FROM (SELECT p_brand, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey DESC) = 1) GROUP BY 1""")
def portal_wind_part(spark, d):
    """Portal files as CSV: the last line of a unit and day stays, dated by the file's own publication."""
    line = F.concat_ws(",", "p_brand", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd"), F.col("p_retailprice").cast("string"))
    by = tables.read(spark, d, "part").groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("x")))), lambda r: r["x"]).alias("lines"))
    rows = bronze.csv_rows(by.select(F.col("p_brand").alias("path"), F.concat(F.lit("BMU_ID,Date,MW\n"), F.array_join("lines", "\n")).cast("binary").alias("content")), silver.HEADERS["daily_wind_availability"])
    out = silver.transform(rows.withColumn("published_at", F.lit(datetime(2024, 6, 1))), dataset("neso_data_portal", "daily_wind_availability"))
    return out.groupBy("bmu_id").agg(F.count("*").alias("n"), F.sum("availability_mw").alias("mw"))


# -- windows of requests


def _requests(spark, d) -> DataFrame:
    o = tables.read(spark, d, "orders")
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    later = at + F.expr("INTERVAL 1 DAY")
    start = F.when(k % 6 == 1, F.lit("soon")).when(k % 2 == 0, F.date_format(at, "yyyyMMddHHmm")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm'Z'"))
    end = F.when(k % 6 == 2, F.date_format(at, "yyyyMMddHHmm")).when(k % 6 == 3, F.lit(None)).otherwise(F.date_format(later, "yyyyMMddHHmm"))
    params = F.map_filter(F.create_map(F.lit("periodStart"), start, F.lit("periodEnd"), end), lambda _, v: v.isNotNull())
    side = o.select("o_custkey", "o_orderkey", F.when(k % 6 == 4, F.lit("x")).otherwise(F.lit("entsoe")).alias("source"), F.lit("d").alias("dataset"), params.alias("request_params"))
    return windows.request_windows(side, "entsoe", "d", *windows.WINDOW_PARAMS["entsoe"])


@query("""
SELECT o_orderkey, coalesce(['sound', 'UNPARSEABLE_PARAM', 'EMPTY_WINDOW', 'MISSING_PARAM', 'WRONG_IDENTITY', 'sound'][o_orderkey % 6 + 1]) AS reason, CASE WHEN o_orderkey % 6 IN (0, 5) THEN epoch_us(o_orderdate) ELSE -1 END AS start_us FROM orders""")
def request_windows_orders(spark, d):
    at = F.when(F.col("reason").isNull(), us("window_start")).otherwise(F.lit(-1).cast("long"))
    return _requests(spark, d).select("o_orderkey", F.coalesce("reason", F.lit("sound")).alias("reason"), at.alias("start_us"))


@query("""
SELECT bool_and(o_orderkey % 6 IN (0, 5)) AS usable, epoch_us(min(o_orderdate)) AS first_us, epoch_us(max(o_orderdate)) + 86400000000 AS last_us FROM orders WHERE o_orderkey % 6 IN (0, 5)
UNION ALL SELECT false, epoch_us(min(o_orderdate) FILTER (WHERE o_orderkey % 6 <> 1)), epoch_us(max(CASE o_orderkey % 6 WHEN 3 THEN NULL WHEN 2 THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END)) FROM orders""")
def partition_windows_orders(spark, d):
    """The hull of sound requests is usable; of all of them it isn't."""
    w = _requests(spark, d)
    both = windows.partition_window(w.filter("reason is null")).unionByName(windows.partition_window(w))
    return both.select("usable", us("window_start").alias("first_us"), us("window_end").alias("last_us"))


@query("""
SELECT o_custkey AS chunk, bool_and(o_orderpriority <> '5-LOW') AND count(DISTINCT p) = max(t) AND max(p) = max(t) AS durable
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p, count(*) OVER (PARTITION BY o_custkey) + CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 0 END AS t FROM orders) GROUP BY 1""")
def durable_chunks_orders(spark, d):
    """A chunk is whole if all of its pages, and no body, are missing none."""
    by = W.partitionBy("o_custkey")
    o = tables.read(spark, d, "orders").withColumn("page", F.row_number().over(by.orderBy("o_orderkey")))
    total = F.count("*").over(by) + F.when(F.col("o_custkey") % 7 == 0, 1).otherwise(0)
    files = o.select(F.col("o_custkey").alias("window_start"), F.col("o_custkey").alias("window_end"), "page", total.cast("int").alias("total_pages"), (F.col("o_orderpriority") != "5-LOW").alias("has_body"))
    return windows.durable_chunks(files).select(F.col("window_start").alias("chunk"), "durable")


@query("SELECT event_id FROM events WHERE event_id % 9 = 0 OR ts::DATE = DATE '2024-01-15'")
def undated_rows_events(spark, d):
    day = F.when(F.col("event_id") % 9 > 0, F.col("ts").cast("date"))
    return tables.read(spark, d, "events").filter(windows.on_day_or_undated(day, F.lit("2024-01-15").cast("date"))).select("event_id")


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 OR (o_orderdate::DATE <= DATE '1998-06-15' AND o_orderdate::DATE + 30 >= DATE '1998-06-15')")
def request_containment_orders(spark, d):
    start = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate").cast("date"))
    return tables.read(spark, d, "orders").filter(windows.request_contains(start, F.date_add(start, 30), F.lit("1998-06-15").cast("date"))).agg(F.count("*").alias("n"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS dataset, '{'timestamp_utc' if n == 'remit' else 'published_at'}' AS bounded" for n in sorted(x.name for x in DATASETS.values() if x.source == "elexon" and x.name not in ("fuelinst", "temp", "boal", "disbsad", "mid", "netbsad", "freq", "market_depth", "system_prices", "pn", "bmunits_reference"))))
def publication_windows(spark, d):
    found = [(x.name, windows.closed_window_column(x.name)) for x in DATASETS.values() if x.source == "elexon"]
    return spark.createDataFrame(found, "dataset string, bounded string").filter("bounded is not null")


# -- scalars


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN epoch_us(o_orderdate) ELSE -1 END AS second_us, CASE WHEN o_orderkey % 2 = 1 THEN epoch_us(o_orderdate) ELSE -1 END AS minute_us,
  epoch_us(o_orderdate) AS lenient_us, CASE WHEN o_orderkey % 4 = 3 THEN 'none' ELSE CAST(o_orderdate::DATE AS VARCHAR) END AS day, epoch_us(o_orderdate) AS strict_us FROM orders""")
def instant_parsers_orders(spark, d):
    """Each written form that a parser takes, by turns."""
    at, k = F.col("o_orderdate"), F.col("o_orderkey")
    forms = F.element_at(F.array(*[F.date_format(at, f) for f in (*C.FALLBACK_FORMATS, "yyyy-MM-dd'T'HH:mm:ss'Z'")]), (k % 6 + 1).cast("int"))
    zulu = F.when(k % 2 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm'Z'"))
    gone = F.lit(-1).cast("long")
    day = C.safe_date(F.when(k % 4 == 3, F.lit("soon")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm")))
    return tables.read(spark, d, "orders").select("o_orderkey", F.coalesce(us(C.parse_instant(zulu)), gone).alias("second_us"), F.coalesce(us(C.parse_minute(zulu)), gone).alias("minute_us"), us(C.parse_lenient(forms)).alias("lenient_us"), F.coalesce(day.cast("string"), F.lit("none")).alias("day"), us(C.strict_instant(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))).alias("strict_us"))


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'France' ELSE '' END AS area, CASE WHEN p_partkey % 2 = 0 THEN 't' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS link, CASE p_partkey % 4 WHEN 0 THEN 'facility' WHEN 1 THEN 'company' WHEN 2 THEN 'country' ELSE 'country' END AS level,
  p_partkey % 4 <> 3 AS usable, round(p_size / 3.6, 9) AS mps, 'http://h/p?a=' || p_partkey || '&securityToken=***' AS masked, '{"a":"' || p_partkey || '","b":"x"}' AS sorted, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_type END AS first FROM part""")
def scalar_functions_part(spark, d):
    k = F.col("p_partkey")
    text = k.cast("string")
    code = F.element_at(F.array(F.lit("10YFR-RTE------C"), F.lit("10Y?"), F.lit("")), (k % 3 + 1).cast("int"))
    url = F.when(k % 2 == 0, F.concat(F.lit("https://h/x?turl=t"), text, F.lit("&y=1"))).otherwise(F.concat(F.lit("https://h/x/"), text, F.lit("/?z=2")))
    when = lambda n, v: F.when(k % 4 == n, F.lit(v))
    value = F.element_at(F.array(F.lit("1.5"), F.lit(" "), F.lit(None), F.lit("NaN")), (k % 4 + 1).cast("int"))
    return tables.read(spark, d, "part").select(
        "p_partkey", S.area_name(code).alias("area"), S.link_slug(url).alias("link"), S.entity_level(when(0, "f"), when(1, "c"), when(2, "d"), F.lit("")).alias("level"), S.usable_value(value).alias("usable"), F.round(S.kmh_to_mps(F.col("p_size")), 9).alias("mps"),
        S.mask_secret(F.concat(F.lit("http://h/p?a="), text, F.lit("&securityToken="), "p_name")).alias("masked"), S.sorted_json(F.create_map(F.lit("b"), F.lit("x"), F.lit("a"), text)).alias("sorted"), S.first_text(F.when(k % 2 == 0, F.col("p_brand")).otherwise(F.lit("")), F.col("p_type")).alias("first"),
    )


@query("SELECT CAST(unnest(generate_series(min(ts::DATE), max(ts::DATE), INTERVAL 1 DAY))::DATE AS VARCHAR) AS day FROM events")
def day_ranges_events(spark, d):
    a, b = tables.read(spark, d, "events").agg(F.min(F.col("ts").cast("date")), F.max(F.col("ts").cast("date"))).first()
    return C.date_range(spark, a, b).select(F.col("day").cast("string"))


# -- quality and state


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_codes_orders(spark, d):
    return quality.distinct_values(tables.read(spark, d, "orders"), "o_orderpriority")


@query("SELECT o_custkey, o_orderstatus, min(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL")
def lossless_dedup_orders(spark, d):
    return vintage.dedup_signal(tables.read(spark, d, "orders"), ["o_custkey", "o_orderstatus"], ["o_orderkey"]).select("o_custkey", "o_orderstatus", "o_orderkey")


@query("SELECT unnest(['ts', 'event_type', 'props']) AS column_name")
def derived_keys_events(spark, d):
    e = tables.read(spark, d, "events").withColumn("same", F.lit("x"))
    return spark.createDataFrame([(c,) for c in quality.key_columns(e, "ts")], "column_name string")


@query("SELECT round(count(DISTINCT (user_id, event_type)) / count(*), 6) AS dedup_ratio, count(DISTINCT ts::DATE) AS n_days FROM events")
def dedup_ratio_events(spark, d):
    return quality.coverage(tables.read(spark, d, "events"), "ts", ["user_id", "event_type"]).select("dedup_ratio", "n_days")


def _log(spark, d) -> str:
    """Events as a run log: a run a user, an event an entry."""
    path = tables.scratch(spark, "runs")
    e = tables.read(spark, d, "events")
    k = F.col("event_id")
    rows = e.select(F.concat(F.lit("r"), "user_id").alias("run_id"), F.lit("s").alias("source"), F.lit("d").alias("dataset"), F.col("event_type").alias("status"), k.alias("rows"), F.date_trunc("day", "ts").alias("started_at"), F.col("ts").alias("finished_at"), F.col("ts").alias("at"), F.lit("").alias("message"))
    tables.write(rows, f"{path}/log")
    return f"{path}/log"


@query("SELECT 'r' || user_id AS run_id, max_by(event_type, ts) AS status, max_by(event_id, ts) AS rows FROM events GROUP BY 1")
def run_log_latest(spark, d):
    return runs.RunLog(spark, _log(spark, d)).current().select("run_id", "status", "rows")


@query("""
WITH c AS (SELECT 'r' || user_id AS run_id, max(ts) AS t FROM events GROUP BY 1)
SELECT run_id, CAST(round((epoch_us(t) - epoch_us(date_trunc('day', t))) / 1000000.0, 1) AS DOUBLE) AS seconds FROM c WHERE date_trunc('day', t) >= TIMESTAMP '2024-01-29' ORDER BY date_trunc('day', t) DESC, run_id LIMIT 20""")
def recent_runs_events(spark, d):
    log = runs.RunLog(spark, _log(spark, d)).current()
    return state.recent_runs(log, F.lit(datetime(2024, 1, 30)), 20).select("run_id", "seconds")


@query("SELECT count(*) AS n FROM (SELECT user_id, max(ts) AS t FROM events GROUP BY 1) WHERE date_trunc('day', t) > TIMESTAMP '2024-01-28'")
def runs_since_events(spark, d):
    return state.runs_since(runs.RunLog(spark, _log(spark, d)).current(), F.lit(datetime(2024, 1, 28)))


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderkey % 60 NOT BETWEEN 1 AND 50) AS period, count(*) FILTER (WHERE o_totalprice > 10000) AS price, count(*) FILTER (WHERE o_orderstatus = 'P') AS run FROM orders""")
def dataset_rules_orders(spark, d):
    """What a dataset declares is checked row by row; broken rows are counted."""
    o = tables.read(spark, d, "orders")
    rows = o.select(F.col("o_orderdate").alias("timestamp_utc"), (F.col("o_orderkey") % 60).cast("int").alias("settlement_period"), F.col("o_totalprice").alias("system_sell_price"), F.lit(1.0).alias("system_buy_price"), F.when(F.col("o_orderstatus") == "P", F.lit("P")).otherwise(F.lit("R1")).alias("run_type"))
    out = rules.validate(rows, dataset("elexon", "system_prices"))
    return out.select("n_rows", F.col("settlement_period_in_range").alias("period"), F.col("system_sell_price_in_range").alias("price"), F.col("run_type_known").alias("run"))


# -- tables and sinks


@query("""SELECT o_orderkey, o_custkey, -1::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, -1, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def drifted_files_orders(spark, d):
    """Files whose columns drifted, read by name; a path without files adds nothing."""
    path, o = tables.scratch(spark, "drift"), tables.read(spark, d, "orders")
    tables.write(o.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey"), f"{path}/t", mode="append")
    tables.write(o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), f"{path}/t", mode="append")
    found = tables.read_path(spark, f"{path}/t")
    return tables.union_all([found, tables.read_path(spark, f"{path}/none", found.schema)]).select("o_orderkey", F.coalesce("o_custkey", F.lit(-1).cast("long")).alias("o_custkey"), F.coalesce("o_totalprice", F.lit(-1.0)).alias("o_totalprice"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-01-15' AND DATE '1997-03-10'")
def month_tree_orders(spark, d):
    """A year and month tree, written and read by a range of days."""
    path = f"{tables.scratch(spark, 'tree')}/t"
    o = tables.read(spark, d, "orders").withColumn("settlement_date", F.col("o_orderdate").cast("date"))
    tables.write(o.withColumns({"year": F.year("settlement_date"), "month": F.month("settlement_date")}).repartition("year"), path, ("year", "month"))
    return tables.read_range(spark, path, datetime(1997, 1, 15).date(), datetime(1997, 3, 10).date()).select("o_orderkey")


@query("""
SELECT event_id, CAST(ts::DATE AS VARCHAR) AS day FROM events WHERE event_type <> 'click' OR ts::DATE <> DATE '2024-01-05'""")
def silver_days_events(spark, d):
    """A day's directory is replaced as a whole, others stay."""
    path = f"{tables.scratch(spark, 'days')}/t"
    e = tables.read(spark, d, "events").withColumn("partition_date", F.col("ts").cast("date")).select("event_id", "event_type", "partition_date")
    tables.write_silver(e, path, order=("event_id",))
    tables.write_silver(e.filter("partition_date = DATE'2024-01-05' AND event_type <> 'click'"), path, order=("event_id",))
    return tables.read_path(spark, path).select("event_id", F.col("partition_date").cast("string").alias("day"))


@query("""
SELECT 'all' AS step, count(*) AS n FROM events UNION ALL SELECT 'again', count(*) FROM events UNION ALL SELECT 'more', 2 * count(*) FROM events""")
def silver_vintages_events(spark, d):
    """Where vintages stay, the same one replaces itself and another one comes beside it."""
    path = f"{tables.scratch(spark, 'vintages')}/t"
    e = tables.read(spark, d, "events").withColumn("partition_date", F.lit("2024-01-01").cast("date")).select("event_id", "partition_date")
    out = []
    for step, name in (("all", "a"), ("again", "a"), ("more", "b")):
        tables.write_silver(e, path, append_only=True, vintage=name)
        out.append((step, tables.read_path(spark, path).count()))
    return spark.createDataFrame(out, "step string, n long")


@query("SELECT year(o_orderdate) AS year, count(*) AS n, (SELECT count(*) FROM orders) AS written FROM orders GROUP BY 1")
def gold_files_orders(spark, d):
    path = f"{tables.scratch(spark, 'gold')}/t"
    o = tables.read(spark, d, "orders").withColumn("settlement_date", F.date_trunc("month", "o_orderdate").cast("date")).select("o_orderkey", "settlement_date")
    n = tables.write_gold(o.repartition("settlement_date"), path)
    none = tables.write_gold(o.limit(0), f"{path}-none")
    return tables.read_path(spark, path).groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("n")).withColumn("written", F.lit(n + none).cast("long"))


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def export_limit(spark, d):
    """A view as CSV, bounded on its date column and cut to the first rows, then read back."""
    path = f"{tables.scratch(spark, 'csv')}/t"
    o = tables.read(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("date"))
    tables.export_csv(o.orderBy(F.desc("o_totalprice"), "o_orderkey"), path, "1996-01-01", "1999-12-31", 100)
    return spark.read.schema("o_orderkey long, o_totalprice double, date date").csv(path, header=True).select("o_orderkey", "o_totalprice")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_copy_supplier(spark, d):
    """The copy as CSV that a silver write can leave."""
    path = tables.scratch(spark, "copy")
    s = tables.read(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal", F.lit("2024-01-01").cast("date").alias("partition_date"))
    tables.write_silver(s, f"{path}/t", csv=f"{path}/csv")
    return spark.read.schema("s_suppkey long, s_name string, s_acctbal double, partition_date date").csv(f"{path}/csv", header=True).drop("partition_date")


@query("""
SELECT 'orders' AS dataset, check_name, subject, row_number() OVER (ORDER BY check_name, subject) - 1 AS ordinal FROM (VALUES ('row_count', '*'), ('null_rate', 'o_orderkey'), ('null_rate', 'o_custkey'), ('null_rate', 'o_totalprice')) t(check_name, subject)""")
def quality_log_orders(spark, d):
    path = f"{tables.scratch(spark, 'quality')}/t"
    runs.write_report(quality.report(tables.read(spark, d, "orders"), "orders"), path, "r1")
    return tables.read_path(spark, path).select("dataset", "check_name", "subject", F.col("ordinal").cast("long").alias("ordinal"))


@query("SELECT o_orderkey, -1::BIGINT AS published_us FROM orders")
def normalised_files_orders(spark, d):
    out = runs.normalise_published_at(tables.read(spark, d, "orders").select("o_orderkey"), ["published_at", "o_orderkey"])
    return out.select("o_orderkey", F.coalesce(us("published_at"), F.lit(-1).cast("long")).alias("published_us"))


@query("SELECT CAST(d AS VARCHAR) AS day FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders) WHERE d < DATE '1996-01-01'")
def prunable_days_orders(spark, d):
    """Which daily folders a prune would take, told from their names."""
    from datetime import date

    days = [r.day for r in tables.read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct().collect()]  # one a day
    old = [str(x) for x in days if retention._end(f"/lake/silver/s/d/year={x.year}/month={x.month}/partition_date={x}") < date(1996, 1, 1)]
    return spark.createDataFrame([(x,) for x in old], "day string")


# -- the client


_LAKES: dict[tuple[str, str], str] = {}
_RUNS = {"P": "II", "O": "SF", "F": "R1"}


def _lake(spark, d) -> str:
    """Silver tables made from the driver's, once a session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key in _LAKES:
        return _LAKES[key]
    root = tables.scratch(spark, "lake")
    o, e = tables.read(spark, d, "orders"), tables.read(spark, d, "events")
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    tail = {"data_provider": F.lit("x"), "ingested_at": F.lit(datetime(2024, 6, 1)), "source_run_id": F.lit("r"), "dataset_version": F.lit("1")}

    def put(source: str, name: str, df: DataFrame, event: str) -> None:
        stamped = df.withColumns(tail).withColumn("event_time", F.col(event).cast("timestamp"))
        stamped = stamped if "available_at" in df.columns else stamped.withColumn("available_at", F.col("event_time"))
        tables.write(stamped.withColumn("year", F.year(event)).repartition("year"), f"{root}/{source}/{name}", ("year",))

    prices = o.select(
        day.alias("settlement_date"), (F.col("o_custkey") % 46 + 1).cast("int").alias("settlement_period"), F.col("o_totalprice").alias("system_sell_price"), (F.col("o_totalprice") + k % 10).alias("system_buy_price"), (k % 100 - 50).cast("double").alias("net_imbalance_volume"),
        F.element_at(S.literal_map(_RUNS), F.col("o_orderstatus")).alias("run_type"), F.col("o_orderpriority").alias("price_derivation_code"), (F.col("o_orderdate") + F.make_interval(days=(k % 3).cast("int"))).alias("available_at"),
    )
    prices = prices.withColumn("timestamp_utc", C.settlement_period_to_utc(F.col("settlement_date"), F.col("settlement_period")))
    put("elexon", "system_prices", prices, "timestamp_utc")
    carbon = prices.filter("settlement_period % 2 = 0").select("timestamp_utc").distinct()
    carbon = carbon.select("timestamp_utc", (F.unix_timestamp("timestamp_utc") % 1000).cast("double").alias("forecast_gco2_kwh"), F.lit(1.0).alias("actual_gco2_kwh"), F.lit("low").alias("intensity_index"))
    put("neso", "carbon_intensity", carbon, "timestamp_utc")
    at = F.col("ts")
    put("elexon", "fuelhh", e.select(at.cast("date").alias("settlement_date"), (F.col("event_id") % 48 + 1).cast("int").alias("settlement_period"), at.alias("timestamp_utc"), F.col("event_type").alias("fuel_type"), F.col("value").alias("generation_mw")), "timestamp_utc")
    level = {c: F.col("value") for c in gold.STORAGE_COLUMNS[3:8]}
    put("gie_agsi", "storage", e.select(at.cast("date").alias("gas_day"), F.col("event_type").alias("country_code"), F.lit("c").alias("country_name"), *[c.alias(n) for n, c in level.items()], F.col("event_id").cast("double").alias("trend")), "gas_day")
    put("open_meteo", "historical_demand", e.select(at.alias("timestamp_utc"), F.col("event_type").alias("location"), F.col("value").alias("temperature_2m_c"), "event_id"), "timestamp_utc")
    _LAKES[key] = root
    return root


_PRICES = """
SELECT *, o_orderdate::DATE AS day, CAST(o_custkey % 46 + 1 AS BIGINT) AS period, o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS available, o_totalprice + o_orderkey % 10 AS buy, CAST(o_orderkey % 100 - 50 AS DOUBLE) AS net,
  CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 4 - 1 END AS rank, CASE o_orderstatus WHEN 'P' THEN 'II' WHEN 'O' THEN 'SF' ELSE 'R1' END AS run,
  epoch_us((CAST(o_orderdate::DATE AS TIMESTAMP) AT TIME ZONE 'Europe/London')) + (o_custkey % 46) * 1800000000 AS at_us
FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderdate::DATE, o_custkey % 46 ORDER BY o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) DESC, rank DESC, net DESC, o_orderpriority DESC, run DESC, buy DESC, o_totalprice DESC) = 1"""


@query(f"WITH p AS ({_PRICES}) SELECT CAST(day AS VARCHAR) AS day, period, o_totalprice AS sell, buy, epoch_us(available) AS available_us FROM p WHERE day BETWEEN DATE '1996-02-01' AND DATE '1998-07-31'")
def client_system_prices(spark, d):
    with serving.Client(spark, _lake(spark, d)) as c:
        out = c.system_prices(datetime(1996, 2, 1).date(), datetime(1998, 7, 31).date())
        return out.select(F.col("settlement_date").cast("string").alias("day"), F.col("settlement_period").cast("long").alias("period"), F.col("system_sell_price").alias("sell"), F.col("system_buy_price").alias("buy"), us("available_at").alias("available_us"))


@query(f"WITH p AS ({_PRICES}) SELECT at_us, net, CASE WHEN period % 2 = 0 THEN CAST((at_us // 1000000) % 1000 AS DOUBLE) ELSE -1 END AS forecast, epoch_us(available) AS available_us FROM p WHERE day BETWEEN DATE '1996-02-01' AND DATE '1998-07-31'")
def client_imbalance_context(spark, d):
    with serving.Client(spark, _lake(spark, d)) as c:
        out = c.imbalance_context(datetime(1996, 2, 1).date(), datetime(1998, 7, 31).date())
        return out.select(us("timestamp_utc").alias("at_us"), F.col("net_imbalance_volume").alias("net"), F.coalesce("carbon_intensity_forecast_gco2_kwh", F.lit(-1.0)).alias("forecast"), us("available_at").alias("available_us"))


@query("SELECT epoch_us(ts) AS at_us, event_type AS fuel_type, value AS generation_mw FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def client_fuel_generation(spark, d):
    """The full form and the older one of three columns agree."""
    with serving.Client(spark, _lake(spark, d)) as c:
        days = (datetime(2024, 1, 5).date(), datetime(2024, 1, 9).date())
        full = c.fuel_generation(*days).select("timestamp_utc", "fuel_type", "generation_mw")
        return full.intersectAll(c.generation_by_fuel(*days)).select(us("timestamp_utc").alias("at_us"), "fuel_type", "generation_mw")


@query("SELECT CAST(ts::DATE AS VARCHAR) AS gas_day, value AS stored, CAST(event_id AS DOUBLE) AS trend FROM events WHERE event_type = 'view' AND ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-19'")
def client_gas_storage(spark, d):
    with serving.Client(spark, _lake(spark, d)) as c:
        out = c.gas_storage(datetime(2024, 1, 5).date(), datetime(2024, 1, 19).date(), "view")
        return out.select(F.col("gas_day").cast("string"), F.col("gas_in_storage_gwh").alias("stored"), "trend")


@query("SELECT event_id, value FROM events WHERE event_type = 'click' AND ts::DATE BETWEEN DATE '2024-01-28' AND DATE '2024-02-02'")
def client_weather(spark, d):
    with serving.Client(spark, _lake(spark, d)) as c:
        return c.weather(datetime(2024, 1, 28).date(), datetime(2024, 2, 2).date(), "click").select("event_id", F.col("temperature_2m_c").alias("value"))


@query("SELECT unnest(['gold_eu_gas_storage', 'gold_uk_imbalance_context', 'silver_carbon_intensity', 'silver_elexon_fuelhh', 'silver_elexon_system_prices', 'silver_elexon_system_prices_latest', 'silver_fuelhh', 'silver_gie_agsi_storage', 'silver_historical_demand', 'silver_neso_carbon_intensity', 'silver_open_meteo_historical_demand', 'silver_storage', 'silver_system_prices']) AS name")
def client_views(spark, d):
    with serving.Client(spark, _lake(spark, d)) as c:
        return spark.createDataFrame([(n,) for n in c.tables()], "name string")


@query("SELECT event_type AS fuel_type, count(*) AS n, max(value) AS top FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1")
def client_sql(spark, d):
    """A query with a parameter and a dialect's own word."""
    with serving.Client(spark, _lake(spark, d)) as c:
        return c.query("WITH x AS (SELECT * EXCLUDE (data_provider) FROM silver_fuelhh WHERE timestamp_utc >= :since) SELECT fuel_type, count(*) AS n, max(generation_mw) AS top FROM x GROUP BY 1", since=datetime(2024, 1, 10))


@query(f"""WITH p AS ({_PRICES}) SELECT at_us, buy - o_totalprice AS spread, abs(net) AS abs_imbalance, isodow(make_timestamp(at_us))::BIGINT AS day_of_week FROM p WHERE day BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""")
def gold_marginal_price(spark, d):
    out = gold.system_marginal_price(spark, _lake(spark, d), datetime(1997, 1, 1).date(), datetime(1997, 12, 31).date())
    return out.select(us("timestamp_utc").alias("at_us"), "spread", "abs_imbalance", F.col("day_of_week").cast("long").alias("day_of_week"))


@query("SELECT event_type, count(*) AS n, epoch_us(ts::DATE::TIMESTAMP) AS start_us FROM events GROUP BY 1, ts::DATE")
def stream_windows_events(spark, d):
    """Event-time windows over a stream of the table's files, in one go."""
    path, schema = tables.scratch(spark, "stream"), tables.read(spark, d, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    name = f"windows_{path[-8:]}"
    counts = ingest.windowed_counts(rows, "ts", "1 hour", "1 day", by="event_type")
    counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select("event_type", "n", us("window_start").alias("start_us"))


@query("SELECT event_id FROM events")
def stream_vintages_events(spark, d):
    """Late rows without repeats, appended; files already taken aren't taken again."""
    path, e = tables.scratch(spark, "append"), tables.read(spark, d, "events")
    tables.write(e.select("event_id", "ts").unionByName(e.select("event_id", "ts")), f"{path}/in", mode="append")
    for _ in range(2):
        stream = ingest.stream_table(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema)
        ingest.append_vintages(ingest.dedup_late(stream, ["event_id"], "ts", "60 days"), f"{path}/out", f"{path}/c").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_id")


@query(" UNION ALL ".join(f"SELECT '{x.relation}' AS relation, '{x.source}' AS source, {len(x.columns) + 4 if x.columns else 0}::BIGINT AS n_columns" for x in DATASETS.values()))
def schema_manifest(spark, d):
    from .manifest import manifest_frame

    m = manifest_frame(spark).filter("kind = 'silver'")
    return m.select("relation", "source", F.coalesce(F.size("columns"), F.lit(0)).cast("long").alias("n_columns"))


def _latest_names() -> str:
    return " UNION ALL ".join(f"SELECT '{s}' AS source, '{n}' AS dataset, '{','.join(spec.keys)}' AS keys" for (s, n), spec in sorted(vintage.LATEST_SPECS.items()))


@query(_latest_names())
def latest_rules(spark, d):
    """The datasets with vintages, and the keys that the manifest's latest views take."""
    from .manifest import manifest_frame

    m = manifest_frame(spark).filter("kind = 'silver_latest'").select("source", "dataset")
    keys = spark.createDataFrame([(s, n, ",".join(x.resolve([*x.keys, "available_at"])[0])) for (s, n), x in vintage.LATEST_SPECS.items()], "source string, dataset string, keys string")
    return m.join(keys, ["source", "dataset"])
