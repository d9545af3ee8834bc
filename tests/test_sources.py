import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattmill.plans import serving, silver
from wattmill.plans.manifest import date_column, ddl, manifest_frame
from wattmill.plans.registry import DATASETS, dataset
from wattmill.sources import bronze, market_xml, tables
from wattmill.streaming import ingest
from wattmill.streaming.watermark import WatermarkTable

DAY = date(2024, 6, 1)


def land(root, source, name, payload, stamp="20240601T000000", ext="json", **meta):
    body = payload if isinstance(payload, bytes) else json.dumps(payload).encode()
    meta = {"fetched_at": "2024-06-02T01:00:00Z", "written_at": "2024-06-02T01:00:01Z"} | meta
    return bronze.write_raw(str(root), source, name, DAY, body, meta, ext, stamp)


def price(period, sell, run="II"):
    return {"settlementDate": "2024-06-01", "settlementPeriod": period, "systemSellPrice": sell, "systemBuyPrice": sell + 5, "netImbalanceVolume": -3.5, "settlementRunType": run}


def test_prices_from_bronze_to_gold(spark, tmp_path):
    root, lake = tmp_path / "bronze", str(tmp_path / "silver")
    land(root, "elexon", "system_prices", {"data": [price(1, 50.0), price(2, 51.0)]})
    land(root, "elexon", "system_prices", {"data": [price(1, 60.0, "SF")]}, "20240603T000000", written_at="2024-06-03T00:00:00Z")
    land(root, "neso", "carbon_intensity", {"data": [{"from": "2024-05-31T23:00Z", "to": "2024-05-31T23:30Z", "intensity": {"forecast": 100, "actual": 90, "index": "low"}}]})
    silver.run(spark, str(root), lake, "elexon", "system_prices", DAY, "run-1")
    silver.run(spark, str(root), lake, "neso", "carbon_intensity", DAY, "run-1")
    with serving.Client(spark, lake) as client:
        assert "silver_system_prices" in client.tables() and "gold_uk_imbalance_context" in client.tables()
        got = client.system_prices(DAY, DAY).collect()
        assert [(r.settlement_period, r.system_sell_price) for r in got] == [(1, 60.0), (2, 51.0)]
        assert "available_at" in got[0].asDict() and "event_time" not in got[0].asDict()
        ctx = client.imbalance_context(DAY, DAY).collect()
        assert [(r.settlement_period, r.carbon_intensity_forecast_gco2_kwh) for r in ctx] == [(1, 100.0), (2, None)]
        assert client.query("SELECT count(*) AS n FROM silver_elexon_system_prices").first().n == 3
        assert client.query("SELECT :x AS x", x=4).first().x == 4
        with pytest.raises(ValueError):
            client.query("DROP VIEW silver_elexon_system_prices")
        assert serving.quality_sweep(spark, lake).filter("check_name = 'row_count' and passed").count() == 2
    with pytest.raises(RuntimeError):
        client.tables()
    assert client.reopen().tables()


def test_json_shapes(spark, tmp_path):
    land(tmp_path, "s", "d", {"meta": [1], "data": [{"a": 1}, {"a": 2}]}, "1")
    land(tmp_path, "s", "d", [{"a": 3}], "2")
    land(tmp_path, "s", "d", {"meta": [9], "other": [{"a": 4}]}, "3")
    land(tmp_path, "s", "d", b"{broken", "4")
    land(tmp_path, "s", "d", {"data": {"a": 5}}, "5")
    files = bronze.vouched(bronze.list_files(spark, str(tmp_path), "s", "d", DAY))
    got = bronze.json_records(files).orderBy("path", "ordinal").collect()
    assert [json.loads(r.record)["a"] for r in got] == [1, 2, 3, 4, 5]


def test_vouching(spark, tmp_path):
    good = land(tmp_path, "s", "d", [{"a": 1}], "1")
    land(tmp_path, "s", "d", [{"a": 2}], "2", written_at="never", fetched_at="2024-06-02T05:00:00Z")
    land(tmp_path, "s", "d", [{"a": 3}], "3", written_at=None, fetched_at=None)
    alone = land(tmp_path, "s", "d", [{"a": 4}], "4")
    bad = land(tmp_path, "s", "d", [{"a": 5}], "5")
    import os

    os.remove(alone.removesuffix(".json") + ".meta.json")
    with open(bad.removesuffix(".json") + ".meta.json", "w") as f:
        f.write("{nope")
    got = {r.stem.split("_")[1]: (r.reason, r.stamp) for r in bronze.vouched(bronze.list_files(spark, str(tmp_path), "s", "d", DAY)).collect()}
    assert got["1"][0] is None and str(got["2"][1]).startswith("2024-06-02 05")
    assert [got[k][0] for k in "345"] == ["NO_TIMESTAMP_KEY", "NO_SIDECAR", "UNREADABLE_SIDECAR"]
    newest = bronze.newest_vouched(bronze.list_files(spark, str(tmp_path), "s", "d", DAY)).collect()
    assert len(newest) == 1 and newest[0].stem.split("_")[1] == "2" and good


def test_csv_contract(spark, tmp_path):
    ok = tmp_path / "a.csv"
    ok.write_bytes("﻿BMU_ID, Date ,MW\nX,2024-06-01,1.5\n".encode())
    got = bronze.csv_records(spark, [str(ok)], ("BMU_ID", "Date", "MW")).collect()
    assert [(r.BMU_ID, r.Date, r.MW) for r in got] == [("X", "2024-06-01", "1.5")]
    quoted = tmp_path / "q.csv"
    quoted.write_text('"BMU_ID","Date", "MW"\r\n"X, ""Y""\nZ",2024-06-01,1.5\r\n\r\nW,,\n')
    got = bronze.csv_records(spark, [str(quoted)], ("BMU_ID", "Date", "MW")).orderBy("ordinal").collect()
    assert [(r.ordinal, r.BMU_ID, r.Date, r.MW) for r in got] == [(0, 'X, "Y"\nZ', "2024-06-01", "1.5"), (1, "W", None, None)]
    for name, text in (("e", "BMU_ID,Date,MW,more\n"), ("b", "Date,BMU_ID,MW\n"), ("c", "<html></html>"), ("d", "  ")):
        p = tmp_path / f"{name}.csv"
        p.write_text(text)
        with pytest.raises(Exception, match="drifted|HTML|empty"):
            bronze.csv_records(spark, [str(p)], ("BMU_ID", "Date", "MW")).collect()


def document(points, curve="A01", resolution="PT60M", end="2024-06-01T04:00Z", root="Publication_MarketDocument", series="TimeSeries", extra=""):
    body = "".join(f"<Point><position>{p}</position><price.amount>{v}</price.amount></Point>" for p, v in points)
    return f"""<?xml version="1.0"?><{root} xmlns="urn:x"><mRID>doc</mRID><createdDateTime>2024-06-01T10:00:00Z</createdDateTime>
    <{series}><mRID>1</mRID><in_Domain.mRID>10YFR-RTE------C</in_Domain.mRID><currency_Unit.name>EUR</currency_Unit.name><curveType>{curve}</curveType>
    <Period><timeInterval><start>2024-06-01T00:00Z</start><end>{end}</end></timeInterval><resolution>{resolution}</resolution>{body}</Period>{extra}</{series}></{root}>""".encode()


def test_documents():
    rows = market_xml.parse_document(document([(1, 5), (2, 6)]))
    assert [(r["timestamp_utc"].hour, r["value"], r["in_domain"], r["currency_unit"]) for r in rows] == [(0, 5.0, "10YFR-RTE------C", "EUR"), (1, 6.0, "10YFR-RTE------C", "EUR")]
    sparse = market_xml.parse_document(document([(1, 5), (3, 6), (3, 7), (9, 8)], "A03"))
    assert [(r["position"], r["value"]) for r in sparse] == [(1, 5.0), (2, 5.0), (3, 6.0), (3, 7.0), (4, 7.0), (9, 8.0)]
    assert [r["position"] for r in market_xml.parse_document(document([(2, 5)], "A03"))] == [2, 3, 4]
    assert len(market_xml.parse_document(document([(1, 5), (3, 6)]))) == 2
    assert market_xml.parse_document(b"<broken") == []
    assert market_xml.parse_document(b"<!DOCTYPE x [<!ENTITY a 'b'>]><x/>") == []
    assert market_xml.parse_document(b"<!--" + b"x" * 9000 + b"-->" + b"<!DOCTYPE x [<!ENTITY a 'b'>]><x/>") == []
    long = market_xml.parse_document(document([(1, 5)], "A03", "PT15M", "2028-06-01T00:00Z"))
    assert len(long) == 1461 * 96 and market_xml.is_last_page(document([(1, 5)])) and not market_xml.is_last_page(b"<a>" + b"<TimeSeries/>" * 4800 + b"</a>")
    assert [r["value"] for r in market_xml.parse_document(document([(1, "x"), (2, 3)]))] == [3.0]
    (empty,) = market_xml.parse_document(document([(1, "")]))
    assert empty["value"] != empty["value"]


def test_calendar_steps():
    from datetime import datetime, timezone

    start = datetime(2024, 1, 31, tzinfo=timezone.utc)
    assert market_xml.instant_at(start, "P1M", 2).day == 29 and market_xml.instant_at(start, "P1M", 3).day == 31
    assert market_xml.instant_at(start, "P1Y", 2).year == 2025


def test_ambiguous_bid_documents_are_refused():
    twice = b"<ReserveBid_MarketDocument><TimeSeries><Period/></TimeSeries><Bid_TimeSeries><Period/></Bid_TimeSeries></ReserveBid_MarketDocument>"
    assert market_xml.parse_document(twice, "quantity") == []
    body = document([], root="ReserveBid_MarketDocument", series="Bid_TimeSeries").replace(b"</resolution>", b"</resolution><Point><position>1</position><quantity>1</quantity><quantity.quantity>2</quantity.quantity></Point>")
    assert market_xml.parse_document(body, "quantity") == []


def test_day_ahead_prices(spark, tmp_path):
    land(tmp_path / "b", "entsoe", "day_ahead_prices", document([(1, 5), (2, 6), (25, 9)]), ext="xml", request_params={"periodStart": "202406010000", "periodEnd": "202406020000"})
    out = silver.run(spark, str(tmp_path / "b"), str(tmp_path / "s"), "entsoe", "day_ahead_prices", DAY, "r").collect()
    assert [(r.timestamp_utc.hour, r.area_code, r.price_eur_mwh, r.currency) for r in sorted(out, key=lambda r: r.timestamp_utc)] == [(0, "10YFR-RTE------C", 5.0, "EUR"), (1, "10YFR-RTE------C", 6.0, "EUR")]
    assert str(out[0].available_at) == "2024-06-01 10:00:00"


def test_half_open_windows(spark, tmp_path):
    """What the requests asked for decides, whatever the UTC day; without sound sidecars nothing goes; a total drop fails."""
    run = lambda b: silver.execute(spark, str(tmp_path / b), str(tmp_path / f"{b}-s"), "entsoe", "day_ahead_prices", DAY, "r")
    body = document([(1, 5), (2, 6), (25, 9), (49, 3)])
    land(tmp_path / "a", "entsoe", "day_ahead_prices", body, ext="xml", request_params={"periodStart": "202406010100", "periodEnd": "202406030000"})
    got = run("a")
    assert (got.status, got.written, got.window_dropped, got.bodies) == ("success", 2, 2, 1)
    assert sorted(r.price_eur_mwh for r in got.frame.collect()) == [6.0, 9.0]
    land(tmp_path / "b", "entsoe", "day_ahead_prices", body, ext="xml")
    got = run("b")
    assert (got.status, got.written, got.window_unresolved) == ("completed_with_warnings", 4, 1)
    land(tmp_path / "c", "entsoe", "day_ahead_prices", body, ext="xml", request_params={"periodStart": "202501010100", "periodEnd": "202501030000"})
    got = run("c")
    assert (got.status, got.written, got.window_dropped) == ("failed", 0, 4) and not (tmp_path / "c-s").exists()
    with pytest.raises(RuntimeError, match="window"):
        silver.run(spark, str(tmp_path / "c"), str(tmp_path / "c-s"), "entsoe", "day_ahead_prices", DAY, "r")


def test_broken_rows_are_counted_and_kept(spark, tmp_path):
    land(tmp_path / "b", "elexon", "system_prices", {"data": [price(1, 50.0), price(99, 51.0), price(2, 99_999.0, "ZZ")]})
    args = (spark, str(tmp_path / "b"), str(tmp_path / "s"), "elexon", "system_prices", DAY)
    got = silver.execute(*args, "r1")
    assert (got.status, got.written) == ("completed_with_warnings", 3)
    assert {k: v for k, v in got.broken.items() if v} == {"settlement_period_in_range": 1, "system_sell_price_in_range": 1, "system_buy_price_in_range": 1, "run_type_known": 1}
    silver.execute(*args, "r2")  # over the same files: the same vintage, replaced
    assert tables.read_path(spark, str(tmp_path / "s" / "elexon" / "system_prices")).count() == 3


def test_required_is_about_columns(spark, tmp_path):
    rows = [{"settlementDate": "2024-06-01", "settlementPeriod": 1, "fuelType": "WIND", "generation": 3}, {"settlementDate": None, "settlementPeriod": 2, "fuelType": "GAS", "generation": 4}]
    d = dataset("elexon", "fuelhh")
    land(tmp_path / "a", "elexon", "fuelhh", {"data": rows})
    assert silver.transform(silver.scan(spark, str(tmp_path / "a"), d, DAY), d).count() == 2
    land(tmp_path / "b", "elexon", "fuelhh", {"data": [{k: v for k, v in r.items() if k != "settlementPeriod"} for r in rows]})
    assert silver.transform(silver.scan(spark, str(tmp_path / "b"), d, DAY), d).count() == 0


def test_gas_day_of_a_response(spark):
    rows = spark.createDataFrame([('{"gasDayStart": "2024-06-01"}',), ("{}",)], "record string")
    assert silver.check_gas_day(rows, DAY).count() == 2
    with pytest.raises(Exception, match="gas day"):
        silver.check_gas_day(rows, date(2024, 6, 2)).collect()


def test_only_reads_are_served(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "x int, y string")
    rows.createOrReplaceTempView("src")
    tables.write(rows, str(tmp_path / "t"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS tgt_of_test (x INT, y STRING) USING parquet LOCATION '{tmp_path}/tgt'")
    with serving.Client(spark, str(tmp_path / "none")) as c:
        for bad in ("FROM src INSERT INTO tgt_of_test SELECT x, y", "WITH a AS (SELECT * FROM src) INSERT INTO tgt_of_test SELECT * FROM a", "INSERT INTO tgt_of_test VALUES (1, 'b')", "DROP TABLE tgt_of_test", "SET x=1", "SELECT x FROM src QUALIFY row_number() OVER (ORDER BY x) = 1", "CREATE TABLE z AS SELECT 1"):
            with pytest.raises(ValueError):
                c.query(bad)
        assert c.query("SELECT * EXCLUDE (y) FROM src -- * EXCLUDE (").columns == ["x"]
        assert c.query(f"WITH a AS (SELECT * FROM read_parquet('{tmp_path}/t')) SELECT count(*) AS n FROM a WHERE y <> 'QUALIFY'").first().n == 1
    assert spark.table("tgt_of_test").count() == 0
    spark.sql("DROP TABLE tgt_of_test")
    assert serving.relation_for(["silver_a_b", "silver_a_b_latest"], "a", "b") == "silver_a_b_latest" and serving.time_column(["x", "gas_day"]) == "gas_day"


def test_flows_storage_weather(spark, tmp_path):
    flow = {"indicator": "Physical Flow", "pointKey": "P1", "periodFrom": "2024-06-01T06:00:00+02:00", "unit": "kWh/d", "value": "2000000"}
    land(tmp_path, "entsog", "physical_flows", {"meta": {}, "operationalData": [flow, flow | {"unit": "therm"}, flow | {"pointKey": " "}, flow | {"value": "x"}]})
    d = dataset("entsog", "physical_flows")
    got = silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d).collect()
    assert [(r.point_key, r.flow_gwh_per_day, str(r.timestamp_utc)) for r in got] == [("P1", 2.0, "2024-06-01 04:00:00")]
    rec = {"gasDayStart": "2024-06-01", "gasInStorage": "28500.50", "name": "Terra", "code": "T", "full": "", "trend": "-"}
    land(tmp_path, "gie_agsi", "storage", {"data": [rec, rec | {"gasDayStart": "x"}]}, request_params={"country": "DE"})
    d = dataset("gie_agsi", "storage")
    (r,) = silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d).collect()
    assert (r.entity_level, r.entity_code, r.country_code, r.gas_in_storage_gwh, r.storage_pct_full) == ("country", "T", "DE", 28500.5, None)
    body = {"latitude": 51.5, "longitude": 0.1, "hourly": {"time": ["2024-06-01T00:00", "2024-06-01T01:00"], "temperature_2m": [10.0, None], "wind_speed_10m": [36.0], "surface_pressure": [1000.0, 1000.0]}}
    land(tmp_path, "open_meteo", "historical_demand", body, request_params={"location": "London"})
    d = dataset("open_meteo", "historical_demand")
    a, b = sorted(silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d).collect(), key=lambda r: r.timestamp_utc)
    assert (a.location, a.hdd_k, round(a.wind_speed_10m_mps, 6)) == ("London", 5.5, 10.0) and (b.hdd_k, b.wind_speed_10m_mps) == (None, None)


def test_carbon_regions_and_dynamic(spark, tmp_path):
    region = {"regionid": 1, "shortname": "North", "intensity": {"forecast": 10, "index": "low"}, "generationmix": [{"fuel": "gas", "perc": 40}, {"fuel": "wind", "perc": 60}]}
    land(tmp_path, "neso", "regional_current", {"data": [{"from": "2024-06-01T00:00Z", "to": "2024-06-01T00:30Z", "regions": [region, region | {"regionid": 2, "generationmix": []}]}]})
    d = dataset("neso", "regional_current")
    got = silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d).collect()
    assert sorted((r.regionid, r.fuel or "", r.generation_pct or 0.0) for r in got) == [(1, "gas", 40.0), (1, "wind", 60.0), (2, "", 0.0)]
    land(tmp_path, "entsog", "interruptions", {"interruptions": [{"id": "1", "periodFrom": "2024-06-01", "capacity_value": "5", "pointLabel": "x"}, {"id": "1", "periodFrom": "2024-06-02", "pointLabel": "y"}]})
    d = dataset("entsog", "interruptions")
    (r,) = silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d).collect()
    assert (r.point_label, str(r.timestamp_utc)) == ("y", "2024-06-02 00:00:00")


def test_blank_business_key_fails(spark, tmp_path):
    land(tmp_path, "elexon", "bmunits_reference", [{"bmUnit": " "}])
    d = dataset("elexon", "bmunits_reference")
    with pytest.raises(Exception, match="blank"):
        silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d).collect()


def test_raw_files_hide_secrets(spark, tmp_path):
    for session, folder in ((None, "a"), (spark, "b")):
        path = bronze.write_raw(str(tmp_path / folder), "s", "d", DAY, b"[]", {"request_url": "http://h/p?x=1&securityToken=abc&api_key=q", "request_params": {"a": {"token": 1}}}, spark=session)
        side = json.loads(open(path.removesuffix(".json") + ".meta.json").read())
        assert side["request_url"] == "http://h/p?x=1&securityToken=***&api_key=***" and side["request_params"] == {"a": {"token": "***"}}


def test_registry(spark):
    assert len(DATASETS) == len({d.relation for d in DATASETS.values()}) >= 160
    assert ddl("elexon", "freq") == "timestamp_utc timestamp, frequency_hz double, data_provider string, ingested_at timestamp"
    assert date_column("silver_elexon_system_prices") == "settlement_date"
    with pytest.raises(KeyError):
        date_column("silver_elexon_bmunits_reference")
    assert manifest_frame(spark, True).filter("kind = 'silver_latest'").count() == 6


def test_table_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], "a int").schema
    assert tables.read_path(spark, path, schema).count() == 0
    rows = spark.createDataFrame([("2024-01-31", 1), ("2024-02-01", 2), ("2024-05-01", 3)], "d string, a int").withColumn("settlement_date", F.col("d").cast("date"))
    rows = rows.withColumns({"year": F.year("settlement_date"), "month": F.month("settlement_date")})
    tables.write(rows, path, ("year", "month"))
    got = tables.read_range(spark, path, date(2024, 1, 31), date(2024, 2, 1))
    assert {r.a for r in got.collect()} == {1, 2}
    assert "PartitionFilters: [" in got._jdf.queryExecution().toString() and "month" in got._jdf.queryExecution().toString()
    tables.write(rows.filter("a = 3").withColumn("extra", F.lit(1)), path, ("year", "month"))
    assert tables.read_path(spark, path).count() == 3 and "extra" in tables.read_path(spark, path).columns
    with pytest.raises(ValueError):
        tables.write(rows, str(tmp_path / "x.parquet.tmp_0af"))
    tables.export_csv(rows, str(tmp_path / "csv"), "2024-02-01", "2024-05-01", 1)
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 1


def test_watermarks(spark, tmp_path):
    from datetime import datetime

    t = WatermarkTable(spark, str(tmp_path / "w"))
    assert t.read("s", "d").status == "absent"
    assert t.raise_to("s", "d", datetime(2024, 1, 2)) == "ADVANCED"
    assert t.raise_to("s", "d", datetime(2024, 1, 1)) == "NO_OP"
    seen = t.read("s", "d")
    assert t.compare_and_set("s", "d", seen, datetime(2024, 1, 3)) == "ADVANCED"
    assert t.compare_and_set("s", "d", seen, datetime(2024, 1, 4)) == "CAS_MISMATCH"
    assert t.read("s", "d").value == datetime(2024, 1, 3)
    a, b = (WatermarkTable(spark, str(tmp_path / "w")) for _ in range(2))
    seen = a.read("s", "d")
    b.read = lambda *_: seen  # b looked before a wrote
    assert a.compare_and_set("s", "d", seen, datetime(2024, 1, 5)) == "ADVANCED"
    assert b.compare_and_set("s", "d", seen, datetime(2024, 1, 6)) == "CAS_MISMATCH" and a.read("s", "d").value == datetime(2024, 1, 5)


def test_streams(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "in"))
    stream = ingest.stream_table(spark, str(tmp_path / "in"), events.schema)
    q = ingest.append_vintages(ingest.dedup_late(stream, ["event_id"], "ts", "1 day"), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()
    counts = ingest.windowed_counts(stream, "ts", "1 hour", "1 day", by="event_type")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counts").agg(F.sum("n")).first()[0] == events.count()


def test_inventories(spark, tmp_path):
    company = {"name": "C", "eic": "E1", "facilities": [{"name": "F1", "eic": "E2"}, {"name": "F2", "eic": "E3"}]}
    land(tmp_path, "gie_agsi", "about_listing", {"data": [company]})
    land(tmp_path, "gie_agsi", "about_summary", {"data": {"SSO": {"Europe": {"Germany": [company]}}}})
    for name in ("about_listing", "about_summary"):
        d = dataset("gie_agsi", name)
        got = silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d).collect()
        assert sorted((r.entity_level, r.name, r.eic) for r in got) == [("company", "C", "E1"), ("facility", "F1", "E2"), ("facility", "F2", "E3")]


def test_deep_inventories(spark, tmp_path):
    company = lambda n: {"name": n, "code": f"{n}1", "facilities": [{"name": f"{n}-f{i}"} for i in range(1200)]}
    deep = company("Z")
    for k in "abcdefg":
        deep = {k: deep, "name": f"group {k}"}
    land(tmp_path, "gie_agsi", "about_summary", {"data": {"SSO": deep, "LSO": {"x": [company("L"), {"name": "none"}]}}})
    d = dataset("gie_agsi", "about_summary")
    got = silver.inventory(silver.scan(spark, str(tmp_path), d, DAY)).select("ordinal", F.from_json("record", "map<string,string>").alias("r")).select("ordinal", "r.entity_level", "r.entity_name", "r.company_code", "r.company_name")
    assert got.filter("entity_level = 'company'").select("entity_name").orderBy("entity_name").collect() == [("L",), ("Z",)]
    assert got.filter("company_code = 'Z1' and company_name = 'Z'").count() == 1200 and got.select("ordinal").distinct().count() == got.count() == 2402


def test_rows_of_the_day(spark, tmp_path):
    d = dataset("gie_agsi", "news")
    land(tmp_path, "gie_agsi", "news", {"data": [{"url": "a", "start_at": "2024-05-30", "end_at": "2024-06-02"}, {"url": "b", "start_at": "2024-06-05"}, {"url": "c", "updatedAt": "2024-06-01"}, {"url": "d"}]})
    got = silver.owned(silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d), d, DAY)
    assert {r.url for r in got.collect()} == {"a", "c", "d"}
    d = dataset("entsog", "nominations")
    land(tmp_path, "entsog", "nominations", {"operationalData": [{"id": "1", "periodFrom": "2024-06-01T00:30:00+02:00"}, {"id": "2", "periodFrom": "2024-06-02"}, {"id": "3"}]})
    got = silver.owned(silver.transform(silver.scan(spark, str(tmp_path), d, DAY), d), d, DAY)
    assert {r.id for r in got.collect()} == {"1", "3"}


def test_covering_day_and_neighbour(spark, tmp_path):
    rows = [{"settlementDate": "2024-06-01", "settlementPeriod": 1, "demand": 5, "publishTime": t} for t in ("2024-06-01T10:00:00Z", "2024-06-02T00:00:00Z")]
    rows[1]["settlementPeriod"] = 2
    land(tmp_path / "b", "elexon", "indo", {"data": rows})
    assert bronze.covering_day(spark, str(tmp_path / "b"), "elexon", "indo", date(2024, 6, 20)) == DAY
    assert bronze.covering_day(spark, str(tmp_path / "b"), "elexon", "indo", date(2024, 8, 20)) is None
    run = lambda: silver.run(spark, str(tmp_path / "b"), str(tmp_path / "s"), "elexon", "indo", DAY, "r").count()
    assert run() == 2
    bronze.write_raw(str(tmp_path / "b"), "elexon", "indo", date(2024, 6, 2), b"[]", {"request_params": {"publishDateTimeFrom": "2024-06-02T00:00Z", "publishDateTimeTo": "2024-06-03T00:00Z"}})
    assert run() == 1


def test_fields_named_like_the_scans_own_columns(spark, tmp_path):
    """A payload's path, day, stamp and ordinal are columns like others and never the ingest stamp; names that differ in case are one."""
    fields = {"id": "1", "periodFrom": "2024-06-01", "path": "p", "day": "d", "stamp": "1999-01-01", "_bronze_stamp": "1998-01-01", "ordinal": "o", "Label": None, "label": "x"}
    land(tmp_path / "b", "entsog", "nominations", {"operationalData": [fields]})
    result = silver.execute(spark, str(tmp_path / "b"), str(tmp_path / "s"), "entsog", "nominations", DAY, "run")
    (r,) = result.frame.collect()
    assert (r.path, r.day, r.stamp, r.bronze_stamp, r.ordinal, r.label) == ("p", "d", "1999-01-01", "1998-01-01", "o", "x")
    assert r.available_at.year > 2000
    assert not [c for c in result.frame.columns if c.startswith("_")]
