"""Bronze to silver: one recipe for each shape of payload, driven by a dataset's declaration.

Every recipe ends alike: typed columns, the row's instant, keep-last dedup by file and place, and
the declared columns in order.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import scalars as S
from ..operators import bitemporal, vintage, windows
from ..sources import bronze, market_xml, tables
from . import rules, runs
from .registry import FUELS, WEATHER, Dataset, column_type, dataset, vendor_names

ORDINAL = ["path", "ordinal"]
#: What rows of free columns carry beside them. Normalised field names never begin with an underscore, so none can take their place.
OWN_ORDINAL, OWN_STAMP, LOCAL_DAY = ["_bronze_path", "_bronze_ordinal"], "_bronze_stamp", "_local_day"


def typed(value: Column, kind: str) -> Column:
    """A vendor's text as a silver type; what doesn't fit is null."""
    text = value.cast("string")
    if kind == "date":
        return C.safe_date(text)
    if kind == "timestamp":
        return C.safe_instant(text)
    if kind == "double":
        return S.safe_double(text)
    return text if kind == "string" else F.nullif(F.trim(text), F.lit("")).try_cast(kind)


def clock(d: Dataset, df: DataFrame) -> Column:
    """The row's instant, by the dataset's rule."""
    kind, _, column = d.clock.partition(":")
    period = lambda: C.settlement_period_to_utc(F.col("settlement_date"), F.col("settlement_period"))
    midnight = lambda c: F.col(c).cast("timestamp")
    if kind == "period":
        return F.coalesce(F.col("start_time"), period()) if d.options.get("half_hour_from") and "start_time" in df.columns else period()
    if kind == "period_or_date":
        return F.coalesce(period(), midnight("settlement_date"))
    if kind == "date":
        return midnight(column)
    if kind == "gas":
        return C.gas_day_instant(F.col(column))
    return F.col(kind)


def finish(df: DataFrame, d: Dataset, provider: str | None = None) -> DataFrame:
    """Provider columns, dedup on the keys that exist, and the declared columns."""
    df = df.withColumns({"data_provider": F.lit(provider or d.source), "ingested_at": F.current_timestamp()})
    keys = [*d.key, *[k for k in d.optional_key if k in df.columns]]
    if keys:
        df = vintage.dedup_keep_last(df, keys, ORDINAL)
    if d.columns is None:
        return df.drop(*OWN_ORDINAL)
    for c in d.columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(column_type(c)))
    carried = [c for c in ("stamp",) if c in df.columns]
    return df.select(*d.columns, *carried)


def _has_columns(records: DataFrame, required: tuple[str, ...]) -> bool:
    """Whether for each column some record has a field under one of its vendor names; only field names are read."""
    keys = F.map_keys(F.from_json("record", "map<string,string>"))
    row = records.agg(*[F.bool_or(F.arrays_overlap(keys, F.array(*[F.lit(v) for v in vendor_names(c)]))).alias(f"h{i}") for i, c in enumerate(required)]).first()
    return all(row)


def from_json(records: DataFrame, d: Dataset) -> DataFrame:
    """Records (path, ordinal, record as JSON text) of a declared dataset.

    A required column that no record has empties the result; rows where it is null stay.
    """
    wanted = [c for c in d.columns if c not in ("timestamp_utc", "data_provider", "ingested_at")]
    helpers = [c for c in ("start_time", "measured_at", "published_at") if c not in wanted]
    names = list(dict.fromkeys(v for c in (*wanted, *helpers) for v in vendor_names(c)))
    fields = F.from_json("record", "map<string,string>")
    rows = records.withColumn("_f", fields)
    cols = {}
    for c in (*wanted, *helpers):
        found = F.coalesce(*[F.try_element_at("_f", F.lit(v)) for v in vendor_names(c)]) if names else F.lit(None)
        cols[c] = typed(found, column_type(c))
    rows = rows.withColumns(cols).drop("_f", "record")
    for c, value in d.options.get("constants", {}).items():
        rows = rows.withColumn(c, F.coalesce(F.col(c), F.lit(value)) if c in rows.columns else F.lit(value))
    if d.name in ("ndf", "ndfd"):  # a forecast for a day alone counts for its first period
        rows = rows.withColumn("settlement_period", F.coalesce("settlement_period", F.when(F.col("settlement_date").isNotNull(), F.lit(1))))
    if d.required and not _has_columns(records, d.required):
        rows = rows.limit(0)
    for c in d.options.get("forbid_blank", ()):
        rows = S.require(rows, F.trim(c) != "", f"blank {c}")
    if d.clock != "none":
        rows = rows.withColumn("timestamp_utc", clock(d, rows))
    return finish(rows, d)


def from_documents(points: DataFrame, d: Dataset) -> DataFrame:
    """Points of market documents: areas, codes and the measure under its own name."""
    ends = ("price_eur_mwh", "amount_eur", "_mw", "_mwh")
    measure = next(c for c in d.columns if c.endswith(ends))
    direction = S.IMBALANCE_DIRECTION if d.options.get("directions") == "imbalance" else S.FLOW_DIRECTION
    area = S.first_text(F.col("control_area_domain"), F.col("area_domain"), F.col("connecting_domain"), F.col("acquiring_domain"), F.col("in_domain"))
    outage = S.enum(F.col("business_type"), S.OUTAGE_TYPE) if d.options.get("outages") == "mapped" else S.enum_or_raw(F.col("business_type"), S.OUTAGE_TYPE)
    made = {
        "area_code": F.coalesce(area, F.lit("")),
        "in_area_code": F.col("in_domain"),
        "out_area_code": F.col("out_domain"),
        "acquiring_area_code": F.col("acquiring_domain"),
        "connecting_area_code": F.col("connecting_domain"),
        "direction": S.enum(F.col("flow_direction") if direction is S.FLOW_DIRECTION else F.col("business_type"), direction),
        "reserve_type": S.enum(F.col("business_type"), S.RESERVE_TYPE),
        "outage_type": outage,
        "currency": S.currency(F.col("currency_unit")),
        "bid_mrid": F.col("timeseries_mrid"),
        "published_at": C.parse_published(F.col("document_created_at")),
    }
    made = {k: v for k, v in made.items() if k in d.columns}
    rows = points.withColumnRenamed("value", measure).withColumns(made)
    if "area_name" in d.columns:
        rows = rows.withColumn("area_name", S.area_name(F.col("area_code")))
    for c, value in d.options.get("constants", {}).items():
        rows = rows.withColumn(c, F.lit(value))
    return finish(rows, d)


def from_flows(records: DataFrame, d: Dataset) -> DataFrame:
    """Physical gas flows in GWh a day; rows of unknown units or broken values go."""
    f = F.from_json("record", "map<string,string>")
    get = lambda n: F.try_element_at("_f", F.lit(n))
    rows = records.withColumn("_f", f)
    keep = (F.coalesce(get("indicator"), F.lit("Physical Flow")) == "Physical Flow") & (F.coalesce(F.trim(get("pointKey")), F.lit("")) != "") & S.usable_value(get("value"))
    unit = F.coalesce(get("unit"), F.lit("kWh/d"))
    rows = rows.filter(keep).filter(S.known_unit(unit))
    cols = {c: get(v) for c, v in (("point_key", "pointKey"), ("point_label", "pointLabel"), ("operator_key", "operatorKey"), ("operator_label", "operatorLabel"), ("direction_key", "directionKey"))}
    cols |= {"timestamp_utc": C.parse_lenient(get("periodFrom")), "flow_gwh_per_day": S.to_gwh_day(S.safe_double(get("value")), unit), "unit": F.lit("GWh/d")}
    return finish(rows.withColumns(cols), d)


_OBJECT = "map<string,string>"


def inventory(records: DataFrame) -> DataFrame:
    """Company records found at any depth, and the facilities of each as rows of their own.

    An object with a list of facilities is a company. Any other object gives way to what its entries
    hold, however deep; lists are looked at for companies only. Facilities carry the code and name
    of their company. A row's ordinal is the path of places that led to it, so none collide.
    """
    carried = [c for c in records.columns if c not in ("record", "ordinal")]
    is_company = F.coalesce(F.get_json_object("record", "$.facilities").startswith("["), F.lit(False))
    companies = []
    level = records.withColumns({"ordinal": F.array(F.col("ordinal").cast("int")), "listed": F.lit(False)})
    while True:  # one round a level of nesting
        companies.append(level.filter(is_company).drop("listed"))
        entries = F.map_values(F.from_json("record", _OBJECT))
        items = F.flatten(F.transform(entries, lambda v: F.when(v.startswith("["), F.transform(F.from_json(v, "array<string>"), lambda x: F.struct(x.alias("record"), F.lit(True).alias("listed")))).when(v.startswith("{"), F.array(F.struct(v.alias("record"), F.lit(False).alias("listed")))).otherwise(F.array().cast("array<struct<record:string,listed:boolean>>"))))
        level = level.filter(~is_company & ~F.col("listed") & F.col("record").startswith("{")).select(*carried, "ordinal", F.posexplode(items).alias("i", "x"))
        level = level.select(*carried, F.concat("ordinal", F.array("i")).alias("ordinal"), "x.record", "x.listed").filter(F.col("record").startswith("{"))
        if level.isEmpty():
            break
    flat = tables.union_all(companies)
    field = lambda c, n: F.get_json_object(c, f"$.{n}")
    code = lambda c: F.coalesce(F.nullif(field(c, "eic"), F.lit("")), F.nullif(field(c, "code"), F.lit("")), F.lit(""))
    name = lambda c: F.coalesce(F.nullif(field(c, "name"), F.lit("")), F.nullif(field(c, "short_name"), F.lit("")), code(c))
    named = lambda level, c: F.create_map(F.lit("entity_level"), F.lit(level), F.lit("entity_code"), code(c), F.lit("entity_name"), name(c))
    made = ("entity_level", "entity_code", "entity_name", "company", "company_code", "company_name")
    rest = lambda c: F.map_filter(F.from_json(c, _OBJECT), lambda k, v: ~k.isin("facilities", *made))
    own = flat.withColumns({"record": F.to_json(F.map_concat(rest("record"), named("company", "record"))), "ordinal": F.concat("ordinal", F.array(F.lit(-1)))})
    below = flat.select("*", F.posexplode(F.from_json(F.get_json_object("record", "$.facilities"), "array<string>")).alias("i", "f")).filter(F.col("f").startswith("{"))
    company = F.create_map(F.lit("company"), name("record"), F.lit("company_code"), code("record"), F.lit("company_name"), name("record"))
    facility = below.withColumns({"record": F.to_json(F.map_concat(rest("f"), named("facility", "f"), company)), "ordinal": F.concat("ordinal", F.array("i"))})
    return own.unionByName(facility.drop("i", "f"))


def from_dynamic(records: DataFrame, d: Dataset) -> DataFrame:
    """Payloads whose columns are found in the data: names normalised, numbers and instants by name.

    LOCAL_DAY, for the day's filter, is the date as the vendor wrote it, before it becomes UTC. A field
    named like a column of the scan (path, ordinal, stamp, day) is a column like others.
    """
    if d.name in ("about_summary", "about_listing"):
        records = inventory(records)
    names = records.select(F.explode(F.map_keys(F.from_json("record", "map<string,string>"))).alias("k")).distinct()
    found = sorted(r.k for r in names.collect())  # as many as the payload has columns
    rows = records.withColumn("_f", F.from_json("record", "map<string,string>"))
    own = [F.col(c).alias(o) for c, o in zip((*ORDINAL, "stamp"), (*OWN_ORDINAL, OWN_STAMP), strict=True) if c in records.columns]
    fields = S.merged_names(found, lambda n: F.try_element_at("_f", F.lit(n)), d.options.get("blanks_yield", False))
    wide = rows.select(*own, *fields)
    cast = {}
    written = [C.safe_date(F.col(c)) for c in S.INSTANT_PRIORITY if c in wide.columns]
    wide = wide.withColumn(LOCAL_DAY, F.coalesce(*written) if written else F.lit(None).cast("date"))
    for c in wide.columns:
        if c not in (*OWN_ORDINAL, OWN_STAMP, LOCAL_DAY):
            if S.is_instant_name(c):
                cast[c] = C.parse_lenient(F.col(f"`{c}`"))
            elif S.is_numeric_name(c):
                cast[c] = S.safe_double(F.col(f"`{c}`"))
    wide = wide.withColumns(cast) if cast else wide
    instant = [F.col(c) for c in S.INSTANT_PRIORITY if c in wide.columns]
    if instant and d.source == "entsog":
        wide = wide.withColumn("timestamp_utc", F.coalesce(*instant))
    subset = [c for c in d.options.get("dedup", ()) if c in wide.columns]
    if d.options.get("dedup") is not None:
        wide = vintage.dedup_keep_last(wide, subset, OWN_ORDINAL) if subset else wide
    else:
        wide = vintage.dedup_whole_rows(wide, OWN_ORDINAL, ("timestamp_utc", OWN_STAMP, LOCAL_DAY))
    return finish(wide, d)


def from_storage(records: DataFrame, d: Dataset) -> DataFrame:
    """Gas storage by country, company or facility; the request's own parameters tell the level."""
    f = F.from_json("record", "map<string,string>")
    get = lambda *ns: S.first_text(*[F.try_element_at("_f", F.lit(n)) for n in ns])
    ask = (lambda n: F.try_element_at(F.col("meta")["request_params"], F.lit(n))) if "meta" in records.columns else (lambda n: F.lit(None).cast("string"))
    rows = records.withColumn("_f", f)
    level = S.entity_level(ask("facility"), ask("company"), ask("country"), ask("type"))
    code = F.coalesce(get("code", "eic", "country_code"), *[F.nullif(ask(n), F.lit("")) for n in ("facility", "company", "country", "type")], F.lit(""))
    rows = rows.withColumns({"gas_day": C.safe_date(get("gasDayStart", "gas_day")), "gas_day_end": C.safe_instant(get("gasDayEnd")), "updated_at": C.safe_instant(get("updatedAt")), "entity_level": level, "entity_code": code})
    country = F.coalesce(S.first_text(ask("country"), get("countryCode", "country")), F.when(F.col("entity_level") == "country", F.col("entity_code")), F.lit(""))
    rows = rows.withColumns({"entity_name": F.coalesce(get("name", "country_name"), F.col("entity_code")), "entity_url": get("url"), "country_code": country})
    rows = rows.withColumn("country_name", F.when(F.col("country_code") == F.col("entity_code"), F.col("entity_name")).otherwise(get("countryName", "country_name")))
    measures = {c: S.safe_double(get(v)) for c, v in {
        "gas_in_storage_gwh": "gasInStorage", "consumption_gwh": "consumption", "consumption_full_pct": "consumptionFull", "injection_gwh": "injection", "withdrawal_gwh": "withdrawal",
        "net_withdrawal_gwh": "netWithdrawal", "working_gas_volume_gwh": "workingGasVolume", "injection_capacity_gwh_per_day": "injectionCapacity", "withdrawal_capacity_gwh_per_day": "withdrawalCapacity",
        "contracted_capacity_gwh_per_day": "contractedCapacity", "available_capacity_gwh_per_day": "availableCapacity", "covered_capacity_gwh_per_day": "coveredCapacity", "storage_pct_full": "full", "trend": "trend",
    }.items()}
    return finish(rows.withColumns(measures | {"status": get("status"), "info": get("info")}).filter("gas_day IS NOT NULL"), d, "gie_agsi")


def from_lng(records: DataFrame, d: Dataset) -> DataFrame:
    """LNG terminals, with the share of capacity in store derived."""
    get = lambda *ns: S.first_text(*[F.try_element_at("_f", F.lit(n)) for n in ns])
    rows = records.withColumn("_f", F.from_json("record", "map<string,string>"))
    limits = F.from_json(get("dtmi"), "lng string, gwh string")
    num = {"lng_in_storage_gwh": get("lngInventory", "gasInStorage"), "send_out_gwh": get("sendOut", "withdrawal"), "injection_gwh": get("injection"), "dtrs": get("dtrs"), "trend": get("trend"), "dtmi_lng": limits["lng"], "dtmi_gwh": limits["gwh"]}
    rows = rows.withColumns({"gas_day": C.safe_date(get("gasDayStart", "gas_day")), "country_code": get("code"), "country_name": get("name")} | {c: S.safe_double(v) for c, v in num.items()})
    rows = rows.withColumn("lng_pct_full", S.percent_full(F.col("lng_in_storage_gwh"), F.col("dtmi_gwh")))
    return finish(rows.filter("gas_day IS NOT NULL"), d, "gie_alsi")


_MIX = "array<struct<fuel:string,perc:string>>"


def from_carbon(records: DataFrame, d: Dataset) -> DataFrame:
    """Carbon intensity families: plain, statistics, factors, generation shares, regions."""
    family = d.recipe.removeprefix("carbon_")
    at = lambda c: C.parse_minute(F.col(c))
    num = lambda c: S.safe_double(c)
    j = F.get_json_object
    if family == "factors":
        rows = records.select(*ORDINAL, F.explode(F.from_json("record", "map<string,string>")).alias("fuel", "v"))
        return finish(rows.select(*ORDINAL, S.slug(F.col("fuel")).alias("fuel"), num(F.col("v")).alias("factor_gco2_kwh")), d)
    if family == "regional":
        # two shapes: periods with regions, and a region with periods; either may carry its own mix
        outer = records.select(*ORDINAL, "record", F.from_json(F.coalesce(j("record", "$.regions"), j("record", "$.data"), F.concat(F.lit("["), "record", F.lit("]"))), "array<string>").alias("items"))
        rows = outer.select(*ORDINAL, "record", F.posexplode_outer("items").alias("_i", "item"))
        pick = lambda path: F.coalesce(j("item", path), j("record", path))
        rows = rows.select(
            *ORDINAL, "_i", pick("$.from").alias("from"), pick("$.to").alias("to"), pick("$.regionid").try_cast("int").alias("regionid"), pick("$.shortname").alias("shortname"), pick("$.dnoregion").alias("dnoregion"), pick("$.postcode").alias("postcode"),
            num(pick("$.intensity.forecast")).alias("forecast_gco2_kwh"), pick("$.intensity.index").alias("intensity_index"), F.posexplode_outer(F.from_json(pick("$.generationmix"), _MIX)).alias("_k", "m"),
        )
        rows = rows.withColumns({"timestamp_utc": at("from"), "period_end_utc": at("to"), "fuel": F.col("m.fuel"), "generation_pct": num(F.col("m.perc")), "ordinal": F.array(F.col("ordinal"), F.coalesce("_i", F.lit(0)), F.coalesce("_k", F.lit(0)))})
        return finish(rows, d)
    rows = records.withColumns({"from": j("record", "$.from"), "to": j("record", "$.to")}).withColumns({"timestamp_utc": at("from"), "period_end_utc": at("to")})
    if family == "generation":
        rows = rows.select(*ORDINAL, "timestamp_utc", "period_end_utc", F.posexplode(F.from_json(j("record", "$.generationmix"), _MIX)).alias("_k", "m"))
        return finish(rows.withColumns({"fuel": F.col("m.fuel"), "generation_pct": num(F.col("m.perc")), "ordinal": F.array("ordinal", "_k")}), d)
    value = lambda n: num(j("record", f"$.intensity.{n}"))
    cols = {"intensity_index": j("record", "$.intensity.index")}
    cols |= {"stats_max": value("max"), "stats_average": value("average"), "stats_min": value("min")} if family == "stats" else {"forecast_gco2_kwh": value("forecast"), "actual_gco2_kwh": value("actual")}
    return finish(rows.withColumns(cols), d)


def from_weather(records: DataFrame, d: Dataset) -> DataFrame:
    """Hourly columns of arrays become rows (short or absent ones padded with null); speeds in m/s; degree days and air density derived.

    `record` is a whole body; `location` may come beside it.
    """
    names = d.options["variables"]
    hourly = F.from_json(F.get_json_object("record", "$.hourly"), "time array<string>, " + ", ".join(f"{n} array<double>" for n in names))
    place = F.col("location") if "location" in records.columns else F.get_json_object("record", "$.location")
    spot = {c: S.safe_double(F.get_json_object("record", f"$.{c}")) for c in ("latitude", "longitude")}
    rows = records.withColumns(spot | {"location": place, "_h": hourly})
    rows = rows.select("path", "location", "latitude", "longitude", F.posexplode(F.arrays_zip(*[F.coalesce(F.col("_h")[n], F.array()).alias(n) for n in ("time", *names)])).alias("ordinal", "r"))
    cols = {WEATHER[n]: S.kmh_to_mps(F.col("r")[n]) if WEATHER[n].endswith("_mps") else F.col("r")[n] for n in names}
    t = F.col("r")["temperature_2m"]
    cols |= {"hdd_k": S.heating_degrees(t), "cdd_k": S.cooling_degrees(t)}
    if "surface_pressure" in names:
        cols["air_density_kg_m3"] = S.air_density(F.col("r")["surface_pressure"], t)
    return finish(rows.withColumns(cols | {"timestamp_utc": C.parse_document_instant(F.col("r")["time"])}).filter("timestamp_utc IS NOT NULL"), d)


#: Headers of the portal's files, in order.
HEADERS = {
    "daily_wind_availability": ("BMU_ID", "Date", "MW"),
    "embedded_wind_solar_forecast": ("DATE_GMT", "TIME_GMT", "SETTLEMENT_DATE", "SETTLEMENT_PERIOD", "EMBEDDED_WIND_FORECAST", "EMBEDDED_WIND_CAPACITY", "EMBEDDED_SOLAR_FORECAST", "EMBEDDED_SOLAR_CAPACITY"),
    "historic_generation_mix": ("DATETIME", *[f.upper() for f in FUELS], *[f"{f.upper()}_perc" for f in FUELS if f != "carbon_intensity"]),
}


def from_csv(rows: DataFrame, d: Dataset) -> DataFrame:
    """Portal snapshots (all strings, with published_at and issue_time of their file)."""
    if d.recipe == "csv_wind":
        day = C.safe_date(F.col("Date"))
        made = {"bmu_id": F.col("BMU_ID"), "availability_date": day, "availability_mw": S.safe_double(F.col("MW")), "timestamp_utc": C.day_start_utc(day)}
    elif d.recipe == "csv_embedded":
        made = {"settlement_date": C.safe_date(F.col("SETTLEMENT_DATE")), "settlement_period": F.col("SETTLEMENT_PERIOD").try_cast("int"), "time_gmt_raw": F.col("TIME_GMT")}
        made |= {h.lower(): S.safe_double(F.col(h)) for h in HEADERS[d.name][4:]}
    else:
        made = {"timestamp_utc": C.strict_instant(F.regexp_replace("DATETIME", " ", "T"))}
        made |= {h.lower().replace("_perc", "_pct"): F.col(h).cast("double") for h in HEADERS[d.name][1:]}
    kept = [c for c in ("published_at", "issue_time", "stamp") if c in rows.columns]
    out = rows.select(*ORDINAL, *kept, *[v.alias(k) for k, v in made.items()])
    if d.recipe == "csv_embedded":
        out = out.filter(C.period_is_valid(F.col("settlement_date"), F.col("settlement_period")))
    return finish(out, d)


RECIPES = {"json": from_json, "flows": from_flows, "dynamic": from_dynamic, "storage": from_storage, "lng": from_lng, "weather": from_weather, "xml": from_documents}
RECIPES |= {f"carbon_{k}": from_carbon for k in ("intensity", "factors", "stats", "generation", "regional")}
RECIPES |= {f"csv_{k}": from_csv for k in ("wind", "embedded", "mix")}


def transform(rows: DataFrame, d: Dataset) -> DataFrame:
    """Scanned rows of a dataset in its silver form."""
    return finish(rows, d) if d.recipe == "xml_units" else RECIPES[d.recipe](rows, d)


#: Datasets whose newest directory stands for a day without one.
INVENTORIES = ("about_summary", "about_listing", "news", "news_item")


def check_gas_day(records: DataFrame, day: date) -> DataFrame:
    """Fails at a record whose gas day isn't the one asked for; records without one pass."""
    own = C.safe_date(F.coalesce(F.get_json_object("record", "$.gasDayStart"), F.get_json_object("record", "$.gas_day")))
    return S.require(records, F.coalesce(own == F.lit(day), F.lit(True)), f"a gas day other than {day}")


def scan(spark: SparkSession, root: str, d: Dataset, day: date) -> DataFrame:
    """A day's bronze rows in the form that the dataset's recipe takes; some sources fall back to an earlier day that covers it."""
    found = day if d.source in ("entsoe", "entsog") or d.name in INVENTORIES else bronze.covering_day(spark, root, d.source, d.name, day) or day
    files = bronze.list_files(spark, root, d.source, d.name, found)
    if d.name in INVENTORIES and not bronze.has_day(spark, root, d.source, d.name, found):
        newest = bronze.latest_directory(bronze.list_files(spark, root, d.source, d.name)).first()
        files = bronze.list_files(spark, root, d.source, d.name, newest.day) if newest else files
    own = bronze.newest_vouched(files) if d.options.get("newest_file") else bronze.vouched(files)
    own = own.filter("ext != '.tmp'")
    if d.recipe == "xml":
        return market_xml.read_documents(own, "price.amount" if any(c == "price_eur_mwh" for c in d.columns) else "quantity")
    if d.recipe == "xml_units":
        return market_xml.read_units(own)
    if d.recipe.startswith("csv_"):
        meta = own.select("path", "stamp", bronze.published_from(F.col("meta")).alias("published_at"), bronze.issue_time(F.col("meta")).alias("issue_time")).filter("published_at IS NOT NULL")
        paths = [r.path for r in meta.select("path").collect()]  # one snapshot file or a few a day
        return bronze.csv_records(spark, paths, HEADERS[d.name]).join(meta, "path") if paths else spark.createDataFrame([], "path string, ordinal int, " + ", ".join(f"{h} string" for h in HEADERS[d.name]))
    if d.recipe == "weather":
        return own.select("path", F.lit(0).alias("ordinal"), F.col("content").cast("string").alias("record"), F.try_element_at(F.col("meta")["request_params"], F.lit("location")).alias("location"))
    return bronze.json_records(own, d.options.get("record_key", "data"))


def owned(rows: DataFrame, d: Dataset, day: date) -> DataFrame:
    """The rows that belong to a day, by the rule of their shape; rows without a date stay."""
    target = F.lit(day)
    if d.recipe == "dynamic":
        cols = rows.columns
        text = lambda c: C.safe_date(F.col(c).cast("string")) if c in cols else F.lit(None).cast("date")
        if d.name in ("news", "news_item"):
            rows = rows.filter(windows.classify_event(text("start_at"), text("end_at"), text("updated_at"), target, target) != "outside")
        elif d.name == "unavailability":
            rows = rows.filter(windows.overlaps_day(text("event_start"), text("event_end"), target))
        elif d.options.get("windowed"):
            rows = rows.filter(windows.on_day_or_undated(F.col(LOCAL_DAY), target))
        return rows.drop(LOCAL_DAY)
    if d.recipe in ("storage", "lng"):
        return rows.filter(windows.on_day_or_undated(F.col("gas_day"), target))
    if d.recipe == "weather":
        return rows.filter(windows.on_day_or_undated(F.col("timestamp_utc").cast("date"), target))
    return rows


def neighbour_owns(spark: SparkSession, root: str, d: Dataset, day: date) -> bool:
    """Whether the next day's partition holds a whole request that covers its first instant."""
    next_day = date.fromordinal(day.toordinal() + 1)
    files = bronze.list_files(spark, root, d.source, d.name, next_day)
    side = bronze.sidecars(files).filter("meta IS NOT NULL").select("stem", "meta.*")
    sound = windows.request_windows(side, d.source, d.name, "publishDateTimeFrom", "publishDateTimeTo").filter("reason IS NULL")
    held = bronze.bodies(files).select("stem", F.lit(True).alias("has_body"))
    chunks = windows.durable_chunks(sound.join(held, "stem", "left").withColumn("has_body", F.coalesce("has_body", F.lit(False))))
    return not windows.covering_is_durable(chunks, F.lit(next_day).cast("timestamp")).isEmpty()


@dataclass(frozen=True)
class Result:
    """What a run wrote and what it counted."""

    frame: DataFrame
    status: str
    written: int = 0
    window_dropped: int = 0
    window_undated: int = 0
    window_unresolved: int = 0
    unvouched: int = 0
    bodies: int = 0
    broken: dict | None = None  # rows that break each rule; they are written all the same

    @property
    def message(self) -> str:
        parts = [f"{n} {what}" for n, what in ((self.window_dropped, "out of the request's window"), (self.window_undated, "without an instant"), (self.window_unresolved, "without a sound window"), (self.unvouched, "files without a stamp")) if n]
        return ", ".join(parts + [f"{n} break {rule}" for rule, n in (self.broken or {}).items() if n])


def request_window(spark: SparkSession, root: str, d: Dataset, day: date) -> tuple[datetime, datetime] | None:
    """The hull of what a day's requests asked for; None unless every body has a sound sidecar."""
    files = bronze.list_files(spark, root, d.source, d.name, day)
    side = bronze.sidecars(files).select("stem", "meta.*")
    beside = bronze.bodies(files).filter("ext != '.tmp'").select("stem").join(side, "stem", "left")
    params = windows.WINDOW_PARAMS.get(d.source)
    if params is None:
        return None
    hull = windows.partition_window(windows.request_windows(beside, d.source, d.name, *params)).first()
    return (hull.window_start, hull.window_end) if hull.usable else None


def execute(spark: SparkSession, root: str, silver: str, source: str, name: str, day: date, run_id: str, csv: str | None = None) -> Result:
    """Scan, transform, stamp and write one dataset's day, and count what became of its rows.

    A half-open dataset keeps what its own requests asked for; if that leaves nothing of some rows, the
    run fails and nothing is written. Without sound sidecars nothing is filtered.
    """
    d = dataset(source, name)
    rows = owned(transform(scan(spark, root, d, day), d), d, day)
    carrier = OWN_STAMP if d.columns is None else "stamp"
    stamp = F.coalesce(F.col(carrier), F.current_timestamp()) if carrier in rows.columns else F.current_timestamp()
    gas = d.clock.partition(":")[2] if d.clock.startswith("gas") else None
    out = bitemporal.stamp_rows(rows, run_id, d.version, stamp, day, gas).drop(carrier)
    files = bronze.vouched(bronze.list_files(spark, root, source, name, day)).filter("ext != '.tmp'")
    seen = files.agg(F.count("*").alias("n"), F.count("reason").alias("bad")).first()
    dropped = undated = unresolved = 0
    if d.half_open:
        window = request_window(spark, root, d, day)
        if window is None:
            unresolved = 1
        else:
            start, end = (F.lit(x) for x in window)
            counts = windows.window_counts(out, "timestamp_utc", start, end).first()
            dropped, undated = counts.dropped, counts.undated
            out = windows.half_open_filter(out, "timestamp_utc", start, end)
            if dropped and not counts.kept and not undated:
                return Result(out.limit(0), runs.status(0, True, False, 0, 0), 0, dropped, 0, 0, seen.bad, seen.n)
    next_day = date.fromordinal(day.toordinal() + 1)
    closed = windows.closed_window_column(name) if source == "elexon" else None
    if closed and closed in out.columns and bronze.has_day(spark, root, source, name, next_day) and neighbour_owns(spark, root, d, day):
        out = windows.closed_filter(out, closed, F.lit(next_day).cast("timestamp"), F.lit(True))
    out = out.withColumn("partition_date", F.lit(day))
    vintage_name = ""
    if d.append_only:
        newest = out.agg(F.max("available_at")).first()[0]
        vintage_name = f"{newest:%Y%m%dT%H%M%S%f}" if newest else "none"
    tables.write_silver(out, f"{silver}/{source}/{name}", append_only=d.append_only, vintage=vintage_name, order=(*d.key, *d.options.get("entity", ()), "timestamp_utc"), csv=csv)
    written = spark.read.schema(out.schema).option("basePath", f"{silver}/{source}/{name}").parquet(_partition(f"{silver}/{source}/{name}", day, vintage_name)) if not out.isEmpty() else out.limit(0)
    counted = rules.validate(written, d).first().asDict()
    n = counted.pop("n_rows")
    unvouched_all = bool(seen.n) and seen.bad == seen.n and d.append_only
    status = runs.status(n, False, unvouched_all, 0, seen.bad + unresolved + sum(counted.values()))
    return Result(written, status, n, dropped, undated, unresolved, seen.bad, seen.n, counted)


def _partition(path: str, day: date, vintage_name: str) -> str:
    return f"{path}/year={day.year}/month={day.month}/partition_date={day}" + (f"/vintage={vintage_name}" if vintage_name else "")


def run(spark: SparkSession, root: str, silver: str, source: str, name: str, day: date, run_id: str) -> DataFrame:
    """`execute`, for what was written; raises where that fails."""
    result = execute(spark, root, silver, source, name, day, run_id)
    if result.status == "failed":
        raise RuntimeError(f"{source}/{name} {day}: {result.message or 'nothing could be written'}")
    return result.frame


def backfill(spark: SparkSession, root: str, silver: str, source: str, name: str, start: datetime, end: datetime, run_id: str) -> list[tuple[date, Result]]:
    """One run for each UTC day of [start, end): the day on which the last chunk ends isn't touched, nor is any watermark."""
    return [(a.date(), execute(spark, root, silver, source, name, a.date(), run_id)) for a, _ in C.python_subwindows(start, end)]
