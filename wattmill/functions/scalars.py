"""Names, units, codes and derived measures as Column functions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Market area codes and their names.
AREA_NAMES = {
    "10YGB----------A": "Great Britain",
    "10Y1001A1001A82H": "Germany / Luxembourg",
    "10YFR-RTE------C": "France",
    "10YNL----------L": "Netherlands",
    "10YBE----------2": "Belgium",
    "10YES-REE------0": "Spain",
    "10YIT-GRTN-----B": "Italy (North)",
    "10YDK-1--------W": "Denmark (DK1)",
    "10YDK-2--------M": "Denmark (DK2)",
    "10YNO-1--------2": "Norway (NO1)",
    "10Y1001A1001A44P": "Sweden (SE1)",
    "10Y1001A1001A59C": "Ireland (SEM)",
}
#: Factors to GWh a day, by unit.
GWH_DAY = {
    "kwh/d": 1e-6, "kwh/day": 1e-6, "kwh/h": 24e-6, "kwh/hr": 24e-6,
    "mwh/d": 1e-3, "mwh/day": 1e-3, "mwh/h": 24e-3, "mwh/hr": 24e-3,
    "gwh/d": 1.0, "gwh/day": 1.0, "gwh/h": 24.0, "gwh/hr": 24.0,
}
#: Coded enumerations.
IMBALANCE_DIRECTION = {"A19": "long", "A20": "short"}
RESERVE_TYPE = {"A95": "fcr", "A96": "afrr", "A97": "mfrr", "A98": "rr"}
FLOW_DIRECTION = {"A01": "up", "A02": "down"}
OUTAGE_TYPE = {"A53": "planned", "A54": "unplanned"}
#: Degree-day bases (C) and the gas constant of dry air (J / (kg K)).
HEATING_BASE, COOLING_BASE, DRY_AIR = 15.5, 22.0, 287.05
UNMAPPED = "unmapped"


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def snake_case(name: str) -> str:
    """camelCase, spaces and dashes to snake_case, for column names."""
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return re.sub(r"_+", "_", re.sub(r"[\s\-]+", "_", name)).strip("_").lower()


def merged_names(names: list[str], value: Callable[[str], Column], blanks_yield: bool = False) -> list[Column]:
    """One column for each snake_case name; of names that meet, the first value from the left that isn't null (nor blank, if so asked)."""
    groups: dict[str, list[str]] = {}
    for n in names:
        groups.setdefault(snake_case(n), []).append(n)
    pick = (lambda n: F.nullif(value(n).cast("string"), F.lit(""))) if blanks_yield else value
    return [(value(ns[0]) if len(ns) == 1 else F.coalesce(*map(pick, ns))).alias(n) for n, ns in groups.items()]


def normalise_names(df: DataFrame, blanks_yield: bool = False) -> DataFrame:
    """Columns renamed to snake_case, and those that meet made one."""
    return df.select(*merged_names(df.columns, lambda c: F.col(f"`{c}`"), blanks_yield))


def slug(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))


def currency(text: Column, default: str = "EUR") -> Column:
    clean = F.trim(text)
    return F.when(clean != "", clean).otherwise(F.lit(default))


def enum(code: Column, values: dict[str, str]) -> Column:
    """The code's name, or `unmapped`; null counts as unmapped."""
    return F.coalesce(F.try_element_at(literal_map(values), code), F.lit(UNMAPPED))


def enum_or_raw(code: Column, values: dict[str, str]) -> Column:
    """The code's name, or the code itself."""
    return F.coalesce(F.try_element_at(literal_map(values), code), code)


def area_name(code: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(AREA_NAMES), code), F.lit(""))


def known_unit(unit: Column) -> Column:
    return F.lower(F.trim(unit)).isin(*GWH_DAY)


def to_gwh_day(value: Column, unit: Column) -> Column:
    """Null for an unknown unit; such rows are to be dropped with a count."""
    return value * F.try_element_at(literal_map(GWH_DAY), F.lower(F.trim(unit)))


def safe_double(text: Column) -> Column:
    return F.nullif(F.trim(text.cast("string")), F.lit("")).try_cast("double")


def finite(value: Column) -> Column:
    """False for what is not a number or infinite; null is true."""
    return ~(F.isnan(value) | (F.abs(value) == F.lit(float("inf")))) | value.isNull()


def usable_value(text: Column) -> Column:
    """Whether a raw value is blank (kept as null) or a finite number."""
    blank = text.isNull() | (F.trim(text) == "")
    number = F.trim(text).try_cast("double")
    return blank | (number.isNotNull() & finite(number))


def kmh_to_mps(speed: Column) -> Column:
    return speed * F.lit(1.0 / 3.6)


def heating_degrees(t: Column) -> Column:
    return F.when(t.isNotNull(), F.greatest(F.lit(0.0), F.lit(HEATING_BASE) - t))


def cooling_degrees(t: Column) -> Column:
    return F.when(t.isNotNull(), F.greatest(F.lit(0.0), t - F.lit(COOLING_BASE)))


def air_density(pressure_hpa: Column, t: Column) -> Column:
    return pressure_hpa * 100 / (F.lit(DRY_AIR) * (t + 273.15))


def percent_full(level: Column, capacity: Column) -> Column:
    """Clamped to 0..100; null without a positive capacity."""
    raw = level / capacity * 100
    return F.when((capacity > 0) & raw.isNotNull(), F.least(F.greatest(raw, F.lit(0.0)), F.lit(100.0)))


def entity_level(facility: Column, company: Column, country: Column, kind: Column) -> Column:
    """The narrowest level that a request names."""
    has = lambda c: c.isNotNull() & (c != "")
    return F.when(has(facility), "facility").when(has(company), "company").when(has(country), "country").otherwise(F.coalesce(F.nullif(kind, F.lit("")), F.lit("country")))


def first_text(*cols: Column) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cols])


def link_slug(url: Column) -> Column:
    """The `turl` query value, else the last path segment."""
    return first_text(F.regexp_extract(url, r"[?&]turl=([^&#]+)", 1), F.regexp_extract(url, r"([^/?#]+)/*(?:[?#].*)?$", 1))


def sorted_json(value: Column) -> Column:
    """JSON text of a string map, keys ascending."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(value))))


def mask_secret(url: Column, names: tuple[str, ...] = ("key", "api_key", "apikey", "token", "securityToken")) -> Column:
    """Values of secret query parameters give way to a mark."""
    return F.regexp_replace(url, rf"(?i)([?&](?:{'|'.join(names)})=)[^&#]*", "$1***")


def require(df: DataFrame, rule: Column, message: str) -> DataFrame:
    """Fail the job at the first row that breaks a rule."""
    return df.filter(F.when(F.coalesce(rule, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


#: Name rules of schema-dynamic payloads.
NUMERIC_SUFFIXES = ("_value", "_price", "_volume", "_capacity", "_count", "_rate", "_x", "_y")
NUMERIC_NAMES = ("value", "auction_premium", "cleared_price", "reserve_price", "requested_volume", "allocated_volume", "unallocated_volume", "unavailable_capacity", "available_capacity", "technical_capacity", "count_point_presents", "adjacent_systems_count")
INSTANT_NAMES = ("period_from", "period_to", "original_period_from", "last_update_date_time", "publication_date_time", "event_start", "event_stop", "auction_from", "auction_to", "capacity_from", "capacity_to", "product_period_from", "product_period_to", "valid_from", "valid_to")
INSTANT_PRIORITY = ("period_from", "publication_date_time", "event_start", "auction_from", "capacity_from", "valid_from", "last_update_date_time")


def is_numeric_name(name: str) -> bool:
    return name in NUMERIC_NAMES or name.endswith(NUMERIC_SUFFIXES)


def is_instant_name(name: str) -> bool:
    return name in INSTANT_NAMES or name.endswith("_at")
