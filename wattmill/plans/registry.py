"""Datasets as declarations: what each silver table holds, keys and flags; recipes turn them into plans.

A column's vendor name is its own name in camelCase unless VENDOR_NAMES says otherwise, and its
type follows from its name, so a dataset is its list of columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

TAIL = ("data_provider", "ingested_at")

#: Vendor names that differ from the camelCase of a column, in order of preference.
VENDOR_NAMES = {
    "published_at": ("publishDateTime", "publishTime"),
    "generation_mw": ("generation", "quantity"),
    "document_revision": ("documentRevisionNumber",),
    "total_load_mw": ("quantity",),
    "bm_unit_id": ("bmUnit", "elexonBmUnit"),
    "bm_unit_name": ("name", "bmUnitName"),
    "registered_capacity_mw": ("registeredCapacity", "generationCapacity"),
    "company_name": ("companyName", "leadPartyName"),
    "settlement_date": ("settlementDate", "forecastDate"),
    "settlement_period": ("settlementPeriod", "settlementPeriodFrom"),
    "deem_flag": ("deemedBoFlag",),
    "stor_flag": ("storProviderFlag", "storFlag"),
    "bid_offer_level_from": ("levelFrom",),
    "bid_offer_level_to": ("levelTo",),
    "national_demand_mw": ("nationalDemand", "demand"),
    "transmission_demand_mw": ("transmissionSystemDemand",),
    "adjustment_action_id": ("id",),
    "component": ("component", "service"),
    "output_usable_mw": ("outputUsable",),
    "frequency_hz": ("frequency",),
    "indicated_imbalance": ("indicatedImbalance", "imbalance"),
    "indicated_demand_mw": ("demand",),
    "indicated_generation_mw": ("generation",),
    "initial_demand_outturn_mw": ("demand",),
    "initial_transmission_system_demand_outturn_mw": ("demand",),
    "forecast_demand_mw": ("demand",),
    "derated_margin_mw": ("deratedMargin",),
    "indicated_margin": ("indicatedMargin", "margin"),
    "data_provider_id": ("dataProviderId", "dataProvider"),
    "market_index_price": ("midPrice", "price"),
    "market_index_volume": ("volume",),
    "affected_unit_eic": ("affectedUnitEIC",),
    "run_type": ("settlementRunType",),
    "normal_temperature": ("normal",),
    "low_temperature": ("low",),
    "high_temperature": ("high",),
    "initial_forecast_mw": ("initialForecast",),
    "latest_forecast_mw": ("latestForecast", "generation"),
    "start_time": ("startTimeOfHalfHrPeriod", "startTime"),
    "measured_at": ("reportDateTime", "measurementTime"),
}
STRINGS = ("acceptance_number", "document_id")


def vendor_names(column: str, prefer: dict[str, tuple[str, ...]] | None = None) -> tuple[str, ...]:
    """Names under which a vendor may send a column."""
    if prefer and column in prefer:
        return prefer[column]
    if column in VENDOR_NAMES:
        return VENDOR_NAMES[column]
    bare = column
    for unit in ("_mwh", "_mw"):
        bare = bare.removesuffix(unit)
    head, *rest = bare.split("_")
    return (head + "".join(w.capitalize() for w in rest),)


def column_type(column: str) -> str:
    """Spark's type name for a silver column, from its name."""
    if column in ("settlement_date", "gas_day", "measurement_date", "forecast_date", "availability_date"):
        return "date"
    if column in ("settlement_period", "revision_number", "document_revision", "bid_offer_pair_number", "regionid"):
        return "int"
    if column in ("timestamp_utc", "gas_day_end", "issue_time", "implementation_datetime_utc") or column.endswith(("_at", "_time", "_end_utc")):
        return "timestamp"
    if column.endswith("_flag"):
        return "boolean"
    words = ("_mw", "_mwh", "_pct", "_gwh", "price", "volume", "level_from", "level_to", "_gco2_kwh", "_mps", "_c", "_deg", "_hpa", "_wm2", "_mm", "_cm", "_m", "_k", "_kg_m3", "_eur", "_hz", "_gwh_per_day", "_energy", "_system", "_adjustment", "temperature", "probability", "quantity_mw", "latitude", "longitude", "factor", "_forecast", "_capacity")
    exact = ("cost", "trend", "dtrs", "indicated_imbalance", "indicated_margin", "dtmi_lng", "value", "stats_max", "stats_min", "stats_average")
    if column in exact or column.endswith(words):
        return "double"
    return "string"


@dataclass(frozen=True)
class Dataset:
    """One silver table."""

    source: str
    name: str
    columns: tuple[str, ...] | None  # None: found in each payload
    key: tuple[str, ...] = ()
    optional_key: tuple[str, ...] = ()
    recipe: str = "json"
    clock: str = "period"  # where timestamp_utc comes from: period, a column, or date:column
    append_only: bool = False
    half_open: bool = False
    version: str = "1.0.0"
    date_column: str = "timestamp_utc"
    required: tuple[str, ...] = ()
    options: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def relation(self) -> str:
        return f"silver_{self.source}_{self.name}"


_HALF_HOUR = ("settlement_date", "settlement_period")


#: Columns of the net adjustment table, in order.
NET_ADJUSTMENTS = (
    "net_buy_price_adjustment",
    "net_sell_price_adjustment",
    "net_buy_volume_adjustment",
    "net_sell_volume_adjustment",
    "net_buy_price_cost_adjustment_energy",
    "net_buy_price_volume_adjustment_energy",
    "net_buy_price_volume_adjustment_system",
    "buy_price_price_adjustment",
    "net_sell_price_cost_adjustment_energy",
    "net_sell_price_volume_adjustment_energy",
    "net_sell_price_volume_adjustment_system",
    "sell_price_price_adjustment",
)


def _elexon() -> list[Dataset]:
    """name; own columns; further key columns; optional ones; whether published_at is kept."""
    rows = [
        ("agpt", "psr_type generation_mw business_type document_id document_revision", "psr_type", "", True),
        ("agws", "psr_type generation_mw business_type document_id document_revision", "psr_type", "", True),
        ("atl", "total_load_mw business_type document_id document_revision", "", "", True),
        ("boal", "bm_unit_id acceptance_number acceptance_time deem_flag so_flag stor_flag rr_flag bid_offer_level_from bid_offer_level_to", "bm_unit_id", "acceptance_number", False),
        ("bod", "bm_unit_id bid_offer_pair_number bid_offer_level_from bid_offer_level_to bid_price offer_price", "bm_unit_id", "bid_offer_pair_number", False),
        ("ndf", "forecast_type national_demand_mw transmission_demand_mw", "forecast_type", "published_at", True),
        ("ndfd", "forecast_type national_demand_mw transmission_demand_mw", "forecast_type", "published_at", True),
        ("disbsad", "adjustment_action_id so_flag stor_flag component cost volume", "", "adjustment_action_id component", False),
        ("fuelhh", "fuel_type generation_mw", "fuel_type", "", True),
        ("imbalngc", "indicated_imbalance", "", "", True),
        ("inddem", "indicated_demand_mw boundary", "", "boundary", True),
        ("indgen", "indicated_generation_mw boundary", "", "boundary", True),
        ("indo", "initial_demand_outturn_mw", "", "", True),
        ("itsdo", "initial_transmission_system_demand_outturn_mw", "", "", True),
        ("lolpdrm", "loss_of_load_probability derated_margin_mw", "", "", True),
        ("market_depth", "indicated_imbalance_mwh offer_volume_mwh bid_volume_mwh total_accepted_offer_volume_mwh total_accepted_bid_volume_mwh priced_accepted_offers_volume_mwh priced_accepted_bids_volume_mwh", "", "", False),
        ("melngc", "indicated_margin", "", "", True),
        ("mid", "data_provider_id market_index_price market_index_volume", "", "data_provider_id", False),
        ("nonbm", "generation_mw", "", "", True),
        ("pn", "bm_unit_id level_from level_to", "bm_unit_id", "", False),
        ("tsdf", "forecast_demand_mw boundary", "", "boundary", True),
        ("windfor", "initial_forecast_mw latest_forecast_mw", "", "published_at", True),
    ]
    out = []
    for name, own, key, optional, published in rows:
        cols = (*_HALF_HOUR, "timestamp_utc", *own.split(), *(("published_at",) if published else ()), *TAIL)
        options = {"half_hour_from": "start_time"} if name == "windfor" else {"constants": {"forecast_type": name.upper()}} if name in ("ndf", "ndfd") else {}
        out.append(Dataset("elexon", name, cols, (*_HALF_HOUR, *key.split()), tuple(optional.split()), date_column="settlement_date", required=_HALF_HOUR if name != "windfor" else (), options=options))
    half = (*_HALF_HOUR, "timestamp_utc")
    remit = "mrid revision_number timestamp_utc message_type message_heading event_type unavailability_type participant_id registration_code asset_id asset_type affected_unit affected_unit_eic bidding_zone fuel_type normal_capacity_mw available_capacity_mw unavailable_capacity_mw event_status event_start_time event_end_time cause related_information"
    soso = "contract_identification sender_identification receiver_identification resource_provider trade_direction trade_quantity_mw trade_price trader_unit start_time end_time published_at"
    out += [
        Dataset("elexon", "netbsad", (*half, *NET_ADJUSTMENTS, *TAIL), _HALF_HOUR, date_column="settlement_date", required=_HALF_HOUR),
        Dataset("elexon", "system_prices", (*half, "system_sell_price", "system_buy_price", "net_imbalance_volume", "run_type", "price_derivation_code", *TAIL), (), append_only=True, date_column="settlement_date", required=_HALF_HOUR, options={"entity": _HALF_HOUR}),
        Dataset("elexon", "remit", (*remit.split(), *TAIL), (), clock="published_at", append_only=True, version="2.0.0", required=("mrid",), options={"entity": ("mrid",)}),
        Dataset("elexon", "fou2t14d", (*half, "fuel_type", "output_usable_mw", "published_at", *TAIL), ("settlement_date", "fuel_type"), ("published_at", "settlement_period"), clock="period_or_date", append_only=True, date_column="settlement_date", required=("settlement_date", "fuel_type")),
        Dataset("elexon", "uou2t14d", (*half, "bm_unit_id", "national_grid_bm_unit", "fuel_type", "output_usable_mw", "published_at", *TAIL), ("settlement_date", "bm_unit_id"), ("settlement_period",), clock="period_or_date", date_column="settlement_date", required=("settlement_date", "bm_unit_id")),
        Dataset("elexon", "soso", (*half, *soso.split(), *TAIL), ("settlement_date", "contract_identification"), ("trade_direction",), clock="period_or_date", date_column="settlement_date", required=("settlement_date",)),
        Dataset("elexon", "indod", ("settlement_date", "timestamp_utc", "initial_demand_outturn_mw", "published_at", *TAIL), ("settlement_date",), clock="date:settlement_date", date_column="settlement_date", required=("settlement_date",)),
        Dataset("elexon", "tsdfd", ("forecast_date", "timestamp_utc", "forecast_demand_mw", "published_at", *TAIL), ("forecast_date",), clock="date:forecast_date", date_column="forecast_date", required=("forecast_date",)),
        Dataset("elexon", "freq", ("timestamp_utc", "frequency_hz", *TAIL), ("timestamp_utc",), clock="measured_at", required=("measured_at",)),
        Dataset("elexon", "fuelinst", ("timestamp_utc", "fuel_type", "generation_mw", *TAIL), ("timestamp_utc", "fuel_type"), clock="start_time", required=("start_time",)),
        Dataset("elexon", "temp", ("timestamp_utc", "measurement_date", "temperature", "normal_temperature", "low_temperature", "high_temperature", *TAIL), ("timestamp_utc",), clock="published_at", required=("published_at",)),
        Dataset("elexon", "bmunits_reference", ("bm_unit_id", "bm_unit_name", "fuel_type", "registered_capacity_mw", "company_name", "gsp_group_id", "national_grid_bm_unit", *TAIL), ("bm_unit_id",), clock="none", date_column="", required=("bm_unit_id",), options={"newest_file": True, "forbid_blank": ("bm_unit_id",)}),
    ]
    return out


def _entsoe() -> list[Dataset]:
    """name; columns between the instant and resolution; further key; flag; options."""
    zone, pair = "area_code", "in_area_code out_area_code"
    rows = [
        ("activated_balancing_prices", "area_code reserve_type direction price_eur_mwh currency", "area_code reserve_type direction", True, {}),
        ("activated_balancing_qty", "area_code reserve_type direction quantity_mwh", "area_code reserve_type direction", False, {}),
        ("actual_generation", "area_code area_name production_type generation_mw", "area_code production_type", True, {}),
        ("actual_generation_units", "area_code production_type unit_mrid unit_name generation_mw", "area_code unit_mrid", True, {}),
        ("actual_load", "area_code load_mw", zone, True, {}),
        ("contracted_reserves", "area_code reserve_type quantity_mw", "area_code reserve_type", False, {}),
        ("cross_border_flows", "in_area_code out_area_code flow_mw", pair, True, {}),
        ("day_ahead_prices", "area_code price_eur_mwh currency", zone, True, {}),
        ("forecast_margin", "area_code forecast_margin_mw", zone, False, {}),
        ("generation_forecast", "area_code production_type generation_forecast_mw", "area_code production_type", True, {}),
        ("current_balancing_state", "area_code quantity_mw business_type", "area_code business_type", False, {}),
        ("balancing_energy_bids", "area_code quantity_mw business_type bid_mrid direction original_market_product standard_market_product", "area_code bid_mrid direction", True, {}),
        ("aggregated_balancing_energy_bids", "area_code quantity_mw business_type bid_mrid direction original_market_product standard_market_product", "area_code bid_mrid direction", False, {}),
        ("procured_balancing_capacity", "area_code quantity_mw market_agreement_type business_type", "area_code market_agreement_type", True, {}),
        ("cross_zonal_balancing_capacity", "acquiring_area_code connecting_area_code quantity_mw market_agreement_type business_type", "acquiring_area_code connecting_area_code market_agreement_type", False, {}),
        ("balancing_financial_expenses_income", "area_code amount_eur business_type reason_code", "area_code business_type", False, {}),
        ("imbalance_prices", "area_code direction price_eur_mwh currency", "area_code direction", True, {"directions": "imbalance"}),
        ("imbalance_volume", "area_code direction volume_mwh", "area_code direction", True, {"directions": "imbalance"}),
        ("installed_capacity", "area_code production_type capacity_mw", "area_code production_type", False, {}),
        ("installed_capacity_units", "area_code production_type unit_mrid unit_name capacity_mw", "area_code unit_mrid", False, {}),
        ("net_transfer_capacity", "in_area_code out_area_code ntc_mw", pair, True, {}),
        ("outages_generation", "area_code unit_mrid unit_name outage_type unavailable_mw", "unit_mrid", False, {"outages": "mapped"}),
        ("outages_consumption", "area_code outage_type unavailable_mw business_type document_mrid document_status timeseries_mrid", "area_code business_type timeseries_mrid", False, {}),
        ("outages_transmission", "in_area_code out_area_code asset_mrid asset_name outage_type unavailable_mw business_type document_mrid document_status timeseries_mrid", "in_area_code out_area_code asset_mrid timeseries_mrid", False, {}),
        ("outages_offshore_grid", "area_code asset_mrid asset_name outage_type unavailable_mw business_type document_mrid document_status timeseries_mrid", "area_code asset_mrid timeseries_mrid", False, {}),
        ("outages_production", "area_code unit_mrid unit_name production_type outage_type unavailable_mw business_type document_mrid document_status timeseries_mrid", "area_code unit_mrid timeseries_mrid", False, {}),
        ("water_reservoirs", "area_code reservoir_mwh", zone, False, {}),
        ("wind_solar_forecast", "area_code production_type generation_forecast_mw", "area_code production_type", True, {}),
    ]
    made = []
    for name, own, key, flag, options in rows:
        made.append(Dataset("entsoe", name, ("timestamp_utc", *own.split(), "resolution", "published_at", *TAIL), ("timestamp_utc", *key.split()), recipe="xml", half_open=flag, options=options))
    pairs = "dc_link_intraday_transfer_limits commercial_schedules redispatching_cross_border redispatching_internal countertrading offered_transfer_capacity_continuous offered_transfer_capacity_implicit offered_transfer_capacity_explicit transfer_capacity_use total_nominated_capacity total_capacity_allocated net_positions"
    for measure, names, flag in (("quantity_mw", pairs, True), ("amount_eur", "congestion_management_costs auction_revenue congestion_income", False)):
        cols = ("timestamp_utc", *pair.split(), measure, "business_type", "resolution", "published_at", *TAIL)
        made += [Dataset("entsoe", n, cols, ("timestamp_utc", *pair.split(), "business_type"), recipe="xml", half_open=flag) for n in names.split()]
    for n, horizon in (("load_forecast", "day_ahead"), ("load_forecast_weekly", "week_ahead"), ("load_forecast_monthly", "month_ahead"), ("load_forecast_yearly", "year_ahead")):
        cols = ("timestamp_utc", "area_code", "load_forecast_mw", "resolution", "forecast_horizon", "published_at", *TAIL)
        made.append(Dataset("entsoe", n, cols, ("timestamp_utc", "area_code"), recipe="xml", half_open=n == "load_forecast", options={"constants": {"forecast_horizon": horizon}}))
    cols = ("area_code", "unit_mrid", "unit_name", "production_type", "implementation_datetime_utc", *TAIL)
    made.append(Dataset("entsoe", "generation_units_master_data", cols, ("area_code", "unit_mrid"), recipe="xml_units", clock="none", date_column=""))
    return made


def _gas() -> list[Dataset]:
    flow = ("timestamp_utc", "point_key", "point_label", "operator_key", "operator_label", "direction_key", "flow_gwh_per_day", "unit", *TAIL)
    out = [Dataset("entsog", "physical_flows", flow, ("timestamp_utc", "point_key"), ("operator_key", "direction_key"), recipe="flows", options={"record_key": "operationalData"})]
    indicators = "nominations allocations renominations firm_available firm_booked firm_technical interruptible_available interruptible_booked interruptible_total gcv wobbe_index methane_content hydrogen_content oxygen_content available_through_oversubscription available_through_surrender available_through_uioli_long_term available_through_uioli_short_term"
    families = {n: "operationalData" for n in indicators.split()} | {
        "cmp_unsuccessful_requests": "cmpUnsuccessfulRequests", "cmp_unavailable_firm_capacity": "cmpUnavailables", "cmp_auction_premiums": "cmpAuctions", "interruptions": "interruptions",
        "aggregated_physical_flows": "aggregatedData", "tariffs": "tariffsFulls", "tariff_simulations": "tariffsSimulations", "urgent_market_messages": "urgentMarketMessages",
        "connection_points": "connectionPoints", "operators": "operators", "balancing_zones": "balancingZones", "operator_point_directions": "operatorPointDirections",
        "interconnections": "interconnections", "aggregate_interconnections": "aggregateInterconnections",
    }
    out += [Dataset("entsog", n, None, recipe="dynamic", options={"record_key": k, "windowed": n not in ("tariffs", "tariff_simulations")}) for n, k in families.items()]
    storage = "gas_day gas_day_end updated_at entity_level entity_code entity_name entity_url country_code country_name gas_in_storage_gwh consumption_gwh consumption_full_pct injection_gwh withdrawal_gwh net_withdrawal_gwh working_gas_volume_gwh injection_capacity_gwh_per_day withdrawal_capacity_gwh_per_day contracted_capacity_gwh_per_day available_capacity_gwh_per_day covered_capacity_gwh_per_day storage_pct_full trend status info"
    key = ("gas_day", "entity_level", "entity_code", "entity_url")
    out += [Dataset("gie_agsi", n, (*storage.split(), *TAIL), key, recipe="storage", clock="gas:gas_day", version="2.0.0", date_column="gas_day") for n in ("storage", "storage_reports")]
    out += [Dataset("gie_agsi", n, None, recipe="dynamic", options={"record_key": "data", "dedup": ("id", "url", "turl", "entity_code", "eic"), "blanks_yield": True}) for n in ("about_summary", "about_listing", "news", "news_item", "unavailability")]
    lng = "gas_day country_code country_name lng_in_storage_gwh send_out_gwh injection_gwh lng_pct_full dtrs dtmi_lng dtmi_gwh trend"
    out.append(Dataset("gie_alsi", "lng", (*lng.split(), *TAIL), ("gas_day", "country_code"), recipe="lng", clock="gas:gas_day", version="2.0.0", date_column="gas_day"))
    return out


def _carbon() -> list[Dataset]:
    intensity = ("timestamp_utc", "period_end_utc", "forecast_gco2_kwh", "actual_gco2_kwh", "intensity_index", *TAIL)
    stats = ("timestamp_utc", "period_end_utc", "stats_max", "stats_average", "stats_min", "intensity_index", *TAIL)
    regional = ("timestamp_utc", "period_end_utc", "regionid", "shortname", "dnoregion", "postcode", "forecast_gco2_kwh", "intensity_index", "fuel", "generation_pct", *TAIL)
    windows = ("fw24h", "fw48h", "pt24h")
    names = {
        "intensity": (["intensity_current", "intensity_today", "intensity_date", "intensity_period", "intensity_at", *[f"intensity_{w}" for w in windows], "carbon_intensity"], intensity, ("timestamp_utc",)),
        "factors": (["intensity_factors"], ("fuel", "factor_gco2_kwh", *TAIL), ("fuel",)),
        "stats": (["intensity_stats", "intensity_stats_block"], stats, ("timestamp_utc", "period_end_utc")),
        "generation": (["generation_current", "generation_pt24h", "generation"], ("timestamp_utc", "period_end_utc", "fuel", "generation_pct", *TAIL), ("timestamp_utc", "fuel")),
        "regional": (
            [*[f"regional_{x}" for x in ("current", "england", "scotland", "wales", "postcode", "regionid")], *[f"regional_intensity_{w}{by}" for w in windows for by in ("", "_postcode", "_regionid")], *[f"regional_intensity{by}" for by in ("", "_postcode", "_regionid")]],
            regional,
            ("timestamp_utc", "regionid", "shortname", "postcode", "fuel"),
        ),
    }
    return [Dataset("neso", n, cols, key, recipe=f"carbon_{family}", clock="none" if family == "factors" else "timestamp_utc", date_column="" if family == "factors" else "timestamp_utc") for family, (ns, cols, key) in names.items() for n in ns]


FUELS = ("gas", "coal", "nuclear", "wind", "wind_emb", "hydro", "imports", "biomass", "other", "solar", "storage", "generation", "carbon_intensity", "low_carbon", "zero_carbon", "renewable", "fossil")


def _portal() -> list[Dataset]:
    one = {"append_only": True}
    shares = tuple(f"{f}_pct" for f in FUELS if f != "carbon_intensity")
    embedded = ("embedded_wind_forecast", "embedded_wind_capacity", "embedded_solar_forecast", "embedded_solar_capacity")
    return [
        Dataset("neso_data_portal", "daily_wind_availability", ("bmu_id", "availability_date", "availability_mw", "timestamp_utc", "published_at", "data_provider"), ("bmu_id", "availability_date", "published_at"), recipe="csv_wind", date_column="availability_date", **one),
        Dataset("neso_data_portal", "embedded_wind_solar_forecast", (*_HALF_HOUR, "issue_time", "time_gmt_raw", *embedded, "published_at", "data_provider"), (*_HALF_HOUR, "issue_time"), recipe="csv_embedded", date_column="settlement_date", **one),
        Dataset("neso_data_portal", "historic_generation_mix", ("timestamp_utc", *FUELS, *shares, "published_at", "data_provider"), ("timestamp_utc", "published_at"), recipe="csv_mix", **one),
    ]


#: Weather variables and their columns; speeds come in km/h.
WEATHER = {
    "temperature_2m": "temperature_2m_c", "dew_point_2m": "dew_point_2m_c", "surface_pressure": "surface_pressure_hpa", "relative_humidity_2m": "relative_humidity_2m_pct",
    "cloud_cover": "cloud_cover_pct", "cloud_cover_low": "cloud_cover_low_pct", "cloud_cover_mid": "cloud_cover_mid_pct", "cloud_cover_high": "cloud_cover_high_pct",
    "shortwave_radiation": "shortwave_radiation_wm2", "direct_radiation": "direct_radiation_wm2", "direct_normal_irradiance": "direct_normal_irradiance_wm2", "diffuse_radiation": "diffuse_radiation_wm2", "global_tilted_irradiance": "global_tilted_irradiance_wm2",
    "precipitation": "precipitation_mm", "snowfall": "snowfall_cm", "snow_depth": "snow_depth_m",
    "wind_direction_10m": "wind_direction_10m_deg", "wind_direction_80m": "wind_direction_80m_deg", "wind_direction_100m": "wind_direction_100m_deg", "wind_direction_120m": "wind_direction_120m_deg", "wind_direction_180m": "wind_direction_180m_deg",
    "wind_speed_10m": "wind_speed_10m_mps", "wind_speed_80m": "wind_speed_80m_mps", "wind_speed_100m": "wind_speed_100m_mps", "wind_speed_120m": "wind_speed_120m_mps", "wind_speed_180m": "wind_speed_180m_mps", "wind_gusts_10m": "wind_gusts_10m_mps",
}


def _weather() -> list[Dataset]:
    clouds = "cloud_cover cloud_cover_low cloud_cover_mid cloud_cover_high"
    variables = {
        "demand": "temperature_2m wind_speed_10m wind_direction_10m relative_humidity_2m precipitation shortwave_radiation surface_pressure snowfall snow_depth",
        "wind": f"temperature_2m surface_pressure wind_speed_10m wind_speed_100m wind_direction_10m wind_direction_100m wind_gusts_10m {clouds} dew_point_2m precipitation",
        "solar": f"temperature_2m shortwave_radiation direct_radiation direct_normal_irradiance diffuse_radiation global_tilted_irradiance {clouds} snowfall snow_depth",
    }
    derived = {"demand": ("hdd_k", "cdd_k", "air_density_kg_m3"), "wind": ("air_density_kg_m3",), "solar": ()}
    out = []
    for when in ("forecast", "historical"):
        for role, names in variables.items():
            found = tuple(names.split())
            if (when, role) == ("forecast", "wind"):
                found += tuple(f"wind_{what}_{h}m" for what in ("speed", "direction") for h in (80, 120, 180))
            cols = ("timestamp_utc", "location", "latitude", "longitude", *[WEATHER[v] for v in found], *derived[role], *TAIL)
            out.append(Dataset("open_meteo", f"{when}_{role}", cols, ("timestamp_utc", "location"), recipe="weather", clock="timestamp_utc", version="2.0.0", options={"variables": found}))
    return out


DATASETS: dict[tuple[str, str], Dataset] = {(d.source, d.name): d for d in (*_elexon(), *_entsoe(), *_gas(), *_carbon(), *_portal(), *_weather())}


def dataset(source: str, name: str) -> Dataset:
    try:
        return DATASETS[source, name]
    except KeyError:
        raise KeyError(f"no dataset {source}/{name}") from None


def register(d: Dataset) -> None:
    """Add a dataset; the extension point for further sources."""
    if (d.source, d.name) in DATASETS:
        raise ValueError(f"{d.source}/{d.name} is registered")
    DATASETS[d.source, d.name] = d
