"""Derived datasets over silver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import iso_weekday
from ..operators.vintage import LATEST_SPECS, latest_by, total_order
from ..sources import tables

#: Columns of the storage view, in order.
STORAGE_COLUMNS = ("gas_day", "country_code", "country_name", "gas_in_storage_gwh", "withdrawal_gwh", "injection_gwh", "working_gas_volume_gwh", "storage_pct_full", "trend", "data_provider", "ingested_at")
CONTEXT_COLUMNS = ("timestamp_utc", "settlement_date", "settlement_period", "system_sell_price", "system_buy_price", "net_imbalance_volume", "price_derivation_code", "available_at", "carbon_intensity_forecast_gco2_kwh", "carbon_intensity_actual_gco2_kwh", "intensity_index")
COLUMN_COMMENTS = {
    "carbon_intensity_actual_gco2_kwh": "realised after the period: not known at delivery, no feature for the same period",
    "available_at": "of the winning price vintage; a filter on it cuts off, it doesn't select earlier vintages",
}


def spread_features(df: DataFrame) -> DataFrame:
    """Price spread, size of the imbalance, hour and ISO weekday."""
    out = df.withColumns({"spread": F.col("system_buy_price") - F.col("system_sell_price"), "abs_imbalance": F.abs("net_imbalance_volume")})
    if "timestamp_utc" in df.columns:
        out = out.withColumns({"hour_of_day": F.hour("timestamp_utc"), "day_of_week": iso_weekday(F.col("timestamp_utc"))})
    return out


def with_context(rows: DataFrame, context: DataFrame, key: str) -> DataFrame:
    """Left join to a context that has each key once."""
    return rows.join(context, key, "left")


def current_prices(prices: DataFrame) -> DataFrame:
    """The latest vintage of each period; where time and run tie, all other columns decide, so reruns agree."""
    spec = LATEST_SPECS[("elexon", "system_prices")]
    return latest_by(prices, spec, total_order(prices, spec))


def system_marginal_price(spark: SparkSession, silver: str, start: date, end: date) -> DataFrame:
    """The current price of each period with its features, by time."""
    rows = tables.read_range(spark, f"{silver}/elexon/system_prices", start, end)
    latest = current_prices(rows)
    return spread_features(latest).orderBy("timestamp_utc")


def imbalance_context(prices: DataFrame, carbon: DataFrame) -> DataFrame:
    """Current prices beside forecast and realised carbon intensity."""
    side = carbon.select(
        "timestamp_utc",
        F.col("forecast_gco2_kwh").alias("carbon_intensity_forecast_gco2_kwh"),
        F.col("actual_gco2_kwh").alias("carbon_intensity_actual_gco2_kwh"),
        "intensity_index",
    )
    out = with_context(current_prices(prices), side, "timestamp_utc")
    cols = [F.col(c).alias(c, metadata={"comment": COLUMN_COMMENTS[c]}) if c in COLUMN_COMMENTS else F.col(c) for c in CONTEXT_COLUMNS]
    return out.select(*cols).orderBy("timestamp_utc", "price_derivation_code")


def gas_storage(storage: DataFrame) -> DataFrame:
    return storage.select(*STORAGE_COLUMNS).orderBy(F.desc("gas_day"), "country_code")
