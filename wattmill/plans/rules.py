"""Fail-soft validation: what a row of a dataset should satisfy. Broken rows are counted and kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from .registry import Dataset

#: Closed ranges by column, and by dataset where they differ.
RANGES = {
    "settlement_period": (1, 50),
    "system_sell_price": (-500, 10_000),
    "system_buy_price": (-500, 10_000),
    "frequency_hz": (49.0, 51.0),
    "loss_of_load_probability": (0.0, 1.0),
    "storage_pct_full": (0, 100),
    "lng_pct_full": (0, 100),
}
PATTERNS = {"run_type": r"^(II|SF|R[1-3]|RF|DF)$"}
#: Columns that may be null although they are part of a key.
OPTIONAL_KEYS = ("published_at", "settlement_period", "acceptance_number", "bid_offer_pair_number", "adjustment_action_id", "component", "boundary", "data_provider_id", "entity_url", "fuel", "postcode", "trade_direction")


def rules(d: Dataset) -> dict[str, Column]:
    """Rules of a dataset by name: keys are there, values lie in range or match a pattern (null passes)."""
    out: dict[str, Column] = {}
    for c in d.columns or ():
        if c in d.key and c not in OPTIONAL_KEYS or c == "timestamp_utc" and d.clock != "none":
            out[f"{c}_present"] = F.col(c).isNotNull()
        if c in RANGES:
            out[f"{c}_in_range"] = F.coalesce(F.col(c).between(*RANGES[c]), F.col(c).isNull())
        if c in PATTERNS:
            out[f"{c}_known"] = F.coalesce(F.col(c).rlike(PATTERNS[c]), F.lit(True))
    return out


def validate(df: DataFrame, d: Dataset) -> DataFrame:
    """(n_rows, and how many rows break each rule), in one pass."""
    return quality.rule_counts(df, {n: r for n, r in rules(d).items() if n.removesuffix("_present").removesuffix("_in_range").removesuffix("_known") in df.columns})
