"""Which row of a key survives: keep-last dedup and latest vintages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import literal_map

#: Settlement runs, in the order in which they replace one another.
RUN_RANK = {"II": 1, "SF": 2, "R1": 3, "R2": 4, "R3": 5, "RF": 6, "DF": 7}


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in `order`. Null keys are equal. Rank limits are pushed below the shuffle by Catalyst."""
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rn = 1").drop("_rn")


def dedup_keep_last(df: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    """The last row of each key in input order, which `ordinal` (file, then place in it) spells out."""
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in ordinal])


def dedup_whole_rows(df: DataFrame, ordinal: list[str], ignore: tuple[str, ...] = ("timestamp_utc",)) -> DataFrame:
    """By `id` if there is one, else over all columns but `ignore` and the ordinal; the last row stays."""
    keys = ["id"] if "id" in df.columns else [c for c in df.columns if c not in (*ignore, *ordinal)]
    return dedup_keep_last(df, keys, ordinal)


def dedup_signal(df: DataFrame, signal: list[str], ordinal: list[str]) -> DataFrame:
    """The first row of those that agree in all signal columns; what else it holds is the survivor's own."""
    return first_by(df, signal, [F.col(c).asc_nulls_first() for c in ordinal])


@dataclass(frozen=True)
class LatestSpec:
    """How the current row of a dataset is chosen among its vintages."""

    keys: tuple[str, ...]
    order: tuple[str, ...] = ("available_at",)
    optional_keys: tuple[str, ...] = ()
    rank_column: str | None = None
    rank: tuple[tuple[str, int], ...] = ()

    def resolve(self, columns: list[str]) -> tuple[list[str], list[str], str | None] | None:
        """(keys, order, rank column) that exist, or None where nothing can be chosen."""
        if any(k not in columns for k in self.keys):
            return None
        keys = [*self.keys, *[k for k in self.optional_keys if k in columns]]
        order = [c for c in self.order if c in columns]
        rank = self.rank_column if self.rank_column in columns else None
        return (keys, order, rank) if order or rank else None


LATEST_SPECS: dict[tuple[str, str], LatestSpec] = {
    ("elexon", "system_prices"): LatestSpec(("settlement_date", "settlement_period"), rank_column="run_type", rank=tuple(RUN_RANK.items())),
    ("elexon", "remit"): LatestSpec(("mrid",), ("available_at", "revision_number")),
    ("elexon", "fou2t14d"): LatestSpec(("settlement_date", "fuel_type"), optional_keys=("settlement_period",)),
    ("neso_data_portal", "daily_wind_availability"): LatestSpec(("bmu_id", "availability_date")),
    ("neso_data_portal", "historic_generation_mix"): LatestSpec(("timestamp_utc",)),
    ("neso_data_portal", "embedded_wind_solar_forecast"): LatestSpec(("settlement_date", "settlement_period")),
}


def rank_of(column: Column, rank: dict[str, int]) -> Column:
    return F.coalesce(F.try_element_at(literal_map(rank), column), F.lit(0))


def total_order(df: DataFrame, spec: LatestSpec) -> tuple[str, ...]:
    """The columns that a spec leaves open, by name: with them as tie-break a rerun over the same rows picks the same ones."""
    used = {*spec.keys, *spec.optional_keys, *spec.order, "ingested_at"}
    return tuple(sorted(f.name for f in df.schema if f.name not in used and not f.dataType.simpleString().startswith("map")))


def latest_by(df: DataFrame, spec: LatestSpec, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The current vintage of each key; `df` itself where the spec can't be resolved. `tie_break` columns go last, descending."""
    found = spec.resolve(df.columns)
    if found is None:
        return df
    keys, order, rank = found
    by = [F.col(c).desc_nulls_last() for c in order]
    if rank:
        by.append(rank_of(F.col(rank), dict(spec.rank)).desc())
    return first_by(df, keys, by + [F.col(c).desc_nulls_last() for c in tie_break])


def point_in_time(df: DataFrame, spec: LatestSpec, as_of: Column, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """What was believed at an instant: vintages available by then, then the latest."""
    return latest_by(df.filter(F.col("available_at") <= as_of), spec, tie_break)
