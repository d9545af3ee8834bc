"""The catalogue of relations as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.bitemporal import RESERVED
from ..operators.vintage import LATEST_SPECS
from .gold import CONTEXT_COLUMNS, STORAGE_COLUMNS
from .registry import DATASETS, column_type

GOLD = {"gold_eu_gas_storage": STORAGE_COLUMNS, "gold_uk_imbalance_context": CONTEXT_COLUMNS, "gold_system_marginal_price": None}
PARTITIONS = ("year", "month", "vintage")
HIDDEN = (*RESERVED, *PARTITIONS)


def relations(aliases: bool = False) -> list[tuple]:
    """(relation, kind, source, dataset, date column, columns, origin) of every base, latest, alias and gold relation, in order."""
    out, owners = [], {}
    for (source, name), d in sorted(DATASETS.items()):
        columns = None if d.columns is None else [*d.columns, *RESERVED]
        origin = "declared_dynamic" if d.columns is None else "declared"
        out.append((d.relation, "silver", source, name, d.date_column or None, columns, origin))
        if (source, name) in LATEST_SPECS:
            out.append((f"{d.relation}_latest", "silver_latest", source, name, d.date_column or None, columns, origin))
        elif d.append_only:
            raise ValueError(f"{source}/{name} is append-only and has no rule for its latest rows")
        owners.setdefault(name, []).append((source, d, columns, origin))
    if aliases:
        taken = {r[0] for r in out}
        for name, own in sorted(owners.items()):
            if len(own) == 1 and f"silver_{name}" not in taken:
                source, d, columns, origin = own[0]
                out.append((f"silver_{name}", "alias", source, name, d.date_column or None, columns, origin))
    out += [(n, "gold", None, None, None, list(c) if c else None, "declared" if c else "declared_dynamic") for n, c in sorted(GOLD.items())]
    return out


def manifest_frame(spark: SparkSession, aliases: bool = False) -> DataFrame:
    schema = "relation string, kind string, source string, dataset string, date_column string, columns array<string>, origin string"
    return spark.createDataFrame(relations(aliases), schema)


def ddl(source: str, name: str) -> str | None:
    """A dataset's columns as a Spark schema, or None if they are found in each payload."""
    d = DATASETS[source, name]
    return None if d.columns is None else ", ".join(f"{c} {column_type(c)}" for c in d.columns)


def date_column(relation: str) -> str:
    for name, _, _, _, column, _, _ in relations(True):
        if name == relation and column:
            return column
    raise KeyError(f"no date column is registered for {relation}")
