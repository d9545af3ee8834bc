"""Views over the lake, and a client that answers from them."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.vintage import LATEST_SPECS, latest_by, total_order
from ..sources import tables
from . import gold
from .manifest import HIDDEN
from .registry import DATASETS


def landed(spark: SparkSession, silver: str) -> set[tuple[str, str]]:
    """(source, dataset) of the folders there are, from one listing."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{silver}/*/*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return {tuple(x.getPath().toString().split("/")[-2:]) for x in found if x.isDirectory()}


def register_views(spark: SparkSession, silver: str, strict: bool = True) -> list[str]:
    """Base, latest, alias and gold views for the datasets that have files; absent ones are passed over. Returns the names, in order.

    A view that fails for another reason than missing data raises, or is passed over if not `strict`.
    """
    made, owners = [], {}

    def view(name: str, df: DataFrame) -> None:
        try:
            df.createOrReplaceTempView(name)
        except AnalysisException as e:
            if strict and not benign(e):
                raise
            return
        made.append(name)

    there = landed(spark, silver)
    for (source, name), d in sorted(DATASETS.items()):
        df = tables.read_path(spark, f"{silver}/{source}/{name}") if (source, name) in there else None
        if df is None or not df.columns:
            continue
        view(d.relation, df)
        owners.setdefault(name, []).append(d)
        spec = LATEST_SPECS.get((source, name))
        if spec and spec.resolve(df.columns):
            view(f"{d.relation}_latest", latest_by(df, spec, total_order(df, spec)))
    for name, own in sorted(owners.items()):
        if len(own) == 1 and f"silver_{name}" not in made:
            view(f"silver_{name}", spark.table(own[0].relation))
    if "silver_gie_agsi_storage" in made:
        view("gold_eu_gas_storage", gold.gas_storage(spark.table("silver_gie_agsi_storage")))
    if {"silver_elexon_system_prices", "silver_neso_carbon_intensity"} <= set(made):
        view("gold_uk_imbalance_context", gold.imbalance_context(spark.table("silver_elexon_system_prices"), spark.table("silver_neso_carbon_intensity")))
    return made


_QUOTED = re.compile(r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/)""", re.S)


def spark_dialect(sql: str) -> str:
    """`* EXCLUDE (a)` as `* EXCEPT (a)` and read_parquet('glob') as a path; text in quotes and comments stays."""
    sql = re.sub(r"(?i)\bread_parquet\s*\(\s*'([^'`]*)'\s*\)", r"parquet.`\1`", sql)
    parts = _QUOTED.split(sql)
    if any(re.search(r"(?i)\bqualify\b", p) for p in parts[::2]):
        raise ValueError("QUALIFY isn't part of Spark's SQL: filter row_number() in an outer SELECT")
    parts[::2] = [re.sub(r"(?i)\*\s*exclude\s*\(", "* EXCEPT (", p) for p in parts[::2]]
    return "".join(parts)


def reads_only(spark: SparkSession, sql: str) -> bool:
    """Whether the session's parser finds a query and nothing that writes, defines or configures anywhere in it."""
    kind = spark._jvm.java.lang.Class.forName
    writes = [kind(f"org.apache.spark.sql.catalyst.plans.logical.{n}") for n in ("Command", "ParsedStatement")]
    todo = [spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)]
    while todo:
        plan = todo.pop()
        if any(w.isInstance(plan) for w in writes):
            return False
        for below in (plan.children(), plan.innerChildren()):
            items = [below.apply(i) for i in range(below.size())]
            todo += [x for x in items if x.getClass().getName().startswith("org.apache.spark.sql.catalyst.plans.logical")]
    return True


def relation_for(names: list[str], source: str, name: str) -> str | None:
    """The view to read for a dataset: its latest vintages if there are any, else all."""
    base = f"silver_{source}_{name}"
    return next((n for n in (f"{base}_latest", base) if n in names), None)


#: Columns that can stand for a row's time, in order.
TIME_COLUMNS = ("timestamp_utc", "settlement_date", "gas_day", "date", "event_time")


def time_column(columns: list[str]) -> str | None:
    return next((c for c in TIME_COLUMNS if c in columns), None)


class Client:
    """Read-only answers from the views; use as a context manager."""

    def __init__(self, spark: SparkSession, silver: str):
        self.spark, self.silver, self.closed = spark, silver, False
        self.names = register_views(spark, silver)

    def _open(self) -> None:
        if self.closed:
            raise RuntimeError("the client is closed")

    def __enter__(self) -> Client:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.closed = True

    def reopen(self) -> Client:
        return Client(self.spark, self.silver)

    def query(self, sql: str, **args) -> DataFrame:
        """A single query, with named parameters. `* EXCLUDE` and `read_parquet('...')` are understood; QUALIFY isn't part of Spark's SQL."""
        self._open()
        sql = spark_dialect(sql)
        if not reads_only(self.spark, sql):
            raise ValueError("only SELECT is served")
        return self.spark.sql(sql, args=args or None)

    def tables(self) -> list[str]:
        self._open()
        return sorted(self.names)

    def _range(self, view: str, column: str, start: date, end: date, keep: tuple[str, ...] = (), **equal: str | None) -> DataFrame:
        self._open()
        if view not in self.names:
            raise LookupError(f"{view} has no data")
        df = tables.in_date_range(self.spark.table(view), column, start, end)
        for c, value in equal.items():
            if value is not None:
                df = df.filter(F.col(c) == value)
        return df.drop(*[c for c in (*HIDDEN, "partition_date") if c not in keep])

    def system_prices(self, start: date, end: date) -> DataFrame:
        return self._range("silver_elexon_system_prices_latest", "settlement_date", start, end, ("available_at",)).orderBy("settlement_date", "settlement_period")

    def fuel_generation(self, start: date, end: date) -> DataFrame:
        return self._range("silver_elexon_fuelhh", "settlement_date", start, end).orderBy("settlement_date", "settlement_period", "fuel_type")

    def generation_by_fuel(self, start: date, end: date) -> DataFrame:
        """The older form, of three columns."""
        return self.fuel_generation(start, end).select("timestamp_utc", "fuel_type", "generation_mw")

    def gas_storage(self, start: date, end: date, country_code: str | None = None) -> DataFrame:
        return self._range("gold_eu_gas_storage", "gas_day", start, end, country_code=country_code).orderBy("gas_day", "country_code")

    def weather(self, start: date, end: date, location: str | None = None, dataset: str = "historical_demand") -> DataFrame:
        return self._range(f"silver_open_meteo_{dataset}", "timestamp_utc", start, end, location=location).orderBy("timestamp_utc", "location")

    def imbalance_context(self, start: date, end: date) -> DataFrame:
        return self._range("gold_uk_imbalance_context", "settlement_date", start, end, ("available_at",)).orderBy("timestamp_utc", "price_derivation_code")


def quality_sweep(spark: SparkSession, silver: str) -> DataFrame:
    """The checks of all datasets with files, on their current vintages."""
    from ..operators import quality

    parts, there = [], landed(spark, silver)
    for (source, name), d in sorted(DATASETS.items()):
        df = tables.read_path(spark, f"{silver}/{source}/{name}") if (source, name) in there else None
        if df is None or not df.columns:
            continue
        spec = LATEST_SPECS.get((source, name))
        df = latest_by(df, spec, total_order(df, spec)) if spec else df
        keys = [k for k in (*(d.key or d.options.get("entity", ())), *d.optional_key) if k in df.columns]
        parts.append(quality.report(df, d.relation, keys or None, "timestamp_utc" if "timestamp_utc" in df.columns else None))
    if not parts:
        return spark.createDataFrame([], "dataset string, check_name string, subject string, value double, passed boolean")
    return tables.union_all(parts)


def benign(error: Exception) -> bool:
    """Whether a failure to make a view only says that there is no data yet."""
    return isinstance(error, AnalysisException) and error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
