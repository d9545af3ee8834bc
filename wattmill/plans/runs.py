"""Run log, quality reports and what becomes of a run."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state
from ..sources import tables

LOG = "run_id string, source string, dataset string, status string, rows long, started_at timestamp, finished_at timestamp, at timestamp, message string"


def status(written: int, dropped_all: bool, all_unvouched: bool, excluded: int, warnings: int, failed: bool = False) -> str:
    """failed over completed_with_warnings over success."""
    if failed or dropped_all or all_unvouched or (excluded and not written):
        return "failed"
    return "completed_with_warnings" if warnings or excluded else "success"


class RunLog:
    """An append-only table of events; the last event of a run is its state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _add(self, run_id: str, source: str, dataset: str, state_: str, rows: int | None, started: datetime, finished: datetime | None, message: str) -> None:
        now = datetime.now(timezone.utc)
        self.spark.createDataFrame([(run_id, source, dataset, state_, rows, started, finished, now, message)], LOG).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, source: str, dataset: str) -> tuple[str, datetime]:
        run_id, now = uuid.uuid4().hex, datetime.now(timezone.utc)
        self._add(run_id, source, dataset, "running", None, now, None, "")
        return run_id, now

    def finish(self, run_id: str, source: str, dataset: str, started: datetime, result: str, rows: int, message: str = "") -> None:
        self._add(run_id, source, dataset, result, rows, started, datetime.now(timezone.utc), message)

    def current(self) -> DataFrame:
        events = tables.read_path(self.spark, self.path, self.spark.createDataFrame([], LOG).schema)
        newest = F.max_by(F.struct(*[c for c in events.columns if c != "run_id"]), "at")
        return events.groupBy("run_id").agg(newest.alias("e")).select("run_id", "e.*")

    def recent(self, limit: int = 20) -> DataFrame:
        return state.recent_runs(self.current(), F.current_timestamp(), limit)


def write_report(report: DataFrame, path: str, run_id: str) -> None:
    """Append a quality report under a run, with the place of each line."""
    from pyspark.sql import Window as W

    order = W.partitionBy("run_id").orderBy("dataset", "check_name", "subject")  # a few lines a dataset
    out = report.withColumns({"run_id": F.lit(run_id), "reported_at": F.current_timestamp()}).withColumn("ordinal", F.row_number().over(order) - 1)
    out.write.mode("append").parquet(path)


def normalise_published_at(df: DataFrame, columns: list[str]) -> DataFrame:
    """Older files brought to the canonical columns: a missing published_at is a typed null; strays raise."""
    stray = [c for c in df.columns if c not in columns]
    missing = [c for c in columns if c not in df.columns and c != "published_at"]
    if stray or missing:
        raise ValueError(f"columns drifted: stray {stray}, missing {missing}")
    if "published_at" not in df.columns:
        df = df.withColumn("published_at", F.lit(None).cast("timestamp"))
    return df.select(*columns)
