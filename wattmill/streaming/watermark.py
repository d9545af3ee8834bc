"""Watermarks on disk: read, raise and compare-and-set, safe against several writers."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ..operators.state import Snapshot


class WatermarkTable:
    """High-water marks by (source, dataset): one small file a version, the highest version counts.

    A version's file is created without overwriting, so of two writers that saw the same version one
    fails. That needs a file system whose create is exclusive (HDFS, local; object stores with
    conditional writes).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = spark._jvm.org.apache.hadoop.fs
        self.files = self.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, source: str, dataset: str, version: int):
        return self.fs.Path(f"{self.path}/{source}/{dataset}/{version:012d}.json")

    def _highest(self, source: str, dataset: str) -> int:
        found = self.files.globStatus(self.fs.Path(f"{self.path}/{source}/{dataset}/*.json")) or []
        return max((int(x.getPath().getName().removesuffix(".json")) for x in found), default=0)

    def read(self, source: str, dataset: str) -> Snapshot:
        """present, absent, or unreadable; never raises."""
        try:
            version = self._highest(source, dataset)
            if not version:
                return Snapshot("absent")
            stream = self.files.open(self._file(source, dataset, version))
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            at = datetime.fromisoformat(json.loads(text)["last_end"])
            return Snapshot("present", at, version)
        except Exception:
            return Snapshot("unreadable")

    def _create(self, source: str, dataset: str, version: int, end: datetime) -> bool:
        """Whether this writer made the version."""
        try:
            out = self.files.create(self._file(source, dataset, version), False)
        except Exception as e:
            if "exist" in str(e).lower():
                return False
            raise
        out.write(json.dumps({"last_end": end.isoformat(), "written_at": datetime.now(timezone.utc).isoformat()}).encode())
        out.close()
        return True

    def raise_to(self, source: str, dataset: str, end: datetime) -> str:
        """ADVANCED, NO_OP (never back) or WRITE_FAILED; tries again where another writer came first."""
        while True:
            now = self.read(source, dataset)
            if now.status == "unreadable":
                return "WRITE_FAILED"
            if now.status == "present" and now.value >= end:
                return "NO_OP"
            if self._create(source, dataset, now.version + 1, end):
                return "ADVANCED"

    def compare_and_set(self, source: str, dataset: str, seen: Snapshot, end: datetime) -> str:
        """ADVANCED only if the mark is still what was seen; else CAS_MISMATCH, and nothing is written."""
        now = self.read(source, dataset)
        if now.status == "unreadable":
            return "WRITE_FAILED"
        if now != seen:
            return "CAS_MISMATCH"
        if now.status == "present" and now.value >= end:
            return "NO_OP"
        return "ADVANCED" if self._create(source, dataset, seen.version + 1, end) else "CAS_MISMATCH"
