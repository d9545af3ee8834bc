"""The landing zone: raw bodies, their sidecars, and which of them vouch for one another."""

from __future__ import annotations

import json
import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import safe_instant

SIDECAR = (
    "source string, dataset string, fetched_at string, written_at string, available_at string, response_received_at string, data_date string, request_url string, "
    "request_params map<string,string>, api_version string, http_status int, content_type string, body_sha256 string, body_size_bytes long, page int, total_pages int"
)
#: Sidecar stamps, in order of preference; one that can't be read yields to the next.
STAMP_KEYS = ("available_at", "written_at", "response_received_at", "fetched_at")
COVER_DAYS = 35
_PATH = r"/([^/]+)/([^/]+)/(\d{4})/(\d{2})/(\d{2})/([^/]+?)(\.meta\.json|\.[^./]+)$"


def list_files(spark: SparkSession, root: str, source: str = "*", dataset: str = "*", day: date | None = None, suffix: str = "*") -> DataFrame:
    """path, modified_at, content and the parts of `<source>/<dataset>/YYYY/MM/DD/<stem>.<ext>`.

    `content` is read only where a plan uses it.
    """
    where = day.strftime("%Y/%m/%d") if day else "*/*/*"
    files = spark.read.format("binaryFile").option("pathGlobFilter", suffix).load(f"{root}/{source}/{dataset}/{where}")
    part = lambda i: F.regexp_extract("path", _PATH, i)
    return files.select(
        "path", F.col("modificationTime").alias("modified_at"), "length", "content", part(1).alias("source"), part(2).alias("dataset"),
        F.try_to_timestamp(F.concat_ws("-", part(3), part(4), part(5)), F.lit("yyyy-MM-dd")).cast("date").alias("day"), part(6).alias("stem"), part(7).alias("ext"),
    )


def days(spark: SparkSession, root: str, source: str, dataset: str) -> list[date]:
    """Days with a folder, ascending; only names are listed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{root}/{source}/{dataset}/*/*/*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = (re.search(r"/(\d{4})/(\d{2})/(\d{2})$", x.getPath().toString()) for x in found)
    return sorted(date(*map(int, m.groups())) for m in names if m)


def has_day(spark: SparkSession, root: str, source: str, dataset: str, day: date) -> bool:
    return day in days(spark, root, source, dataset)


def covering_day(spark: SparkSession, root: str, source: str, dataset: str, day: date, back: int = COVER_DAYS) -> date | None:
    """The day itself, or the nearest earlier one at most `back` days before it."""
    near = [x for x in days(spark, root, source, dataset) if x <= day and (day - x).days <= back]
    return near[-1] if near else None


def bodies(files: DataFrame) -> DataFrame:
    return files.filter("ext != '.meta.json' and ext != ''")


def sidecars(files: DataFrame) -> DataFrame:
    """Parsed sidecars beside their place; an unreadable one has a null `meta`."""
    meta = F.from_json(F.col("content").cast("string"), SIDECAR, {"mode": "PERMISSIVE"})
    broken = F.get_json_object(F.col("content").cast("string"), "$").isNull()
    return files.filter("ext = '.meta.json'").select("day", "stem", F.col("source").alias("path_source"), F.col("dataset").alias("path_dataset"), F.when(~broken, meta).alias("meta"))


def stamp(meta: Column) -> Column:
    return F.coalesce(*[safe_instant(meta[k]) for k in STAMP_KEYS])


def vouched(files: DataFrame) -> DataFrame:
    """Bodies with their own sidecar's stamp, and the reason where there is none."""
    side = sidecars(files).select(F.col("path_source").alias("source"), F.col("path_dataset").alias("dataset"), "day", "stem", "meta", F.lit(True).alias("_side"))
    joined = bodies(files).join(side, ["source", "dataset", "day", "stem"], "left")
    at = stamp(F.col("meta"))
    has_key = F.coalesce(*[F.col("meta")[k] for k in STAMP_KEYS]).isNotNull()
    reason = F.when(F.col("_side").isNull(), "NO_SIDECAR").when(F.col("meta").isNull(), "UNREADABLE_SIDECAR").when(~has_key, "NO_TIMESTAMP_KEY").when(at.isNull(), "UNPARSEABLE_TIMESTAMP")
    return joined.withColumns({"stamp": at, "reason": reason}).drop("_side")


def newest_vouched(files: DataFrame) -> DataFrame:
    """Of each dataset and day the last body by name that its sidecar vouches for."""
    from pyspark.sql import Window as W

    order = W.partitionBy("source", "dataset", "day").orderBy(F.desc("stem"), F.desc("path"))
    return vouched(files).filter("reason is null").withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def latest_directory(files: DataFrame) -> DataFrame:
    """(source, dataset, day) of the directory with the newest file."""
    return bodies(files).groupBy("source", "dataset").agg(F.max_by("day", "modified_at").alias("day"))


def stamp_span(files: DataFrame) -> DataFrame:
    """(first_stamp, last_stamp, n_files) of the bodies that are vouched for."""
    return vouched(files).filter("reason is null").agg(F.min("stamp").alias("first_stamp"), F.max("stamp").alias("last_stamp"), F.count("*").alias("n_files"))


def published_from(meta: Column) -> Column:
    """A portal resource's last modification, else null: such a file is declined, its fetch time isn't a publication."""
    return safe_instant(meta["request_params"]["last_modified"])


def issue_time(meta: Column) -> Column:
    """The twelve-digit token in a portal file's name."""
    return F.try_to_timestamp(F.regexp_extract(meta["request_params"]["filename"], r"(\d{12})", 1), F.lit("yyyyMMddHHmm"))


def json_records(files: DataFrame, key: str = "data") -> DataFrame:
    """One row a record: path, day, stamp, ordinal, record.

    The body is a bare list, a record list under `key`, else under the first list-valued entry but
    `meta`. Unreadable bodies give no rows. Records are JSON text.
    """
    text = F.regexp_replace(F.col("content").cast("string"), "^﻿", "")
    entries = F.from_json(text, "map<string,string>")
    lists = F.map_filter(entries, lambda k, v: (k != "meta") & v.startswith("["))
    first = F.element_at(F.map_values(lists), 1)
    named = F.try_element_at(entries, F.lit(key))
    body = F.when(F.ltrim(text).startswith("["), text).when(named.startswith("["), named).when(named.startswith("{"), F.concat(F.lit("["), named, F.lit("]"))).when(F.size(lists) > 0, first)
    carried = [c for c in ("day", "stamp", "meta", "source", "dataset") if c in files.columns]
    return files.select("path", *carried, F.posexplode(F.from_json(body, "array<string>")).alias("ordinal", "record"))


def csv_records(spark: SparkSession, paths: list[str], header: tuple[str, ...]) -> DataFrame:
    """All-string rows with path and ordinal; a header other than exactly `header` (blanks trimmed) raises.

    HTML, empty and badly encoded bodies raise too. Each file is one snapshot and is split into
    records where it is read.
    """
    return csv_rows(spark.read.format("binaryFile").load(paths), header)


def csv_rows(raw: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """`csv_records` of files as (path, content). Quoted fields may hold commas, doubled quotes and line breaks."""
    text = F.decode("content", "UTF-8")
    bare = F.regexp_replace(text, "^﻿", "")
    problem = (
        F.when(F.trim(bare) == "", "is empty")
        .when(F.lower(F.ltrim(bare)).rlike(r"^<(!doctype|html)"), "is HTML")
        .when(text.contains("�"), "isn't UTF-8")
    )
    checked = F.when(problem.isNotNull(), F.raise_error(F.concat("path", F.lit(" "), problem)).cast("string")).otherwise(bare)
    # possessive, so a record costs its length; a line break inside quotes doesn't end it
    lines = F.filter(F.regexp_extract_all(checked, F.lit(r'(?:[^"\r\n]|"(?:[^"]|"")*+")++'), F.lit(0)), lambda x: F.trim(x) != "")
    columns = lambda n: ", ".join(f"c{i} string" for i in range(n))
    options = {"multiLine": "true", "escape": '"'}
    first = F.from_csv("head", columns(len(header) + 1), options | {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    same = F.forall(F.zip_with(F.array(*[F.trim(first[f"c{i}"]) for i in range(len(header) + 1)]), F.array(*[F.lit(h) for h in header], F.lit(None).cast("string")), lambda a, b: a.eqNullSafe(b)), lambda x: x)
    parted = raw.select("path", lines.alias("lines")).select("path", "lines", F.get("lines", F.lit(0)).alias("head"))
    body = F.when(same, F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).otherwise(F.raise_error(F.concat(F.lit("header drifted: "), F.col("head"))).cast("array<string>"))
    rows = parted.select("path", F.posexplode(body).alias("ordinal", "line")).withColumn("r", F.from_csv("line", columns(len(header)), options))
    return rows.select("path", "ordinal", *[F.col("r")[f"c{i}"].alias(h) for i, h in enumerate(header)])


def sanitise(params: dict, secrets: re.Pattern = re.compile(r"(?i)key|token|secret|password")) -> dict:
    """Request parameters with secret values masked, at any depth."""
    if isinstance(params, dict):
        return {k: "***" if secrets.search(k) else sanitise(v) for k, v in params.items()}
    return [sanitise(x) for x in params] if isinstance(params, list) else params


def sanitise_url(url: str) -> str:
    """A request's address with the values of secret parameters masked."""
    return re.sub(r"(?i)([?&][^=&#]*(?:key|token|secret|password)[^=&#]*=)[^&#]*", r"\1***", url)


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a file through the session's file systems: under another name first, then renamed."""
    jvm = spark._jvm
    target, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(part, True)
    out.write(data)
    out.close()
    files.delete(target, False)
    if not files.rename(part, target):
        raise OSError(f"can't rename {path}.tmp")


def write_raw(root: str, source: str, dataset: str, day: date, body: bytes, meta: dict, ext: str = "json", stamp_text: str | None = None, spark: SparkSession | None = None) -> str:
    """Land a body and its sidecar; each appears whole or not at all. With a session any of its file systems will do, else a local path."""
    import hashlib
    import os
    from datetime import datetime, timezone

    now = datetime.now(timezone.utc)
    digest = hashlib.sha256(body).hexdigest()
    folder = f"{root}/{source}/{dataset}/{day:%Y/%m/%d}"
    stem = f"{folder}/raw_{stamp_text or now.strftime('%Y%m%dT%H%M%S%f')}_{digest[:8]}"
    side = {"source": source, "dataset": dataset, "written_at": now.isoformat(), "data_date": str(day), "body_sha256": digest, "body_size_bytes": len(body)} | meta
    side["request_params"] = sanitise(side.get("request_params") or {})
    if side.get("request_url"):
        side["request_url"] = sanitise_url(side["request_url"])
    if spark is None:
        os.makedirs(folder, exist_ok=True)
    for path, data in ((f"{stem}.{ext}", body), (f"{stem}.meta.json", json.dumps(side).encode())):
        if spark is not None:
            _put(spark, path, data)
            continue
        with open(f"{path}.tmp", "wb") as f:
            f.write(data)
        os.replace(f"{path}.tmp", path)
    return f"{stem}.{ext}"
