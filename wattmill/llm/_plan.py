"""Plumbing shared by the corpus operators: sizes, shared tables, components."""

from __future__ import annotations

import contextlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


UNKNOWN_BYTES = 1 << 50  # Catalyst's guess for a source that it knows nothing of lies beyond this


def estimated_bytes(df: DataFrame) -> int:
    """The bytes of the files and tables that a plan reads, by Catalyst's statistics, which costs no job.

    Only sources are asked: estimates of joins multiply. Where a source has none, the bytes of
    strings are counted in one pass, at half for what compression would leave of them.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    if max(sizes, default=0) < UNKNOWN_BYTES:
        return sum(sizes)
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    row = df.agg(F.count("*").alias("n"), F.sum(sum(texts, F.lit(0).cast("long"))).alias("b")).first()
    return 16 * row.n + (row.b or 0) // 2


def private(df: DataFrame, *names: str) -> list[str]:
    """`names`, changed where a column of `df` has one of them (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunk_count(df: DataFrame, chunk_bytes: int = 4 << 20) -> int:
    """How many chunks keep each near `chunk_bytes` of stored input, with a few for each task."""
    return max(3 * shuffle_partitions(df.sparkSession), -(-estimated_bytes(df) // chunk_bytes))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. One is made only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        folder = "file://" + tempfile.mkdtemp(prefix="wattmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Shared:
    """Tables written to the shared folder, so that a lost executor loses no lineage.

    They go when the session ends, as results read them lazily.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/wattmill-{uuid.uuid4().hex}"
        self.count = 0
        target = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(target)
        files.deleteOnExit(target)

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.count}"
        self.count += 1
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._shared_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_shared_path", None)
        if path:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            with contextlib.suppress(Exception):
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def _forest(batches):
    """Replace the edges of a partition by a spanning forest of stars around the smallest ids."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def flush():
        pairs = [(x, find(x)) for x in parent]
        pairs = [(a, b) for a, b in pairs if a != b]
        cols = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(cols[:, 0]), pa.array(cols[:, 1])], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:
            yield flush()
            parent.clear()
    yield flush()


def connected_components(edges: DataFrame, shared: Shared, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of `edges` (u, v: long); component is the smallest node reachable.

    Large-star and small-star rounds over spanning forests; each round is written to the shared
    folder. Minima are aggregated map-side before the join back, so a hub's edges need not meet
    in one task. No round collects more than two numbers to the driver.
    """
    now = shared.table(edges.select("u", "v").filter("u != v").mapInArrow(_forest, "u long, v long"))
    before = None
    for _ in range(max_rounds):
        both = now.select(F.col("u").alias("a"), F.col("v").alias("b")).union(now.select(F.col("v").alias("a"), F.col("u").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).filter("a != b")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).filter("u != v")
        step = shared.table(small.union(low.select(F.col("a").alias("u"), F.col("m").alias("v"))).distinct())
        mark = tuple(step.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        shared.drop(now)
        now = step
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    tree = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = tree.select(F.col("component").alias("node")).distinct()  # settled: no root is a member of another star
    return tree.unionByName(roots.withColumn("component", F.col("node")))
