"""Exact top-k search by term-at-a-time accumulation.

Vectors become sparse rows of integers. A block of rows holds its postings by term; each block of
queries adds, term after term, its weights times the postings' weights into a dense array of
scores, one row a query. Partition selection keeps the best k of a block, and the blocks' few
candidates are merged for each query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._plan import shuffle_partitions

BLOCK_ROWS = 65_536
BLOCK_QUERIES = 16_384  # rows are copied once for each, so few and large ones
LEAST_ROWS = 8_192  # rows from which a block is split for the sake of idle tasks
_SLICE = 64  # queries whose score arrays are held at once


class Postings:
    """Weights by term over a block of rows; rows may differ in length."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.rows = len(offsets) - 1
        lengths = np.diff(offsets)
        row = np.repeat(np.arange(self.rows), lengths)
        term = np.arange(len(flat)) - np.repeat(offsets[:-1], lengths)
        held = flat != 0
        row, term, weight = row[held], term[held], flat[held]
        order = np.argsort(term, kind="stable")
        row, term, weight = row[order], term[order], weight[order]
        self.terms, first = np.unique(term, return_index=True)
        cuts = np.append(first, len(term))
        self.lists = [(row[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def accumulate(postings: Postings, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores (queries x rows) of sparse integer queries."""
    n = len(offsets) - 1
    scores = np.zeros((n, postings.rows), np.int64)
    lengths = np.diff(offsets)
    for term, (rows, weights) in zip(postings.terms.tolist(), postings.lists, strict=True):
        has = np.flatnonzero(lengths > term)
        weight = flat[offsets[:-1][has] + term]
        has, weight = has[weight != 0], weight[weight != 0]
        full = len(rows) == postings.rows
        for q, w in zip(has.tolist(), weight.tolist(), strict=True):
            if full:
                scores[q] += w * weights
            else:
                scores[q, rows] += w * weights
    return scores


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best scores, ties to smaller ids, in order."""
    m = len(scores)
    if m > k:
        edge = np.partition(scores, m - k)[m - k]
        above, level = np.flatnonzero(scores > edge), np.flatnonzero(scores == edge)
        if len(above) + len(level) > k:
            room = k - len(above)
            level = level[np.argpartition(ids[level], room - 1)[:room]] if room < len(level) else level
        keep = np.concatenate((above, level))
    else:
        keep = np.arange(m)
    return keep[np.lexsort((ids[keep], -scores[keep]))]


def quantise(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component as a long, or null for a vector that takes no part: one that is null, or holds a null, a component that isn't finite, or one whose result no long can hold."""
    real = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0**63 / scale)))
    return F.when(vector.isNotNull() & sound, F.transform(real, lambda x: F.floor(x * F.lit(scale)).cast("long")))


def search(queries: DataFrame, rows: DataFrame, k: int = 5, key: str = "vec_id", weights: str = "weights", block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product for each query, but not its own id.

    Terms that a row lacks count as zero, so vectors may differ in length; all scores must fit a
    long. Ties go to the smaller id. Rows or queries with a null id or null weights take no part; an
    empty table on either side gives no rows; other columns aren't read. Repeated candidate rows
    each take a rank. Each query row has its own answer, also if it repeats or shares its id with
    others, whose answers then stand side by side. Both sides are dealt into blocks of about the stated sizes, and each pair of blocks meets
    in a task of its own, so neither side is broadcast or gathered whole.
    """
    held = lambda df: df.filter(F.col(key).isNotNull() & F.col(weights).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(weights).alias("w"))
    # equal query rows are searched once; a digest tells those that share only the id apart
    ask = held(queries).groupBy("id", "w").agg(F.count("*").alias("copies")).withColumn("mark", F.sha2(F.to_json("w").cast("binary"), 256))
    give = held(rows)
    n_rows = give.count()
    n_ask = max(1, -(-ask.count() // block_queries))
    n_give = max(1, -(-n_rows // block_rows), min(shuffle_partitions(rows.sparkSession), n_rows // LEAST_ROWS))
    all_q, all_r = F.sequence(F.lit(0), F.lit(n_ask - 1)), F.sequence(F.lit(0), F.lit(n_give - 1))
    left = ask.select("id", "w", "copies", "mark", F.pmod(F.xxhash64("id", "w", F.lit("q")), F.lit(n_ask)).cast("int").alias("q"), F.explode(all_r).alias("r"))
    right = give.select("id", "w", F.explode(all_q).alias("q"), F.pmod(F.xxhash64("id", "w", F.lit("r")), F.lit(n_give)).cast("int").alias("r"))

    def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        col = table["w"].combine_chunks()
        col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
        at = col.offsets.to_numpy().astype(np.int64)
        return table["id"].to_numpy(), col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), at - at[0]

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if a.num_rows and b.num_rows:
            qid, qw, qat = flat(a)
            rid, rw, rat = flat(b)
            postings = Postings(rw, rat)
            of_id = np.argsort(rid, kind="stable")
            for i in range(0, len(qid), _SLICE):
                j = min(i + _SLICE, len(qid))
                scores = accumulate(postings, qw[qat[i] : qat[j]], qat[i : j + 1] - qat[i])
                for at, (s, q) in enumerate(zip(scores, qid[i:j].tolist(), strict=True), i):
                    lo, hi = np.searchsorted(rid, [q, q + 1], sorter=of_id)
                    own = of_id[lo:hi]
                    ids = rid
                    if len(own):
                        s, ids = np.delete(s, own), np.delete(rid, own)
                    keep = select(s, ids, k)
                    out[0].append(np.full(len(keep), q))
                    out[1].append(ids[keep])
                    out[2].append(s[keep])
                    out[3].append(np.full(len(keep), at))
        *cols, at = (np.concatenate([np.empty(0, np.int64), *x]) for x in out)
        asked = a.select(["copies", "mark"]).take(pa.array(at))
        return pa.table([*[pa.array(c, pa.int64()) for c in cols], asked["copies"], asked["mark"]], ["query_id", "vec_id", "score", "copies", "mark"])

    found = left.groupBy("q", "r").cogroup(right.groupBy("q", "r")).applyInArrow(best, "query_id long, vec_id long, score long, copies long, mark string")
    order = W.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), F.col("vec_id"))
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("query_id", "rank", "vec_id", "score")
