"""Toxicity by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = logistic(cut_k - w.x): one weight vector serves all ordered cuts. Features are words
and beginnings of words, as the root of their share of a document's words. The model is fitted in
one task on a bounded sample of labelled documents; its size is bounded too, so it is broadcast,
and every document is scored where it lies.

Labels only say toxic or not, so the sample's toxic documents are graded by how dense the features
that mark toxic documents are in them: `grades` - 1 bands of equal size above grade 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._plan import private
from ._text import lower, slice_hashes, table_batches, text_batches, words

_U = np.uint64
_BLANK = np.ones(256, bool)
_BLANK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
STEMS = (4, 5, 6)  # bytes of the beginnings that count as features


def _features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature hash, text number) of all features, one kind after another, and the number of words of each text."""
    buf = lower(buf)
    starts, ends, at = words(buf, offsets, _BLANK)
    counts = np.diff(at)
    owner = np.repeat(np.arange(len(counts)), counts)
    kinds, owners = [slice_hashes(buf, starts, ends)], [owner]
    for k in STEMS:
        long = ends - starts > k
        kinds.append(slice_hashes(buf, starts[long], starts[long] + k) ^ _U(k))
        owners.append(owner[long])
    return np.concatenate(kinds), np.concatenate(owners), counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, grade: np.ndarray, n_features: int, grades: int, steps: int = 400, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ascending cuts) by gradient ascent (Adam) on the cumulative-link likelihood of sparse rows (row, feature, value).

    Cuts are the first cut and logs of the gaps, so they stay in order. Grades weigh alike.
    """
    n = len(grade)
    share = np.bincount(grade, minlength=grades).astype(float)
    weight = (n / (grades * np.maximum(share, 1)))[grade]
    theta = np.zeros(n_features + grades - 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, gaps = theta[:n_features], np.exp(np.clip(theta[n_features + 1 :], -20, 20))
        cuts = theta[n_features] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(rows, w[cols] * vals, n)
        above = np.concatenate((cuts, [np.inf]))[grade] - score
        below = np.concatenate(([-np.inf], cuts))[grade] - score
        hi, lo = _sigmoid(np.nan_to_num(above, posinf=40)), np.where(grade > 0, _sigmoid(np.nan_to_num(below, neginf=-40)), 0.0)
        hi = np.where(grade < grades - 1, hi, 1.0)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p * weight, lo * (1 - lo) / p * weight
        slope = -(d_hi - d_lo)  # of the log-likelihood, by score
        gradient = np.empty_like(theta)
        gradient[:n_features] = np.bincount(cols, slope[rows] * vals, n_features) / n - decay * w
        by_cut = (np.bincount(np.minimum(grade, grades - 2), np.where(grade < grades - 1, d_hi, 0), grades - 1) - np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, d_lo, 0), grades - 1)) / n
        after = np.cumsum(by_cut[::-1])[::-1]
        gradient[n_features] = after[0]
        gradient[n_features + 1 :] = after[1:] * gaps
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    gaps = np.exp(np.clip(theta[n_features + 1 :], -20, 20))
    return theta[:n_features], theta[n_features] + np.concatenate(([0.0], np.cumsum(gaps)))


def fit(table: pa.Table, max_features: int, grades: int) -> dict:
    """A model (feature hashes ascending, weights, cuts) from rows of (doc_id, text, toxic)."""
    toxic = table["toxic"].to_numpy().astype(np.int64)
    keys, rows, counts, totals = [], [], [], []
    for first, _, buf, offsets in table_batches(table, "text"):
        key, row, n = _features(buf, offsets)
        order = np.lexsort((key, row))
        key, row = key[order], row[order]
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])))) if len(key) else order
        keys.append(key[new])
        rows.append(row[new] + first)
        counts.append(np.diff(np.append(new, len(key))))
        totals.append(n)
    if not keys or not 0 < toxic.sum() < len(toxic):
        return {"features": np.empty(0, _U), "weights": np.empty(0), "cuts": np.full(grades - 1, 20.0)}
    key, row, count = (np.concatenate(x) for x in (keys, rows, counts))
    total = np.maximum(np.concatenate(totals), 1)
    names, of = np.unique(key, return_inverse=True)
    bad, good = np.bincount(of, toxic[row], len(names)), np.bincount(of, 1 - toxic[row], len(names))
    n_bad, n_good = toxic.sum(), (1 - toxic).sum()
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n_good + 1))
    strength = np.abs(odds) * np.sqrt(bad + good) * (bad + good >= 4)
    chosen = np.sort(np.argsort(-strength, kind="stable")[:max_features])
    chosen = chosen[strength[chosen] > 0]
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    mine = place[of] >= 0
    row, col, count = row[mine], place[of[mine]], count[mine]
    value = np.sqrt(count / total[row])
    density = np.bincount(row, np.where(odds[chosen][col] > 2, count, 0) / total[row], len(toxic))
    grade = np.zeros(len(toxic), np.int64)
    rank = np.argsort(np.argsort(density[toxic == 1], kind="stable"), kind="stable")
    grade[toxic == 1] = 1 + rank * (grades - 1) // len(rank)
    weights, cuts = fit_ordinal(row, col, value, grade, len(chosen), grades)
    return {"features": names[chosen], "weights": weights, "cuts": cuts}


def score(model: dict, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(expected severity, most likely grade, P(grade >= 1)) of each text."""
    names, weights, cuts = model["features"], model["weights"], model["cuts"]
    key, row, n = _features(buf, offsets)
    total = np.zeros(len(n))
    if len(names) and len(key):
        spot = np.minimum(np.searchsorted(names, key), len(names) - 1)
        hit = names[spot] == key
        pair, count = np.unique(row[hit] * len(names) + spot[hit], return_counts=True)
        of, col = pair // len(names), pair % len(names)
        total = np.bincount(of, weights[col] * np.sqrt(count / n[of]), len(n))
    above = 1 - _sigmoid(cuts[None, :] - total[:, None])
    edges = np.concatenate((np.ones((len(n), 1)), above, np.zeros((len(n), 1))), axis=1)
    return above.sum(axis=1), (edges[:, :-1] - edges[:, 1:]).argmax(axis=1), above[:, 0]


def train(docs: DataFrame, labels: DataFrame, max_documents: int = 6000, max_bytes: int = 65_536, max_features: int = 4096, grades: int = 3) -> dict:
    """Fit on at most `max_documents` labelled documents (least hash of the id first) of at most `max_bytes` each.

    Labels with a null id or class, and documents with a null text or more bytes, aren't used. An id
    with several labels is toxic if one of them says so; of several texts of an id the least is
    used, so repeated ids don't add to the sample. Empty texts count. Other columns, whatever their
    names, aren't read. Without both classes, and so with an empty table, the model finds
    everything clean.
    """
    picked = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    texts = docs.filter(F.octet_length("text") <= max_bytes).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    sample = texts.join(F.broadcast(picked), "doc_id")  # at most max_documents rows of two numbers
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending")])
        model = fit(table, max_features, grades)
        return pa.table({k: pa.array([v.tobytes()], pa.binary()) for k, v in model.items()})

    rows = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(lambda t: one(t.drop_columns(["one"])), "features binary, weights binary, cuts binary").collect()
    if not rows:
        return {"features": np.empty(0, _U), "weights": np.empty(0), "cuts": np.full(grades - 1, 20.0)}
    return {"features": np.frombuffer(rows[0].features, _U), "weights": np.frombuffer(rows[0].weights), "cuts": np.frombuffer(rows[0].cuts)}


def grade(docs: DataFrame, model: dict, threshold: float = 0.5, names: tuple[str, str, str] = ("severity", "expected_severity", "toxic")) -> DataFrame:
    """`docs` with severity (most likely grade), expected_severity and toxic (P(grade >= 1) >= threshold), under `names`.

    A null or empty text scores as one without features. Repeated rows and null ids pass through; an
    empty table gives none; columns of `docs` that have one of the names give way, all others stay.
    Work goes by about a megabyte of whole texts; a text of N bytes takes some 60 N bytes.
    """
    (raw,) = private(docs, "raw")
    taken = {n.lower() for n in names}
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken], F.col("text").cast("binary").alias(raw))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch in batches:
            where = len(batch.schema.names) - 1
            expected, most, chance = [np.empty(0)], [np.empty(0, np.int64)], [np.empty(0)]
            for _, _, buf, offsets in text_batches(batch, where):
                e, m, p = score(held.value, buf, offsets)
                expected.append(e)
                most.append(m)
                chance.append(p)
            new = [pa.array(np.concatenate(most), pa.int32()), pa.array(np.concatenate(expected)), pa.array(np.concatenate(chance) >= threshold)]
            yield pa.RecordBatch.from_arrays(batch.columns[:where] + new, batch.schema.names[:where] + list(names))

    kinds = zip(names, ("int", "double", "boolean"), strict=True)
    return kept.mapInArrow(rows, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema][:-1], *[f"`{n}` {k}" for n, k in kinds]]))
