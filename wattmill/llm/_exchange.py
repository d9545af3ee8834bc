"""Questions about keys that chunks of texts put to the whole corpus.

A chunk sends each of its distinct 64-bit keys once, packed with others that go the same way; the
receiver of a range of keys sees at most one entry a chunk, however often a key occurs, and sends
back one small answer for each entry. So a key that a third of all texts hold costs no more than
one entry for each chunk, and nothing but keys moves. Texts are dealt into chunks once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._plan import estimated_bytes, shuffle_partitions
from ._text import distinct

SENT = "p long, chunk long, keys binary, extra binary"
REPLY = "chunk long, p long, reply binary"
CHUNK_BYTES = 4 << 20  # stored input for each chunk
RANGE_CHUNKS = 4  # chunks whose keys would fill a range


def ways(df: DataFrame) -> int:
    """The number of chunks: near CHUNK_BYTES of stored input each."""
    return max(shuffle_partitions(df.sparkSession), -(-estimated_bytes(df) // CHUNK_BYTES))


def ranges(df: DataFrame, chunks: int, share: int = RANGE_CHUNKS) -> int:
    """The number of key ranges: few, so that messages stay long, but each receives what `share` chunks send."""
    return max(shuffle_partitions(df.sparkSession), -(-chunks // share))


def chunk_of(key: str | Column, text: str | Column, n: int) -> Column:
    """A chunk number; rows that share an id part by their texts."""
    return F.pmod(F.xxhash64(key, text, F.lit("chunk")), F.lit(n)).cast("long")


def chunked(df: DataFrame, n: int, key: str, text: str, *more: Column) -> DataFrame:
    """(chunk, doc_id, text as bytes, ...)."""
    return df.select(chunk_of(key, text, n).alias("chunk"), F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"), *more)


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's rows by id and text. Each read of a shuffle may give them in another order, so whatever is sent in the order of rows needs this."""
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])) if table.num_rows > 1 else table


def order_ids(table: pa.Table) -> np.ndarray:
    """Ids as integers; null as the least."""
    return table["doc_id"].fill_null(-(1 << 63)).to_numpy()


def _route(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    way = ((keys >> np.uint64(32)) % np.uint64(n)).astype(np.int64)
    order = np.argsort(way, kind="stable")
    there, first = np.unique(way[order], return_index=True)
    return order, there, np.append(first, len(keys))


def _pack(values: np.ndarray) -> bytes:
    return (np.packbits(values) if values.dtype == bool else values).tobytes()


def _unpack(raw: bytes, kind: type, count: int) -> np.ndarray:
    if kind is bool:
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=count).astype(bool)
    return np.frombuffer(raw, kind)


def send(chunk: int, keys: np.ndarray, extra: np.ndarray, n: int, kind: type = np.uint64) -> pa.Table:
    """One row for each range of keys that `keys` (distinct) fall in.

    As np.uint32 only their lower half is sent: keys of one range that agree in it count as equal,
    which is enough where an answer only narrows a search.
    """
    order, there, cuts = _route(keys, n)
    keys, extra = keys[order].astype(kind), extra[order]
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    return pa.table(
        {
            "p": pa.array(there, pa.int64()),
            "chunk": pa.array([chunk] * len(there), pa.int64()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
            "extra": pa.array([_pack(extra[a:b]) for a, b in spans], pa.binary()),
        }
    )


def receive(replies: pa.Table, keys: np.ndarray, n: int, kind: type) -> np.ndarray:
    """The answers to `keys`, which must be those sent."""
    order, there, cuts = _route(keys, n)
    out = np.empty(len(keys), kind)
    got = dict(zip(replies["p"].to_pylist(), replies["reply"].to_pylist(), strict=True))
    for p, a, b in zip(there.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        out[order[a:b]] = _unpack(got[p], kind, b - a)
    return out


def _entries(table: pa.Table, kind: type, key_kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray, list[int]]:
    keys = [np.frombuffer(x, key_kind) for x in table["keys"].to_pylist()]
    extra = [_unpack(x, kind, len(k)) for x, k in zip(table["extra"].to_pylist(), keys, strict=True)]
    return np.concatenate(keys), np.concatenate(extra), np.cumsum([0, *map(len, keys)]).tolist()


def _reply(table: pa.Table, answers: np.ndarray, cuts: list[int]) -> pa.Table:
    raw = [_pack(answers[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.table({"chunk": table["chunk"], "p": table["p"], "reply": pa.array(raw, pa.binary())})


def in_several(table: pa.Table) -> pa.Table:
    """Extra: whether several texts of the chunk hold the key. Answer: whether several of all texts do."""
    return _in_several(table, np.uint64)


def _in_several(table: pa.Table, key_kind: type) -> pa.Table:
    keys, several, cuts = _entries(table, bool, key_kind)
    _, of, count = np.unique(keys, return_inverse=True, return_counts=True)
    total = np.bincount(of, several, len(count)) + count
    return _reply(table, total[of] > 1, cuts)


def halves_in_several(table: pa.Table) -> pa.Table:
    """As `in_several`, for the lower halves of keys."""
    return _in_several(table, np.uint32)


def elsewhere_first(table: pa.Table) -> pa.Table:
    """Extra: a second key, and the least id in the chunk that holds both. Answer: whether a lesser one holds them elsewhere."""
    keys, extra, cuts = _entries(table, np.int64)
    other, ids = extra.reshape(-1, 2).T
    order, new = distinct(keys, other)
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    answer = np.empty(len(keys), bool)
    answer[order] = least[np.cumsum(new) - 1] < ids[order]
    return _reply(table, answer, cuts)


def holders(table: pa.Table) -> pa.Table:
    """Extra: how many texts of the chunk hold the key. Answer: how many of all do (at most 65,535)."""
    keys, n, cuts = _entries(table, np.uint16)
    _, of = np.unique(keys, return_inverse=True)
    total = np.bincount(of, n)
    return _reply(table, np.minimum(total, 65535).astype(np.uint16)[of], cuts)


def ask(docs: DataFrame, questions: Callable[..., pa.Table], answer: Callable[[pa.Table], pa.Table], replies: DataFrame | None = None) -> DataFrame:
    """Answers, by chunk, to what `questions` makes of each chunk's rows (and of earlier answers)."""
    groups = docs.groupBy("chunk")
    sent = groups.applyInArrow(questions, SENT) if replies is None else groups.cogroup(replies.groupBy("chunk")).applyInArrow(questions, SENT)
    return sent.groupBy("p").applyInArrow(answer, REPLY)


def tell(docs: DataFrame, replies: DataFrame, rows: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(rows, schema)
