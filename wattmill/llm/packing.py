"""Packing token sequences into fixed windows by best-fit decreasing.

Texts are tokenised where they lie; only piece lengths move. An overlong document is cut into full
windows, which are sequences already, and a remainder; remainders are packed in groups of bounded
size that a hash of the key deals out, so each task works on its own groups and none on all.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._plan import estimated_bytes
from .bpe import encoder, text_batches

WINDOW = 2048
END_OF_TEXT = 1
GROUP_BYTES = 32 << 20  # stored input for each group, about 10,000 remainders


class BestFit:
    """Open windows by remaining capacity, found through a segment tree over capacities 1 to `window`."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.window = window
        self.tree = [False] * (2 * self.leaves)  # whether a capacity below this node is open
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.made = 0

    def _mark(self, capacity: int, on: bool) -> None:
        i = capacity + self.leaves
        self.tree[i] = on
        while i > 1:
            i >>= 1
            now = self.tree[2 * i] or self.tree[2 * i + 1]
            if self.tree[i] == now:
                break
            self.tree[i] = now

    def _tightest(self, length: int) -> int:
        """The least open capacity of at least `length`, or 0."""
        tree, i = self.tree, length + self.leaves
        if tree[i]:
            return length
        while i > 1:
            if not i & 1 and tree[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return 0
        while i < self.leaves:
            i = 2 * i if tree[2 * i] else 2 * i + 1
        return i - self.leaves

    def put(self, length: int) -> tuple[int, int]:
        """(window number, offset in it) for a piece, which must come in order of falling length."""
        capacity = self._tightest(length)
        if capacity:
            number = self.open[capacity].pop()
            if not self.open[capacity]:
                self._mark(capacity, False)
        else:
            number, capacity = self.made, self.window
            self.made += 1
        left = capacity - length
        if left:
            if not self.open[left]:
                self._mark(left, True)
            self.open[left].append(number)
        return number, self.window - capacity


def pieces(df: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's ids and the end id, cut into full windows and a remainder: (doc_id, start, length, ids_crc32, doc_tokens).

    A null or empty text gives one piece, of the end id. Null keys and repeated rows give pieces of
    their own, an empty table gives none, other columns aren't read. Work goes by about a megabyte
    of whole texts; a text of N bytes takes some 60 N bytes.
    """
    cut = _pieces(df, path, window, key, text)
    return cut.drop("n")


def _pieces(df: DataFrame, path: str, window: int, key: str, text: str) -> DataFrame:
    """`pieces`, with each row's number in its partition as `n`."""
    kind = df.schema[key].dataType.simpleString()

    def rows(batches):
        made, before = encoder(path), 0
        for batch in batches:
            doc, start, length, crc, tokens = [], [], [], [], []
            row = 0
            for first, last, buf, offsets in text_batches(batch, 1):
                ids, at = made.encode(buf, offsets)
                n = np.diff(at) + 1
                out = np.full(len(ids) + last - first, END_OF_TEXT, "<u4")
                ends = np.cumsum(n)
                keep = np.ones(len(out), bool)
                keep[ends - 1] = False
                out[keep] = ids
                raw = memoryview(out.view(np.uint8))
                for total, end in zip(n.tolist(), ends.tolist(), strict=True):
                    base = end - total
                    for a in range(0, total, window):
                        b = min(a + window, total)
                        doc.append(row)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(raw[4 * (base + a) : 4 * (base + b)]))
                        tokens.append(total)
                    row += 1
            cols = [pc.take(batch.column(0), pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens, [before + i for i in doc]))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "n"])
            before += row

    return df.select(F.col(key).alias("doc_id"), F.col(text).cast("binary")).mapInArrow(rows, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, n long")


def pack(df: DataFrame, path: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All pieces with their sequence_id and the offset in it; a sequence holds at most `window` ids.

    A null text counts as empty: one piece, of the end id alone. Repeated rows and null keys make
    pieces of their own; an empty table gives none; other columns aren't read. Groups are dealt by
    key, digest and place in the partition, so that a key or text which many rows share fills
    none alone; ties in length go by key, then by digest. A rerun of a lost task packs alike.
    """
    groups = max(1, -(-estimated_bytes(df) // GROUP_BYTES))
    cut = _pieces(df, path, window, key, text)
    cut = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "ids_crc32", "n", F.lit("pack")), F.lit(groups)).cast("long")).drop("n")

    def place(table: pa.Table) -> pa.Table:
        length = table["length"].to_numpy()
        order = pc.sort_indices(table, [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]).to_numpy()
        fit = BestFit(window)
        number, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for i in order.tolist():
            number[i], offset[i] = fit.put(int(length[i]))
        group = table["_group"].to_numpy()
        return table.drop_columns(["_group"]).append_column("sequence_id", pa.array(group << 32 | number)).append_column("offset", pa.array(offset))

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name != "_group")
    return cut.groupBy("_group").applyInArrow(place, f"{ddl}, sequence_id long, offset long")
