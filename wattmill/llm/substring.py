"""Substring dedup by level-wise doubling of word windows.

Level one asks which windows of a few words several documents hold. A window of the wanted length
stays a candidate if all of its parts do; the parts of twice the length inside candidates alone are
asked about at the next level, and so on, until the wanted length is reached or a chunk of texts
has no candidate left, which then asks nothing more. The last level asks for the least document
that holds a candidate as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _exchange as X
from ._text import distinct, slice_hashes, table_batches, windows, words

FIRST_WORDS = 4  # the windows of level one


def levels(length: int, first: int = FIRST_WORDS) -> list[int]:
    """The lengths asked about: each twice the one before, up to the wanted one."""
    out = [min(first, length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


class _Candidates:
    """The windows of a chunk's texts that can still repeat, by the word they start at."""

    def __init__(self, table: pa.Table, length: int, n: int, whole: bool = True):
        """`whole`: the second hash, of the last level, is wanted too."""
        self.table, self.length, self.n = table, length, n
        self.ids = X.order_ids(table)
        hashes, others, counts = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for _, _, buf, offsets in table_batches(table, "text"):
            starts, ends, at = words(buf, offsets)
            hashes.append(slice_hashes(buf, starts, ends))
            if whole:
                others.append(slice_hashes(buf, starts, ends, 1))
            counts.append(np.diff(at))
        self.hashes, self.others, counts = np.concatenate(hashes), np.concatenate(others), np.concatenate(counts)
        self.row = np.repeat(np.arange(len(counts)), counts)
        end = np.repeat(np.cumsum(counts), counts)
        self.alive = np.arange(len(self.row)) + length <= end

    def parts(self, size: int) -> np.ndarray:
        """Where the windows of `size` words inside candidates start."""
        run = np.concatenate(([0], np.cumsum(self.alive)))
        at = np.arange(len(self.alive))
        return np.flatnonzero(run[1:] > run[np.maximum(at - (self.length - size), 0)])

    def _names(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places of the parts, an order of them, where in it a new one begins, hash, least owner of each new one)."""
        at = self.parts(size)
        keys = windows(self.hashes, size, at)
        more = (windows(self.others, size, at),) if size == self.length and len(at) else ()
        order, new = distinct(keys, *more)
        return at, order, new, keys, self.ids[self.row[at]]

    def ask(self, size: int) -> pa.Table:
        at, order, new, keys, owner = self._names(size)
        first = np.flatnonzero(new)
        chunk = self.table["chunk"][0].as_py()
        if not len(first):
            return X.send(chunk, keys, np.empty(0, bool), self.n)
        owner = owner[order]
        least = np.minimum.reduceat(owner, first)
        if size < self.length:
            return X.send(chunk, keys[order][first], least != np.maximum.reduceat(owner, first), self.n, np.uint32)
        other = windows(self.others, size, at[order][first])
        return X.send(chunk, keys[order][first], np.stack((other.view(np.int64), least), axis=1), self.n)

    def narrow(self, size: int, replies: pa.Table) -> None:
        """Keep the candidates all of whose parts are held by several documents; at full length, by an earlier one."""
        at, order, new, keys, owner = self._names(size)
        first = np.flatnonzero(new)
        told = X.receive(replies, keys[order][first], self.n, bool)
        held = np.zeros(len(self.alive) + 1, np.int64)
        which = np.cumsum(new) - 1
        if size < self.length:
            held[at[order]] = told[which]
        elif len(first):
            least = np.minimum.reduceat(owner[order], first)
            held[at[order]] = told[which] | (least[which] < owner[order])
        run = np.concatenate(([0], np.cumsum(held)))
        spot = np.flatnonzero(self.alive)
        reach = self.length - size + 1
        self.alive[spot] = run[spot + reach] - run[spot] == reach


def dedup(df: DataFrame, length: int = 13, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), whole: bool = False, first: int = FIRST_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, carried): `kept` has the words left, joined by one space.

    A word goes if a window of `length` words that covers it also starts in a document with a
    smaller id. Words are runs of bytes other than ASCII white space. A null text has no words and
    gives an empty `kept`; a null id counts as the least; rows that share an id aren't smaller than
    one another, so none removes the other's words. An empty table gives none. Of other columns
    only those named in `carry` are read; they come back as a struct, `carried`, whatever their
    names (without any there is no such column). With `whole` the text comes back as well, as it
    was, in a column of that name. Windows shorter than `length` are compared by
    hashes, which only narrows the search; those removed by two independent hashes, 128 bits.
    Memory goes by chunks of about 4 MB of stored input; a text of N bytes takes some 50 N bytes.
    """
    if length < 2:
        raise ValueError("length must be at least 2")
    chunks = X.ways(df)
    n = X.ranges(df, chunks)
    docs = X.chunked(df, chunks, key, text, *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []))
    sizes = levels(length, first)

    def narrowed(table: pa.Table, replies: pa.Table | None, upto: int) -> _Candidates:
        found = _Candidates(table, length, n, upto >= len(sizes) - 1)
        for k in range(upto):
            found.narrow(sizes[k], replies.filter(pc.equal(replies["level"], k)))
        return found

    def question(k: int):
        if k == 0:
            return lambda table: narrowed(table, None, 0).ask(sizes[0])
        return lambda table, replies: narrowed(table, replies, k).ask(sizes[k])

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        hit = narrowed(table, replies, len(sizes)).alive
        cover = np.zeros(len(hit) + 1, np.int64)
        spot = np.flatnonzero(hit)
        np.add.at(cover, spot, 1)
        np.add.at(cover, spot + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        n_words, n_removed, kept, done = [], [], [], 0
        for _, _, buf, offsets in table_batches(table, "text"):
            _, _, at = words(buf, offsets)
            mine = gone[done : done + int(at[-1])]
            done += len(mine)
            removed = np.concatenate(([0], np.cumsum(mine)))[at]
            raw = buf.tobytes()
            for i, total in enumerate(np.diff(at).tolist()):
                less = int(removed[i + 1] - removed[i])
                n_words.append(total)
                n_removed.append(less)
                parts = raw[offsets[i] : offsets[i + 1]].split()
                if less:
                    parts = [w for w, x in zip(parts, mine[at[i] : at[i + 1]].tolist(), strict=True) if not x]
                kept.append(b" ".join(parts))
        own = {"doc_id": table["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())}
        return pa.table(own | ({"carried": table["carried"]} if carry else {}) | ({"whole": table["text"].cast(pa.string())} if whole else {}))

    replies = None
    for k, size in enumerate(sizes):
        answer = X.elsewhere_first if size == length else X.halves_in_several
        told = X.ask(docs, question(k), answer, replies).withColumn("level", F.lit(k))
        replies = told if replies is None else replies.unionByName(told)
    extra = f", carried {docs.schema['carried'].dataType.simpleString()}" if carry else ""
    extra += ", whole string" if whole else ""
    return X.tell(docs, replies, cut, "doc_id long, n_words long, n_removed long, kept string" + extra)
