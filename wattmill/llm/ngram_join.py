"""N-gram Jaccard join: sets of word n-grams, ordered globally, meet in prefix trees.

1. Texts that are equal stand for one. Each other set sends the first three tenths of its n-grams
   by hash; a set with a partner must share a stated part of them with some other set, so most
   sets end here, whatever line or passage is frequent.
2. What is left is ordered by (documents that hold it, hash), rarest first. N-grams of one set
   alone only lower the bounds. Sets meet if they share an n-gram of their prefixes; each set is
   tied to one other per n-gram, and ties chain into families. All partners are in one family.
3. A family's sets go into a trie, commonest n-gram first. Each set walks it once: overlap counts
   are shared along common beginnings, and a subtree is left when the overlap still possible is
   too small or all of it is linked to the set already.
4. A large family is dealt into blocks, each with a trie of its own and with a few pivots, the sets
   with the fewest n-grams of their own, which every block gets. What links to a pivot is one
   component, across blocks. Only sets outside of the family's largest component meet further
   blocks, and there only those sets that share an n-gram of their prefixes with one of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _exchange as X
from ._plan import Shared, connected_components
from ._text import lower, mix, slice_hashes, table_batches, windows, words

BLOCK_GRAMS = 1 << 15  # n-grams in a block of a large family
MEET_GRAMS = 1 << 18  # n-grams on each side where sets that no pivot reached meet others
PIVOTS = 4
SALTS = 64  # parts in which a family's sets look up its size
_SETS = "doc_id long, rep long, n long, grams binary"


def _sets(table: pa.Table, size: int):
    """(row, distinct n-grams as rows of two independent hashes, ascending) of every text."""
    for first, _, buf, offsets in table_batches(table, "text"):
        buf = lower(buf)
        starts, ends, at = words(buf, offsets)
        hashes = [slice_hashes(buf, starts, ends, seed) for seed in (0, 1)]
        runs = [windows(h, size) for h in hashes]
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if b - a >= size:
                grams = [r[a : b - size + 1] for r in runs]
                order = np.argsort(grams[0])
                x, y = (g[order] for g in grams)
                same = x[1:] == x[:-1]
                if (same & (y[1:] != y[:-1])).any():  # one hash, two n-grams
                    order = np.lexsort((y, x))
                    x, y = x[order], y[order]
                    same = (x[1:] == x[:-1]) & (y[1:] == y[:-1])
                new = np.concatenate(([True], ~same))
                yield first + i, np.stack((x[new], y[new]), axis=1)
            elif b > a:
                yield first + i, np.stack([mix(windows(h[a:b], b - a) ^ np.uint64(b - a)) for h in hashes], axis=1)
            else:
                yield first + i, np.empty((0, 2), np.uint64)


def _packed(grams: np.ndarray) -> bytes:
    """The first hash of each n-gram, and half of the second: 96 bits."""
    return grams[:, 0].tobytes() + grams[:, 1].astype(np.uint32).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    n = len(raw) // 12
    return np.stack((np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.uint32, n, 8 * n).astype(np.uint64)), axis=1)


def _needed(n: np.ndarray | int, num: int, den: int):
    """The least overlap of a set of n with any partner: |x & y| >= t |x|."""
    return -(-n * num // den)


def _part(n: int, num: int, den: int) -> int:
    """How many n-grams a set of n must share, of the part that it sends: one more than a tenth."""
    return n * (den - num) // (2 * den) + 1


def _prefix(n: int, num: int, den: int) -> int:
    return min(n, n - _needed(n, num, den) + _part(n, num, den))


class _Trie:
    """A compact prefix tree over rows of n-gram numbers; nodes carry bounds of what lies below."""

    def __init__(self, rows: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(rows)), key=lambda i: rows[i].tolist())
        self.segments, self.children, self.own = [], [], []
        self.least_size, self.most_length, self.low, self.high = [], [], [], []
        self.order = order
        self._build(rows, sizes, order)

    def _node(self, segment: np.ndarray) -> int:
        self.segments.append(segment)
        self.children.append([])
        self.own.append([])
        return len(self.segments) - 1

    def _build(self, rows, sizes, order) -> None:
        root = self._node(np.empty(0, np.int64))
        path, depth = [root], [0]  # nodes on the last row's path and the depth where each ends
        last = np.empty(0, np.int64)
        for i in order:
            row = rows[i]
            m = min(len(last), len(row))
            differ = np.flatnonzero(last[:m] != row[:m])
            same = int(differ[0]) if len(differ) else m
            while depth[-1] > same:
                node, end = path.pop(), depth.pop()
                if depth[-1] < same:  # split: the node keeps its tail below a new head
                    head = self._node(self.segments[node][: same - depth[-1]])
                    self.segments[node] = self.segments[node][len(self.segments[node]) - (end - same) :]
                    kids = self.children[path[-1]]
                    kids[kids.index(node)] = head
                    self.children[head].append(node)
                    path.append(head)
                    depth.append(same)
            if len(row) > same:
                leaf = self._node(row[same:])
                self.children[path[-1]].append(leaf)
                path.append(leaf)
                depth.append(len(row))
            self.own[path[-1]].append(i)
            last = row
        n = len(self.segments)
        self.least_size, self.most_length = [0] * n, [0] * n
        lengths = [len(r) for r in rows]
        stack, seen = [root], []
        while stack:
            x = stack.pop()
            seen.append(x)
            stack.extend(self.children[x])
        self.members: list[list[int]] = [[] for _ in range(n)]
        for x in reversed(seen):
            kids = self.children[x]
            self.least_size[x] = min([int(sizes[i]) for i in self.own[x]] + [self.least_size[k] for k in kids])
            self.most_length[x] = max([lengths[i] for i in self.own[x]] + [self.most_length[k] for k in kids])
            self.members[x] = self.own[x][:1] + [self.members[k][0] for k in kids]
        self.root, self.upward = root, seen[::-1]


def trie_links(rows: list[np.ndarray], sizes: np.ndarray, num: int = 80, den: int = 100) -> np.ndarray:
    """For each row the first row of its linked group: rows link if overlap / union >= num / den.

    rows: ascending numbers; sizes: full set sizes (numbers that no other row holds may be absent
    from rows). Rows too short for a link even with the smallest set stay out of the trie.
    """
    lengths = np.array([len(r) for r in rows])
    fit = np.flatnonzero((num + den) * lengths >= num * (sizes + (sizes.min() if len(sizes) else 0)))
    root = np.arange(len(rows))
    if len(fit) < len(rows):
        if len(fit):
            root[fit] = fit[trie_links([rows[i] for i in fit], sizes[fit], num, den)]
        return root
    n = len(rows)
    if not n:
        return root
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    trie = _Trie(rows, sizes)
    one = [False] * len(trie.segments)  # whether all below is linked together
    held = np.zeros(int(max((r[-1] for r in rows if len(r)), default=0)) + 1, bool)
    both = num + den
    # the most connected first: sets with few n-grams of their own link most others early
    for turn, i in enumerate(np.lexsort((np.arange(n), sizes - lengths)).tolist()):
        if turn & (turn - 1) == 0:  # at powers of two, see again which subtrees are linked throughout
            for x in trie.upward:
                one[x] = all(one[k] for k in trie.children[x]) and len({find(j) for j in (*trie.own[x], *trie.members[x])}) <= 1
        row, size = rows[i], int(sizes[i])
        held[row] = True
        most = len(row)
        stack = [(trie.root, 0, 0)]
        while stack:
            x, overlap, depth = stack.pop()
            least = trie.least_size[x]
            if both * min(overlap + trie.most_length[x] - depth, most) < num * (size + least):
                continue
            if one[x] and find(trie.members[x][0]) == find(i):
                continue
            segment = trie.segments[x]
            if len(segment):
                overlap += int(np.count_nonzero(held[segment]))
                depth += len(segment)
                rest = most - int(np.searchsorted(row, segment[-1], "right"))
                if both * (overlap + min(rest, trie.most_length[x] - depth)) < num * (size + least):
                    continue
            for j in trie.own[x]:
                if j != i and both * overlap >= num * (size + int(sizes[j])):
                    a, b = find(i), find(j)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
            stack.extend((k, overlap, depth) for k in trie.children[x])
        held[row] = False
    return np.array([find(i) for i in range(n)])


def _family_links(table: pa.Table, num: int, den: int) -> tuple[list[int], list[int]]:
    """(id, least linked id) for the members of one family, of a block of it, or of two parts that meet."""
    ids, at = np.unique(table["doc_id"].to_numpy(), return_index=True)  # a pivot may come twice
    table = table.take(pa.array(at))
    parts = [_unpacked(x) for x in table["grams"].to_pylist()]
    # numbers in the trie: commonest first, i.e. the reverse of (holders, hash), as each row is stored
    flat = np.concatenate(parts)
    held = np.concatenate([np.frombuffer(x, np.uint16) for x in table["holders"].to_pylist()]).astype(np.int64)
    order = np.lexsort((flat[:, 1], flat[:, 0], -held))
    new = np.ones(len(order), bool)
    new[1:] = (flat[order][1:] != flat[order][:-1]).any(axis=1)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    cuts = np.cumsum([0, *map(len, parts)])
    rows = [np.sort(number[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    root = trie_links(rows, table["n"].to_numpy(), num, den)
    return ids.tolist(), ids[root].tolist()


def join(df: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Two rows link when 100 * |x & y| >= percent * |x | y| over their sets of lower-cased (A-Z) word
    `size`-grams; fewer words make one gram of all. component_id is the least id reachable. Rows
    without words or text have no grams and link with nothing. Ids are taken as distinct; rows that
    share an id are one node. A null id is a node like another (as the least long). An empty
    table gives none; other columns aren't read. Grams are compared by two independent hashes, 96
    bits; a single one only narrows the search. A chunk's texts go about a megabyte of whole texts
    at a time; a text of N bytes takes some 60 N bytes.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    num, den = percent, 100
    spark = df.sparkSession
    shared = Shared(spark)
    chunks = X.ways(df)
    n = X.ranges(df, chunks)
    node = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    # equal texts: narrow rows only; the minimum is aggregated before the join back
    marks = df.select(node.alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("mark"), X.chunk_of(key, text, chunks).alias("chunk"))
    groups = marks.groupBy("mark").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_c")).filter("_c > 1").drop("_c")
    groups = shared.table(groups)  # so that the join back sees two plain sides, whose hot marks it can split
    copies = marks.join(groups, "mark").filter("doc_id != rep")
    docs = X.chunked(df, chunks, key, text)
    told = copies.select("chunk", F.lit(-1).cast("long").alias("p"), F.col("doc_id").alias("id"), "rep", F.unhex("mark").alias("reply"))

    def sent_part(table: pa.Table, notes: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
        mine = notes.filter(pc.equal(notes["p"], -1))
        ids = X.order_ids(table).tolist()
        # by id and text: rows that share an id may differ in text
        rep = dict(zip(zip(mine["id"].to_pylist(), mine["reply"].to_pylist(), strict=True), mine["rep"].to_pylist(), strict=True))
        noted = {x for x, _ in rep}

        def stands(i: int) -> int:
            if ids[i] not in noted:
                return ids[i]
            return rep.get((ids[i], hashlib.sha256(table["text"][i].as_py() or b"").digest()), ids[i])

        sets = [(i, stands(i), g) for i, g in _sets(table, size)]
        parts = [g[: _prefix(len(g), num, den) if r == ids[i] else 0, 0] for i, r, g in sets]
        flat = np.concatenate([np.empty(0, np.uint64), *parts])
        keys, count = np.unique(flat, return_counts=True)
        return keys, count > 1, [(i, r, g, p) for (i, r, g), p in zip(sets, parts, strict=True)]

    def ask_part(table: pa.Table, notes: pa.Table) -> pa.Table:
        keys, several, _ = sent_part(table, notes)
        return X.send(table["chunk"][0].as_py(), keys, several, n)

    def keep(table: pa.Table, notes: pa.Table) -> pa.Table:
        keys, _, sets = sent_part(table, notes)
        seen = X.receive(notes.filter(pc.greater_equal(notes["p"], 0)), keys, n, bool)
        ids = X.order_ids(table).tolist()
        out = [(ids[i], r, len(g), g, p) for i, r, g, p in sets]
        held = []
        for doc, r, m, g, p in out:
            few = _part(_needed(m, num, den), num, den)
            held.append(_packed(g) if r == doc and m and np.count_nonzero(seen[np.searchsorted(keys, p)]) >= few else None)
        cols = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
        return pa.table([*cols, pa.array(held, pa.binary())], ["doc_id", "rep", "n", "grams"])

    replies = X.ask(docs, ask_part, X.in_several, told)
    notes = told.unionByName(replies, allowMissingColumns=True)
    every = shared.table(X.tell(docs, notes, keep, _SETS))

    # exact counts among what is left, and the order by them
    left = every.filter("grams is not null")
    pieces = X.ways(left)
    m = X.ranges(left, pieces)
    parts = left.select(F.pmod(F.xxhash64("doc_id", "grams", F.lit("left")), F.lit(pieces)).cast("long").alias("chunk"), "doc_id", "n", "grams")

    def tally(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        sets = [_unpacked(x) for x in table["grams"].to_pylist()]
        keys, count = np.unique(np.concatenate(sets)[:, 0], return_counts=True)
        return keys, np.minimum(count, 65535).astype(np.uint16), sets

    def ask_counts(table: pa.Table) -> pa.Table:
        keys, count, _ = tally(table)
        return X.send(table["chunk"][0].as_py(), keys, count, m)

    def order(table: pa.Table, replies: pa.Table) -> pa.Table:
        keys, _, sets = tally(table)
        total = X.receive(replies, keys, m, np.uint16)
        rows = {"doc_id": [], "n": [], "grams": [], "holders": [], "prefix": []}
        for doc, size_, g in zip(table["doc_id"].to_pylist(), table["n"].to_pylist(), sets, strict=True):
            held = total[np.searchsorted(keys, g[:, 0])]
            g, held = g[held > 1], held[held > 1]
            need = _needed(size_, num, den)
            if len(g) < need:
                continue
            rank = np.lexsort((g[:, 1], g[:, 0], held))
            g, held = g[rank], held[rank]
            rows["doc_id"].append(doc)
            rows["n"].append(size_)
            rows["grams"].append(_packed(g))
            rows["holders"].append(held.tobytes())
            rows["prefix"].append(g[: len(g) - need + 1, 0].astype(np.int64))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds, strict=True)})

    counts = X.ask(parts, ask_counts, X.holders)
    ready = shared.table(X.tell(parts, counts, order, "doc_id long, n long, grams binary, holders binary, prefix array<long>"))
    ties = ready.select("doc_id", F.explode("prefix").alias("gram"))
    heads = ties.groupBy("gram").agg(F.min("doc_id").alias("head"), F.count("*").alias("_c")).filter("_c > 1").drop("_c")
    near = ties.join(heads, "gram").filter("doc_id != head").select(F.col("doc_id").alias("u"), F.col("head").alias("v")).distinct()
    family = connected_components(near, shared).withColumnRenamed("component", "family")

    # families, whole or in blocks
    family = family.withColumnRenamed("node", "doc_id")
    grams = F.octet_length("holders") / 2
    weights = ready.select("doc_id", grams.alias("w")).join(family, "doc_id").groupBy("family").agg(F.sum("w").alias("w"))
    large = weights.filter(F.col("w") > BLOCK_GRAMS).select("family", F.ceil(F.col("w") / BLOCK_GRAMS).cast("int").alias("blocks"))
    large = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = ready.join(family, "doc_id").withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)).cast("int"))
    members = salted.join(large, ["family", "salt"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).drop("salt")
    members = shared.table(members)
    shared.drop(ready)
    sets = ("doc_id", "n", "grams", "holders")

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("family")
        fams = table["family"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(fams)) + 1).tolist(), len(fams)]
        u, v, whole = [], [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            got = _family_links(table.slice(a, b - a), num, den)
            u += got[0]
            v += got[1]
            whole += [table["blocks"][a].as_py() == 1] * len(got[0])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "whole": pa.array(whole, pa.bool_())})

    def linked(placed: DataFrame, *by: str) -> DataFrame:
        return shared.table(placed.groupBy(*by).applyInArrow(link, "u long, v long, whole boolean"))

    placed = members.select(*sets, "family", "blocks", F.pmod(F.xxhash64("doc_id", F.lit("block")), F.col("blocks")).cast("int").alias("b"))
    lot = F.pmod(F.xxhash64("doc_id", F.lit("pivot")), F.lit(PIVOTS))
    pivots = placed.filter("blocks > 1").groupBy("family", "blocks", lot.alias("lot")).agg(F.min_by(F.struct(*sets), F.struct(F.col("n") - grams, "doc_id")).alias("s"))
    pivots = pivots.select("s.*", "family", "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    bundle = F.when(F.col("blocks") > 1, F.col("family")).otherwise(-1 - F.pmod(F.xxhash64("family"), F.lit(m * 4)))
    links = linked(placed.unionByName(pivots).withColumn("bundle", bundle), "bundle", "b")
    label = links.filter("whole and u != v").select(F.col("u").alias("rep"), F.col("v").alias("component"))
    parted = links.filter("not whole").select("u", "v")
    if not parted.isEmpty():
        # sets outside of a family's largest component, and those that share an n-gram of the prefixes with one of them
        near = shared.table(connected_components(parted, shared))
        large = members.filter("blocks > 1").select("doc_id", "family", "prefix", grams.alias("w"))
        large = large.join(near.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        main = large.groupBy("family", "component").agg(F.count("*").alias("c")).groupBy("family").agg(F.max_by("component", F.struct("c", "component")).alias("main"))
        large = large.join(main, "family")
        rest = shared.table(large.filter("component != main").select("doc_id", "family", "prefix", "w"))
        if not rest.isEmpty():
            asked = rest.select("family", F.explode("prefix").alias("gram")).distinct()
            other = large.select("doc_id", "family", "w", F.explode("prefix").alias("gram")).join(asked, ["family", "gram"], "left_semi")
            other = shared.table(other.select("doc_id", "family", "w").distinct())
            sides = [x.groupBy("family").agg(F.ceil(F.sum("w") / MEET_GRAMS).cast("int").alias(c)) for x, c in ((rest, "n_i"), (other, "n_j"))]
            counts = sides[0].join(sides[1], "family")
            deal = lambda c: F.pmod(F.xxhash64("doc_id", F.lit("meet")), F.col(c)).cast("int")
            every_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
            left_side = rest.join(counts, "family").select("doc_id", deal("n_i").alias("i"), every_of("n_j").alias("j"))
            right_side = other.join(counts, "family").select("doc_id", every_of("n_i").alias("i"), deal("n_j").alias("j"))
            meet = left_side.union(right_side).distinct().join(members.select(*sets, "family", "blocks"), "doc_id")
            parted = parted.union(linked(meet, "family", "i", "j").select("u", "v"))
        label = label.unionByName(connected_components(parted, shared).withColumnRenamed("node", "rep"))
        links = links.select("u", "v").union(parted)
    label = label.groupBy("rep").agg(F.min("component").alias("component"))
    at = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("rep"))
    out = every.select("doc_id", at.alias("rep"), "n")
    shares = out.groupBy("doc_id").agg(F.count("*").alias("_c")).filter("_c > 1").select("doc_id")
    if not shares.isEmpty():  # rows of one id tie what each of them links with
        rows = out.join(shares, "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
        every_link = links.select("u", "v").unionByName(rows).filter("u != v")
        label = connected_components(every_link, shared).withColumnRenamed("node", "rep")
    out = out.join(label, "rep", "left")
    where = F.coalesce("component", "rep")
    back = F.when(F.col("doc_id") == -(1 << 63), F.lit(None)).otherwise(F.col("doc_id"))
    return out.select(back.cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), where.alias("component_id"))
