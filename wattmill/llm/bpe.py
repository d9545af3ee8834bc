"""Byte-level BPE without regular expressions.

Pre-tokenisation works on arrays: every character gets a class, the class arrays become symbols of
a small automaton, and the automaton's transition functions are composed associatively, so blocks
of text are scanned side by side and then joined. The resulting slices are looked up in a table
of merged slices, whose bytes are compared with theirs; new ones are merged together, one
lowest-ranked pair of each at a time. Byte offsets of the slices are kept, and ids decode through
one gather of token bytes.
"""

from __future__ import annotations

import base64
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.int32(2**31 - 1)
_BLOCK = 128
_LONG = 64  # bytes from which a slice is merged alone, with a heap
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)

#: The code points that count as white space in the public pattern.
WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Contractions of the public pattern, by the letters after the apostrophe.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# Symbols: a class, with what must be seen ahead folded in.
S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_JOIN, S_LONE, S_SHORT1, S_SHORT2 = range(8)
# States: what the last character left open.
WHITES, JOIN, LETTERS, NUMBERS, OTHERS, LEFT1, LEFT2, ENDED = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a slice begins at this character."""
    if symbol == S_WHITE:  # more white space, or the end of the text, follows
        return WHITES, state != WHITES
    if symbol == S_JOIN:  # a space before something else, which it opens
        return JOIN, True
    if symbol == S_LONE:  # other white space before something else
        return ENDED, True
    if symbol == S_LETTER and state in (LEFT1, LEFT2):
        return (ENDED if state == LEFT1 else LEFT1), False
    run = {S_LETTER: LETTERS, S_NUMBER: NUMBERS}.get(symbol, OTHERS)
    if state in (run, JOIN):
        return run, False
    return {S_SHORT1: LEFT1, S_SHORT2: LEFT2}.get(symbol, run), True


def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(compose, functions, next, begins). Symbol + 8 is the symbol at the start of a text."""
    steps = [[_step(s, x) for s in range(8)] for x in range(8)] + [[_step(ENDED, x)] * 8 for x in range(8)]
    first = tuple(range(8))
    seen, todo, rows = {first: 0}, [first], {}
    while todo:
        f = todo.pop()
        rows[f] = []
        for x in range(16):
            g = tuple(steps[x][s][0] for s in f)
            if g not in seen:
                seen[g] = len(seen)
                todo.append(g)
            rows[f].append(g)
    order = sorted(seen, key=seen.get)
    compose = np.array([[seen[g] for g in rows[f]] for f in order], dtype=np.int16)
    nexts = np.array([[steps[x][s][0] for x in range(16)] for s in range(8)], dtype=np.int16)
    begins = np.array([[steps[x][s][1] for x in range(16)] for s in range(8)], dtype=bool)
    return compose, np.array(order, dtype=np.int16), nexts, begins


_COMPOSE, _FUNCTIONS, _NEXT, _BEGINS = _automaton()
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class of every code point."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            if kind in "LN":
                table[c] = LETTER if kind == "L" else NUMBER
        table[list(WHITE)] = SPACE
        _classes = table
    return _classes


def slices(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start bytes of all slices of texts `buf[offsets[i]:offsets[i + 1]]` (valid UTF-8), ascending."""
    n = len(buf)
    if n == 0:
        return np.empty(0, np.int64)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    byte = buf[lead]
    kinds = classes()
    cls = kinds[:128][byte & 0x7F]
    wide = np.flatnonzero(byte >= 0x80)
    if len(wide):
        at = lead[wide]
        b0 = buf[at].astype(np.int32)
        more = [np.where(at + k < n, buf[np.minimum(at + k, n - 1)], 0).astype(np.int32) & 0x3F for k in (1, 2, 3)]
        two, three = (b0 & 0x1F) << 6 | more[0], (b0 & 0x0F) << 12 | more[0] << 6 | more[1]
        four = (b0 & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2]
        cls[wide] = kinds[np.minimum(np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four)), 0x10FFFF)]
    m = len(lead)
    firsts = np.searchsorted(lead, offsets[:-1][np.diff(offsets) > 0])
    first = np.zeros(m + 1, bool)
    first[firsts] = True
    first[m] = True
    symbol = np.minimum(cls, S_WHITE)
    white = cls == SPACE
    opens = np.zeros(m, bool)  # the next character is there and isn't white space
    opens[:-1] = ~white[1:] & ~first[1:m]
    ends = np.flatnonzero(white & opens)
    symbol[ends] = np.where(byte[ends] == 32, S_JOIN, S_LONE)
    marks = np.flatnonzero(byte == 39)
    if len(marks):
        ahead = np.zeros((2, len(marks)), np.uint8)
        inside = ~first[np.minimum(marks + 1, m)]
        ahead[0, inside] = byte[np.minimum(marks + 1, m - 1)][inside]
        inside &= ~first[np.minimum(marks + 2, m)]
        ahead[1, inside] = byte[np.minimum(marks + 2, m - 1)][inside]
        symbol[marks[np.isin(ahead[0], [ord(c) for c in ONE_LETTER])]] = S_SHORT1
        for x, y in TWO_LETTERS:
            symbol[marks[(ahead[0] == ord(x)) & (ahead[1] == ord(y))]] = S_SHORT2
    symbol[first[:m]] += 8
    blocks = -(-m // _BLOCK)
    grid = np.zeros(blocks * _BLOCK, np.int16)
    grid[:m] = symbol
    grid = np.ascontiguousarray(grid.reshape(blocks, _BLOCK).T)
    whole, compose, step = np.zeros(blocks, np.int16), _COMPOSE.ravel(), _NEXT.ravel()
    for column in grid:  # the function of each block
        whole = compose[whole * 16 + column]
    state = np.empty(blocks, np.int16)
    now = ENDED
    for i, f in enumerate(_FUNCTIONS[whole].tolist()):  # joined from left to right
        state[i] = now
        now = f[now]
    begin, flags = np.empty((_BLOCK, blocks), bool), _BEGINS.ravel()
    for row, column in zip(begin, grid, strict=True):
        at = state * 16 + column
        row[:] = flags[at]
        state = step[at]
    return lead[np.flatnonzero(np.ascontiguousarray(begin.T).ravel()[:m])]


class Table:
    """An open-addressing table from nonzero 64-bit keys to row numbers, with array-wide operations."""

    def __init__(self, bits: int = 16):
        self.count = 0
        self._room(bits)

    def _room(self, bits: int) -> None:
        self.bits = bits
        self.keys, self.rows = np.zeros(1 << bits, _U), np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _BASE >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        out = np.full(len(keys), -1, np.int32)
        slot = self._slot(keys)
        held = self.keys[slot]
        out[:] = np.where(held == keys, self.rows[slot], -1)
        left = np.flatnonzero((held != keys) & (held != 0))
        mask = (1 << self.bits) - 1
        while len(left):
            slot[left] = at = (slot[left] + 1) & mask
            held, want = self.keys[at], keys[left]
            hit = held == want
            out[left[hit]] = self.rows[at[hit]]
            left = left[~hit & (held != 0)]
        return out

    def add(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Put in distinct keys that aren't there."""
        self.count += len(keys)
        if self.count * 2 > 1 << self.bits:
            old = self.keys != 0
            keys, rows = np.concatenate((self.keys[old], keys)), np.concatenate((self.rows[old], rows))
            self._room(max(self.bits + 1, int(self.count * 4).bit_length()))
        slot, mask = self._slot(keys), (1 << self.bits) - 1
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == 0
            put = left[free]
            self.keys[slot[put]] = keys[put]
            won = put[self.keys[slot[put]] == keys[put]]
            self.rows[slot[won]] = rows[won]
            done = np.zeros(len(keys), bool)
            done[won] = True
            left = left[~done[left]]
            slot[left] = (slot[left] + 1) & mask


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    return np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(buf) + 1,), (1,))


def slice_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each slice of `buf`; equal bytes give equal hashes wherever they stand.

    Up to seven bytes it is injective. Longer slices add up their lanes of eight bytes, each mixed
    with its place beforehand, so it isn't linear in the bytes. Hashes of two seeds are independent.
    """
    length = ends - starts
    at = lanes(buf)
    first = at[starts] & _MASKS[np.minimum(length, 8)]
    salt = _U(seed * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    out = mix(first ^ length.astype(_U) << _U(56) ^ salt)
    more = np.flatnonzero(length > 7)
    if len(more):
        extra = (length[more] + 7) // 8 - 1
        total = mix(first[more] + _BASE ^ salt)
        wide = np.flatnonzero(extra)
        if len(wide):
            where, n, whole = starts[more[wide]], extra[wide], length[more[wide]]
            step = spread(np.ones(len(n), np.int64), n)
            lane = at[np.repeat(where, n) + 8 * step] & _MASKS[np.minimum(np.repeat(whole, n) - 8 * step, 8)]
            lane = mix(mix(lane ^ salt) + step.astype(_U) * _BASE)
            total[wide] += np.add.reduceat(lane, np.cumsum(n) - n)
        out[more] = mix(total ^ length[more].astype(_U) * _BASE)
    return out


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all slices, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = starts.astype(np.int64)
    shift[1:] -= np.cumsum(lengths[:-1], dtype=np.int64)
    return np.arange(total, dtype=np.int64) + np.repeat(shift, lengths)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """`array`, or a longer copy that holds `size` items."""
    if size <= len(array):
        return array
    out = np.empty(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class Encoder:
    """Encodes and decodes many texts at a time by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], merges: list[tuple[int, int, int]] | None = None, cache_slices: int = 2_000_000):
        """merges: (left, right, merged) ids in order of rank; None: any two tokens whose bytes make a token, ranked by its id."""
        self.cache_slices = cache_slices
        by_id = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            by_id[i] = token
        self.token_lengths = np.array([len(x) for x in by_id], np.int64)
        self.token_starts = np.concatenate(([0], np.cumsum(self.token_lengths)[:-1]))
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        if merges is None:
            halves = ((ranks.get(t[:k]), ranks.get(t[k:]), i) for t, i in ranks.items() for k in range(1, len(t)))
            merges = [x for x in halves if x[0] is not None and x[1] is not None]
        elif any(x[2] >= y[2] for x, y in zip(merges, merges[1:], strict=False)):
            raise ValueError("ids of merged tokens must ascend with the rank of their merges")
        keys, made = [a << 32 | b for a, b, _ in merges], [i for _, _, i in merges]
        self.pairs = Table(2)
        self.pairs.add(np.array(keys, _U) + _U(1), np.array(made, np.int32))
        self.forget()

    @classmethod
    def load(cls, path: str) -> Encoder:
        """From a file of base64 tokens and ranks, or a JSON file with a vocabulary and merges."""
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                model = json.load(f)["model"]
            plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
            byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
            vocab = {k: v for k, v in model["vocab"].items() if all(c in byte for c in k)}
            pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
            ranks = {bytes(byte[c] for c in k): v for k, v in vocab.items()}
            return cls(ranks, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def forget(self) -> None:
        """Empty the table of merged slices."""
        self.known, self.pool = Table(), np.empty(1 << 16, np.int32)
        self.used, self.rows = 0, 0
        self.at, self.length = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)
        self.raw, self.raw_used = np.empty(1 << 16, np.uint8), 0
        self.raw_at, self.size = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = self.pairs.find((left.astype(_U) << _U(32) | right.astype(_U)) + _U(1))
        return np.where(found < 0, NONE, found)

    def _merge_long(self, raw: bytes) -> list[int]:
        """One slice, with a heap of pairs: lowest rank first, then leftmost."""
        ids = self.of_byte[np.frombuffer(raw, np.uint8)].tolist()
        n = len(ids)
        after, before, version = list(range(1, n + 1)), list(range(-1, n - 1)), [0] * n
        ranks = self._rank(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, 0, 0) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)

        def push(i):
            j = after[i]
            if j < n:
                (r,) = self._rank(np.array([ids[i]]), np.array([ids[j]]))
                if r != NONE:
                    heapq.heappush(heap, (int(r), i, version[i], version[j]))

        while heap:
            rank, i, vi, vj = heapq.heappop(heap)
            j = after[i]
            if version[i] != vi or j >= n or version[j] != vj or ids[i] < 0:
                continue
            ids[i], ids[j] = rank, -1
            version[i] += 1
            version[j] += 1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [x for x in ids if x >= 0]

    def _merge(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge many slices, given as byte ids one after another; each loses its leftmost pair of lowest rank in turn."""
        out_ids, out_rows, rows = [], [], np.arange(len(lengths))
        counts = np.zeros(len(lengths), np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        rank = np.full(len(ids), NONE, np.int32)
        last = starts + lengths - 1
        inner = np.ones(len(ids), bool)
        inner[last] = False
        where = np.flatnonzero(inner)
        rank[where] = self._rank(ids[where], ids[where + 1])
        while len(rows):
            low = np.minimum.reduceat(rank, starts)
            done = low == NONE
            of = np.repeat(np.arange(len(rows)), lengths)
            if done.any():
                gone = done[of]
                out_ids.append(ids[gone])
                out_rows.append(rows[of[gone]])
                counts[rows[done]] = lengths[done]
                keep = ~gone
                ids, rank, rows, lengths, low = ids[keep], rank[keep], rows[~done], lengths[~done], low[~done]
                if not len(rows):
                    break
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                of = np.repeat(np.arange(len(rows)), lengths)
            hits = np.flatnonzero(rank == low[of])
            owner = of[hits]
            hits = hits[np.concatenate(([True], owner[1:] != owner[:-1]))]  # the leftmost of each
            ids[hits] = low
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            spot = hits - np.arange(len(hits))  # where the merged ones stand after removal
            ids, rank, lengths = ids[keep], rank[keep], lengths - 1
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            last = starts + lengths - 1
            rank[spot] = NONE
            right = spot[spot < last]
            rank[right] = self._rank(ids[right], ids[right + 1])
            left = spot[spot > starts]
            rank[left - 1] = self._rank(ids[left - 1], ids[left])
        flat, of = np.concatenate(out_ids), np.concatenate(out_rows)
        order = np.argsort(of, kind="stable")
        return flat[order], counts

    def _merged(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Merge slices and keep their bytes and ids; the row numbers that they get."""
        short = lengths < _LONG
        parts, counts = [], np.zeros(len(starts), np.int64)
        if short.any():
            flat, n = self._merge(self.of_byte[buf[spread(starts[short], lengths[short])]], lengths[short])
            parts.append(flat)
            counts[short] = n
        for i in np.flatnonzero(~short):
            ids = self._merge_long(buf[starts[i] : starts[i] + lengths[i]].tobytes())
            parts.append(np.array(ids, np.int32))
            counts[i] = len(ids)
        order = np.concatenate((np.flatnonzero(short), np.flatnonzero(~short)))
        starts, lengths, counts = starts[order], lengths[order], counts[order]
        flat, raw = np.concatenate(parts), buf[spread(starts, lengths)]
        self.pool, self.raw = _room(self.pool, self.used + len(flat)), _room(self.raw, self.raw_used + len(raw))
        self.pool[self.used : self.used + len(flat)] = flat
        self.raw[self.raw_used : self.raw_used + len(raw)] = raw
        span = slice(self.rows, self.rows + len(order))
        for name, values in (("at", self.used + np.cumsum(counts) - counts), ("length", counts), ("raw_at", self.raw_used + np.cumsum(lengths) - lengths), ("size", lengths)):
            held = _room(getattr(self, name), span.stop)
            held[span] = values
            setattr(self, name, held)
        self.used, self.raw_used, self.rows = self.used + len(flat), self.raw_used + len(raw), span.stop
        rows = np.empty(len(order), np.int32)
        rows[order] = np.arange(span.start, span.stop)
        return rows

    def _others(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Which slices aren't, byte by byte, those of their rows: texts of one hash may differ."""
        bad = self.size[rows] != lengths
        long = np.flatnonzero(~bad & (lengths > 7))  # up to seven bytes and of one length, equal hashes are equal bytes
        if len(long):
            n = lengths[long]
            differ = self.raw[spread(self.raw_at[rows[long]], n)] != buf[spread(starts[long], n)]
            bad[long] = np.logical_or.reduceat(differ, np.cumsum(n) - n)
        return np.flatnonzero(bad)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts in them)."""
        starts = slices(buf, offsets)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(buf))
        sizes = ends - starts
        keys = np.maximum(slice_hashes(buf, starts, ends), _U(1))
        if self.rows > self.cache_slices or self.used + self.raw_used > 64 * self.cache_slices:
            self.forget()
        rows = self.known.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            names, first = np.unique(keys[new], return_index=True)
            self.known.add(names, self._merged(buf, starts[new[first]], sizes[new[first]]))
            rows[new] = self.known.find(keys[new])
        others = self._others(buf, starts, sizes, rows)
        if len(others):  # merged for this call alone; the table keeps the first text of a hash
            rows[others] = self._merged(buf, starts[others], sizes[others])
        lengths = self.length[rows].astype(np.int64)
        total = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.pool[spread(self.at[rows], lengths)]
        return ids, total[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, the offset of each id in them and the end)."""
        lengths = self.token_lengths[ids]
        return self.token_bytes[spread(self.token_starts[ids], lengths)], np.concatenate(([0], np.cumsum(lengths)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a file and process."""
    if path not in _encoders:
        _encoders[path] = Encoder.load(path)
    return _encoders[path]


def text_batches(batch: pa.RecordBatch, column: int, limit: int = 1 << 20):
    """(first row, end row, bytes, offsets) of a binary column, about `limit` bytes at a time; nulls are empty."""
    col = batch.column(column)
    if col.null_count:
        col = col.fill_null(b"")
    wide = pa.types.is_large_binary(col.type)
    raw = col.buffers()
    at = np.frombuffer(raw[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def _rows(df: DataFrame, path: str, key: str, text: str, outputs: tuple[str, ...]) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()

    def rows(batches):
        made = encoder(path)
        for batch in batches:
            for first, last, buf, offsets in text_batches(batch, 1):
                ids, at = made.encode(buf, offsets)
                back, where = made.decode(ids)
                packed, cuts = ids.astype("<u4").tobytes(), at.tolist()
                cols = {}
                if "ids" in outputs:
                    cols["ids"] = [packed[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
                if "ends" in outputs:
                    cols["ends"] = [(where[a + 1 : b + 1] - where[a]).astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                if "decoded" in outputs:
                    raw = back.tobytes()
                    cols["decoded"] = [raw[where[a] : where[b]] for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *[pa.array(cols[c], pa.binary()) for c in outputs]], ["doc_id", *outputs])

    return df.select(F.col(key).alias("doc_id"), F.col(text).cast("binary")).mapInArrow(rows, f"doc_id {kind}, " + ", ".join(f"{c} binary" for c in outputs))


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, ends): ids as little-endian unsigned 32-bit integers, and where each one's bytes end in the text.

    A null text counts as empty (no ids). Repeated rows and null keys pass through, an empty table
    gives none, other columns aren't read. Work goes by about a megabyte of whole texts, and what
    comes of a text must fit one Arrow array: texts of up to 2**28 bytes.
    """
    return _rows(df, path, key, text, ("ids", "ends"))


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the ids of `encode`, and the bytes that they decode to. Edge cases as there."""
    return _rows(df, path, key, text, ("ids", "decoded"))


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded) from ids as little-endian unsigned 32-bit integers.

    Null ids decode to nothing; null keys and repeated rows pass through, an empty table gives none,
    other columns aren't read.
    """
    kind = df.schema[key].dataType.simpleString()

    def rows(batches):
        made = encoder(path)
        for batch in batches:
            out = [made.decode(np.frombuffer(x or b"", "<u4").astype(np.int64))[0].tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return df.select(F.col(key).alias("doc_id"), ids).mapInArrow(rows, f"doc_id {kind}, decoded binary")
