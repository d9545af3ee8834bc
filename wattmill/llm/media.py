"""Media columns: ISO base media containers built, walked and read back in bytes.

Boxes are walked through their sizes and sample tables are decoded into byte ranges; codec,
duration and keyframes come from those tables, never from the payload. Python works on Arrow
batches, one container at a time, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 576  # bytes in a sample, and the block to which a payload is padded
KEY_EVERY = 8  # every so many samples one is a sync sample
PAD = 255
BATCH_BYTES = 2 << 20  # of containers that are held at once
CONTAINERS = frozenset((b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta"))
_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad(raw: bytes, block: int = SAMPLE) -> bytes:
    """`raw` and bytes 255 up to a positive multiple of `block`."""
    return raw + bytes([PAD]) * (max(block, -(-len(raw) // block) * block) - len(raw))


def build(payload: bytes, sample: int = SAMPLE, rate: int = 48_000, key_every: int = KEY_EVERY) -> bytes:
    """A container with one track of 8-bit samples (`raw `), in chunks of `key_every` samples of `sample` bytes."""
    n = len(payload) // sample
    duration = len(payload)
    chunks = -(-n // key_every)
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    entry = struct.pack(">6xH8xHHHHI", 1, 1, 8, 0, 0, rate << 16)
    runs = [(1, key_every)] if n % key_every == 0 else [(1, key_every), (chunks, n % key_every)] if chunks > 1 else [(1, n)]
    wide = len(payload) >= 1 << 31

    def moov(first: int) -> bytes:
        at = [first + i * key_every * sample for i in range(chunks)]
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), _box(b"raw ", entry)),
            _full(b"stts", struct.pack(">III", 1, n, sample)),
            _full(b"stss", struct.pack(">I", chunks), struct.pack(f">{chunks}I", *range(1, n + 1, key_every))),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", i, k, 1) for i, k in runs)),
            _full(b"stsz", struct.pack(">II", sample, n)),
            _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), struct.pack(f">{chunks}{'Q' if wide else 'I'}", *at)),
        )
        dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
        minf = _box(b"minf", _full(b"smhd", bytes(4)), dinf, stbl)
        mdhd = _full(b"mdhd", struct.pack(">QQIQHH", 0, 0, rate, duration, 0x55C4, 0), version=1)
        hdlr = _full(b"hdlr", bytes(4), b"soun", bytes(12), b"\0")
        mvhd = _full(b"mvhd", struct.pack(">QQIQIH10x", 0, 0, rate, duration, 0x10000, 0x100), _MATRIX, bytes(24), struct.pack(">I", 2), version=1)
        tkhd = _full(b"tkhd", struct.pack(">QQIIQ8xHHHH", 0, 0, 1, 0, duration, 0, 0, 0x100, 0), _MATRIX, bytes(8), version=1, flags=3)
        return _box(b"moov", mvhd, _box(b"trak", tkhd, _box(b"mdia", mdhd, hdlr, minf)))

    header = 8 if len(payload) + 8 < 1 << 32 else 16
    return b"".join((ftyp, moov(len(ftyp) + len(moov(0)) + header), _box(b"mdat", payload)))


def walk(data: bytes, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, body start, body end) of each box, parents first. A box that overruns its parent ends the walk."""
    end = len(data) if end is None else end
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                return
            (size,), head = struct.unpack_from(">Q", data, start + 8), 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            return
        yield (*path, kind), start + head, start + size
        if kind in CONTAINERS:
            yield from walk(data, start + head, start + size, (*path, kind))
        start += size


def _table(data: bytes, at: int, fields: int, code: str = "I") -> list[tuple[int, ...]]:
    (n,) = struct.unpack_from(">I", data, at + 4)
    flat = struct.unpack_from(f">{n * fields}{code}", data, at + 8)
    return list(zip(*[iter(flat)] * fields, strict=True))


def tracks(data: bytes) -> list[dict]:
    """For each track: codec, timescale, duration, and each sample's (offset, size, is_key), from tables alone."""
    out: list[dict] = []
    for path, at, _ in walk(data):
        kind = path[-1]
        if kind == b"trak":
            out.append({"codec": "", "timescale": 0, "duration": 0, "stsc": [], "chunks": [], "sizes": [], "keys": None})
        elif not out:
            continue
        elif kind == b"mdhd":
            wide = data[at] == 1
            out[-1]["timescale"], out[-1]["duration"] = struct.unpack_from(">IQ" if wide else ">II", data, at + (20 if wide else 12))
        elif kind == b"stsd":
            out[-1]["codec"] = data[at + 12 : at + 16].decode("latin-1")
        elif kind == b"stsc":
            out[-1]["stsc"] = _table(data, at, 3)
        elif kind in (b"stco", b"co64"):
            out[-1]["chunks"] = [x for (x,) in _table(data, at, 1, "Q" if kind == b"co64" else "I")]
        elif kind == b"stsz":
            fixed, n = struct.unpack_from(">II", data, at + 4)
            out[-1]["sizes"] = [fixed] * n if fixed else list(struct.unpack_from(f">{n}I", data, at + 12))
        elif kind == b"stss":
            out[-1]["keys"] = {x for (x,) in _table(data, at, 1)}
    for t in out:
        spans, i, run = [], 0, 0
        for c, offset in enumerate(t["chunks"], 1):
            while run + 1 < len(t["stsc"]) and t["stsc"][run + 1][0] <= c:
                run += 1
            for _ in range(t["stsc"][run][1]):
                if i == len(t["sizes"]):
                    break
                spans.append((offset, t["sizes"][i], t["keys"] is None or i + 1 in t["keys"]))
                offset += t["sizes"][i]
                i += 1
        t["samples"] = spans
    return out


def feature(track: dict) -> str:
    """codec, duration in units of the timescale, samples, and byte ranges (end exclusive) of keyframes."""
    keys = ",".join(f"{o}-{o + n}" for o, n, key in track["samples"] if key)
    return f"codec={track['codec'].strip()};timescale={track['timescale']};duration={track['duration']};samples={len(track['samples'])};keyframes={keys}"


def payload(data: bytes, track: dict) -> bytes:
    """A track's bytes, in sample order; neighbouring samples are read as one slice."""
    out, start, end = [], 0, 0
    for offset, n, _ in track["samples"]:
        if offset != end:
            out.append(data[start:end])
            start = offset
        end = offset + n
    return b"".join((*out, data[start:end]))


def media(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media, payload, feature): the container, what is read back from it, and what its tables tell.

    A null or empty text gives one block of padding. Equal texts give equal values; repeated rows
    and null keys pass through; an empty table gives none; other columns are not read. A container
    must fit one Arrow array, so texts have less than 2**31 bytes; shorter ones go some 2 MB at a time.
    """
    kind = df.schema[key].dataType.simpleString()

    def rows(batches):
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.string())
        for batch in batches:
            out, first, held = [], 0, 0
            for i, raw in enumerate(batch.column(1), 1):
                raw = raw.as_buffer().to_pybytes() if raw.is_valid else b""
                stored = build(pad(raw))
                (track,) = tracks(stored)
                out.append((len(raw), stored, payload(stored, track), feature(track)))
                held += len(stored)
                if held > BATCH_BYTES or i == batch.num_rows:
                    cols = [pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i - first), *cols], ["doc_id", "n_bytes", "media", "payload", "feature"])
                    out, first, held = [], i, 0

    return df.select(F.col(key).alias("doc_id"), F.col(text).cast("binary")).mapInArrow(rows, f"doc_id {kind}, n_bytes long, media binary, payload binary, feature string")


def probe(df: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """(doc_id, track, codec, timescale, duration, samples, keyframes): one row a track of stored containers.

    keyframes are (start, end) byte ranges. Bytes that aren't a container, nulls and an empty table
    give no rows; a box that overruns its parent ends the walk. Null keys and repeated rows pass
    through; other columns aren't read. Only boxes and tables are looked at, however long the payload.
    """
    kind = df.schema[key].dataType.simpleString()
    ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def rows(batches):
        for batch in batches:
            out = []
            for i, data in enumerate(batch.column(1).to_pylist()):
                for j, t in enumerate(tracks(data or b"")):
                    keys = [{"start": o, "end": o + n} for o, n, is_key in t["samples"] if is_key]
                    out.append((i, j, t["codec"].strip(), t["timescale"], t["duration"], len(t["samples"]), keys))
            where = batch.column(0).take(pa.array([x[0] for x in out], pa.int64()))
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), ranges)
            yield pa.RecordBatch.from_arrays([where, *[pa.array([x[k + 1] for x in out], t) for k, t in enumerate(kinds)]], ["doc_id", "track", "codec", "timescale", "duration", "samples", "keyframes"])

    return df.select(F.col(key).alias("doc_id"), media).mapInArrow(rows, f"doc_id {kind}, track int, codec string, timescale long, duration long, samples long, keyframes array<struct<start:long,end:long>>")
