"""The registered queries themselves, with their digest columns, against plain versions on one small folder."""

import base64
import hashlib
import math
import random
import struct
import zlib

import numpy as np
import pytest

from wattmill.llm import media, queries, toxicity
from wattmill.llm.bpe import slice_hashes

from . import brute

public = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(120)]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    out = []
    for i in range(70):
        parts = [rng.choice(passages)[rng.randint(0, 60) :] if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 4))]
        if i % 6 == 0:
            parts.insert(0, "vileword grimslur " * 3)
        if i % 5 == 0:
            parts.append(rng.choice(["mail a.b@c.de", "ip 10.0.0.7 x", "card 4111 1111 1111 1111", "tel +49 (30) 123-4567", "é🙂 x@y.zz 1.2.3.4"]))
        out.append("\n".join(parts))
    a, b = brute.thue_morse()
    return out + out[:9] + [None, "", "é", a, b, " ".join(f"t{i % 900}" for i in range(9000)), "x" * 5000, "It's  we'll\t\n 漢字 123"]


ROWS = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(_texts())]
TEXTS = {i: t or "" for i, t, *_ in ROWS}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int("vileword" in t)) for i, t in TEXTS.items() if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def _run(spark, folder, name):
    rows = queries.QUERIES[name](spark, folder).collect()
    return rows, {r.doc_id: r for r in rows}


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _one_hash(word: bytes) -> int:
    return int(slice_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def test_op1(spark, folder):
    _, got = _run(spark, folder, "op1_ngram_jaccard")
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute.components([(d, t) for d, t, *_ in ROWS])


def test_op2(spark, folder):
    rows, got = _run(spark, folder, "op2_toxicity")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    weight = dict(zip(model["features"].tolist(), model["weights"].tolist(), strict=True))
    assert weight and len(rows) == len(ROWS)
    for d, text in TEXTS.items():
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
        words = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b > 127 else 32 for b in low).split()
        count: dict[int, int] = {}
        for w in words:
            for h in (_one_hash(w), *[_one_hash(w[:k]) ^ k for k in toxicity.STEMS if len(w) > k]):
                count[h] = count.get(h, 0) + 1
        total = sum(weight[h] * math.sqrt(n / len(words)) for h, n in count.items() if h in weight)
        above = [1 - 1 / (1 + math.exp(-(c - total))) for c in model["cuts"]]
        steps = [1.0, *above, 0.0]
        grade = max(range(3), key=lambda g: steps[g] - steps[g + 1])
        assert abs(got[d].expected_severity - sum(above)) < 1e-9 and got[d].severity == grade and got[d].toxic == (above[0] >= queries.TOXIC_AT)
    found = {d for d, r in got.items() if r.toxic}
    assert found and found <= {d for d, t in TEXTS.items() if "vileword" in t}  # few labels: recall is tested on larger samples


def test_op3_and_op4(spark, folder):
    pairs = [(d, t) for d, t, *_ in ROWS]
    _, got = _run(spark, folder, "op3_suffix_array")
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == brute.repeats(pairs)
    _, got = _run(spark, folder, "op4_substring_dedup")
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in got.items()} == {d: (n, x, _sha(k.encode())) for d, (n, x, k) in brute.windows(pairs).items()}


def test_op6(spark, folder):
    _, got = _run(spark, folder, "op6_pii")
    for d, text in TEXTS.items():
        base, r = brute.personal(text), got[d]
        kinds = [s.split(":")[0] for s in base.split(",") if s]
        assert r.base_sha256 == _sha(base.encode()) and (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in ("email", "ip", "card", "phone"))
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert any(r.n_card for r in got.values()) and any(r.n_phone for r in got.values())


def test_op7(spark, folder):
    tiktoken = pytest.importorskip("tiktoken")
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    whole = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    _, got = _run(spark, folder, "op7_byte_bpe")
    for d, text in TEXTS.items():
        ids = np.array(whole.encode_ordinary(text), "<u4")
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (len(ids), _sha(ids.tobytes()), _sha(text.encode()))


def test_op8(spark, folder):
    rows, got = _run(spark, folder, "op8_jump_sharding")
    slots: dict[int, list[int]] = {}
    for d, text in TEXTS.items():
        r = got[d]
        assert (r.size, r.text_crc32, r.law, r.shard, r.grown_shard) == (len(text.encode()) + 16, zlib.crc32(text.encode()), "key", brute.jump(d, 40), brute.jump(d, 41))
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == len(ROWS) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def _boxes(data: bytes, path: str, inside=(b"moov", b"trak", b"mdia", b"minf", b"stbl")):
    """Bodies of boxes by slash-joined path, read without the module under test."""
    out, at = {}, 0
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + n]
        out[path + kind.decode()] = body
        if kind in inside:
            out |= _boxes(body, f"{path}{kind.decode()}/")
        at += n
    return out


def test_op9(spark, folder):
    _, got = _run(spark, folder, "op9_media_columns")
    stored = {r.doc_id: bytes(r.media) for r in media.media(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    for d, text in TEXTS.items():
        raw, r = text.encode(), got[d]
        want = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        tables = _boxes(stored[d], "")
        stbl = "moov/trak/mdia/minf/stbl/"
        size, n = struct.unpack(">II", tables[f"{stbl}stsz"][4:12])
        (chunks,) = struct.unpack(">I", tables[f"{stbl}stco"][4:8])
        starts = struct.unpack(f">{chunks}I", tables[f"{stbl}stco"][8:])
        back = b"".join(stored[d][a : a + size * min(8, n - 8 * i)] for i, a in enumerate(starts))
        assert back == want == tables["mdat"] and tables[f"{stbl}stsd"][12:16] == b"raw "
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(want), _sha(want), zlib.crc32(want[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(stored[d]), _sha(stored[d]))
        assert r.feature == f"codec=raw;timescale=48000;duration={len(want)};samples={n};keyframes=" + ",".join(f"{a}-{a + 576}" for a in starts)


def test_op10(spark, folder):
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows, _ = _run(spark, folder, "op10_packing")
    ids = {d: np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in TEXTS.items()}
    pieces = [(d, a, ids[d][a : a + 2048]) for d in ids for a in range(0, len(ids[d]), 2048)]
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == sorted((d, a, len(p), zlib.crc32(p.tobytes()), len(ids[d])) for d, a, p in pieces)
    room: list[int] = []  # best fit, longest first, by plain search
    for n in sorted((len(p) for _, _, p in pieces), reverse=True):
        fits = [(left, i) for i, left in enumerate(room) if left >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(2048 - n)
    used: dict[int, list] = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all([o for o, _ in sorted(s)] == np.cumsum([0, *[n for _, n in sorted(s)]])[:-1].tolist() for s in used.values())
    assert sorted(2048 - sum(n for _, n in s) for s in used.values()) == sorted(room)


def test_sql_gives_the_same_rows(spark, folder):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    for name in sorted(set(queries.ORACLE_SQL) - {"op5_topk"}):
        got = queries.QUERIES[name](spark, folder)
        want = con.execute(queries.ORACLE_SQL[name])
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(got.columns), name
        assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall()), name


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in queries.QUERIES:
        if name != "op5_topk":
            assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []
