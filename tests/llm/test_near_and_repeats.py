import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattmill.llm import _plan, ngram_join, substring, suffix_dedup

from . import brute

SCHEMA = "doc_id long, text string"


def near_copies():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 60))] for _ in range(10)]
    rows = []
    for i in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words) if rng.random() < 0.9 else "\n".join(words).upper()))
    return rows + [(400, None), (401, ""), (402, " \t"), (403, "a"), (404, "A"), (405, "a b"), (406, None), (407, "é É"), (408, "É É")]


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_components(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", block)
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute.components(rows)


def test_components_of_odd_tables(spark):
    assert ngram_join.join(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([(None, "a b", 1), (1, "a b", 2), (2, "c", 3), (2, "c", 3)], SCHEMA + ", rep long")
    got = sorted(((r.doc_id, r.n_shingles) for r in ngram_join.join(rows).collect()), key=str)
    assert got == [(1, 1), (2, 1), (2, 1), (None, 1)]
    with pytest.raises(ValueError):
        ngram_join.join(rows, percent=40)


def test_components_of_ids_with_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b + " more"), (8, c + " more"), (9, c), (9, a), (11, c), (11, "other"), (11, "")]
    got = {(r.doc_id, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, 3) for i in (3, 5, 7, 8, 9, 11)}


def test_trie_against_pairs():
    rng = np.random.default_rng(0)
    for _ in range(120):
        base = np.sort(rng.choice(60, 30, replace=False))
        rows = []
        for _ in range(rng.integers(1, 25)):
            b = base if rng.random() < 0.7 else np.sort(rng.choice(60, 30, replace=False))
            kept = np.setdiff1d(b, rng.choice(b, rng.integers(0, 8), replace=False))
            rows.append(np.union1d(kept, rng.choice(60, rng.integers(0, 6), replace=False)) if rng.random() < 0.95 else kept[:0])
        sizes = np.array([len(r) + rng.integers(0, 4) for r in rows])
        parent = list(range(len(rows)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(rows)):
            for j in range(i):
                both = len(np.intersect1d(rows[i], rows[j]))
                if 100 * both >= 80 * (sizes[i] + sizes[j] - both):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
        assert ngram_join.trie_links(rows, sizes).tolist() == [find(i) for i in range(len(rows))]


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)]
    got = {r.node: r.component for r in _plan.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(5), _plan.Shared(spark)).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def passages():
    rng = random.Random(3)
    shared = ["".join(rng.choice("abcdefgh é") for _ in range(260)) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [rng.choice(shared)[rng.randint(0, 120) :][: rng.randint(80, 260)] if rng.random() < 0.6 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 90))) for _ in range(rng.randint(0, 6))]
        text = "ab" * rng.randint(0, 200) if i % 17 == 0 else "x" * rng.randint(0, 300) if i % 19 == 0 else "".join(parts)
        rows.append((i, text))
    return rows + [(1000 + i, rows[i][1]) for i in range(12)] + [(2000, None), (2001, "")]


@pytest.mark.parametrize("hot", [1 << 16, 1])
def test_repeated_bytes(spark, hot):
    rows = passages()
    out = suffix_dedup.dedup(spark.createDataFrame(rows, SCHEMA), 100, hot_places=hot)
    got = {r.doc_id: r for r in out.collect()}
    for d, (n, removed, runs, digest) in brute.repeats(rows).items():
        r = got[d]
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans) // 2, brute.sha(bytes(r.kept))) == (n, removed, runs, digest)


def test_deep_shallow_sort():
    rng = random.Random(3)
    for _ in range(60):
        base = bytes(rng.choice(b"ab") for _ in range(300))
        raw = b"".join(base[rng.randint(0, 100) :][: rng.randint(50, 200)] + bytes([rng.choice(b"xyz")]) for _ in range(6))
        starts = np.arange(0, max(0, len(raw) - 100))
        order, group = suffix_dedup.deep_shallow_sort(np.frombuffer(raw, np.uint8), starts, 100)
        strings = [raw[starts[i] : starts[i] + 100] for i in order]
        assert strings == sorted(strings)
        assert all((group[i] == group[i - 1]) == (strings[i] == strings[i - 1]) for i in range(1, len(strings)))


def test_blind_trie():
    trie = suffix_dedup.BlindTrie()
    texts = [b"b", b"", b"abc", b"abd", b"abc", b"a"]
    for i, t in enumerate(texts):
        trie.add(t, i)
    assert trie.sorted() == [[1], [5], [2, 4], [3], [0]]


def test_repeats_of_odd_tables(spark):
    assert suffix_dedup.dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([(None, "q" * 150, 1), (1, "q" * 120, 2), (1, "z", 3)], SCHEMA + ", kept int")
    got = sorted((r.n_bytes, r.n_bytes - len(r.kept)) for r in suffix_dedup.dedup(rows).collect())
    assert got == [(1, 0), (120, 120), (150, 149)]
    with pytest.raises(ValueError):
        suffix_dedup.dedup(rows, 20)


def test_repeated_words(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(200)]
    bases = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(bases)[rng.randint(0, 30) :][: rng.randint(5, 40)] if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randint(1, 20))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(300, None), (301, ""), (302, "é " * 40)]
    out = substring.dedup(spark.createDataFrame(rows, SCHEMA), 13)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out.collect()} == brute.windows(rows)
    assert sum(r[1] for r in brute.windows(rows).values()) > 100


@pytest.mark.parametrize("hot", [1 << 16, 1])
def test_a_string_at_one_start_in_rows_of_one_id_is_earlier_in_neither(spark, hot):
    rng = random.Random(8)
    x, y, z = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (180, 150, 150))
    rows = [(7, x), (7, x), (7, x + y), (None, y), (None, y), (9, x), (7, z + x)]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, SCHEMA), 100, hot_places=hot).collect()
    spans = [(7, 180, []), (7, 180, []), (7, 330, [180, 330]), (7, 330, [150, 330]), (9, 180, [0, 180]), (None, 150, []), (None, 150, [])]
    assert sorted((str(r.doc_id), r.n_bytes, r.spans) for r in got) == sorted((str(d), n, s) for d, n, s in spans)


def test_words_of_odd_tables(spark):
    assert substring.dedup(spark.createDataFrame([], SCHEMA)).collect() == []
    text = " ".join(f"v{i}" for i in range(20))
    rows = spark.createDataFrame([(None, text, "a"), (5, text, "b"), (5, text, None), (6, "one two", "c")], SCHEMA + ", lang string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, str(r.carried.lang)) for r in substring.dedup(rows, 13, carry=("lang",)).collect())
    assert got == [("5", 20, 20, "None"), ("5", 20, 20, "b"), ("6", 2, 0, "c"), ("None", 20, 0, "a")]
    with pytest.raises(ValueError):
        substring.dedup(rows, 1)


@pytest.mark.parametrize("hot", [1 << 16, 1])
def test_each_read_of_a_chunk_gives_its_rows_in_another_order(spark, monkeypatch, hot):
    """As reads of a shuffle from several executors do."""

    def stirred(f, seed):
        stir = lambda table: table.take(np.random.default_rng(seed).permutation(table.num_rows))
        return (lambda table, notes: f(stir(table), notes)) if seed else lambda table: f(stir(table))

    ask, tell = suffix_dedup.X.ask, suffix_dedup.X.tell
    monkeypatch.setattr(suffix_dedup.X, "ask", lambda docs, f, answer, replies=None: ask(docs, stirred(f, int(replies is not None)), answer, replies))
    monkeypatch.setattr(suffix_dedup.X, "tell", lambda docs, replies, f, schema: tell(docs, replies, stirred(f, 2), schema))
    rows = passages()
    got = {r.doc_id: r for r in suffix_dedup.dedup(spark.createDataFrame(rows, SCHEMA), 100, hot_places=hot).collect()}
    assert {d: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans) // 2, brute.sha(bytes(r.kept))) for d, r in got.items()} == brute.repeats(rows)


def test_long_text(spark):
    text = " ".join(f"t{i % 5000}" for i in range(60_000))
    rows = [(1, text), (2, text + " end")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.n_removed for r in substring.dedup(df).collect()}
    assert got == {1: 0, 2: 60_000}
    got = {r.doc_id: r.n_shingles for r in ngram_join.join(df).collect()}
    assert got[1] == 5000 and got[2] == 5001
    kept = {r.doc_id: len(r.kept) for r in suffix_dedup.dedup(df).select("doc_id", "kept").collect()}
    assert kept[2] <= 104 and F is not None


def test_texts_that_linear_hashes_confuse(spark):
    a, b = brute.thue_morse()
    rows = [(1, a), (2, b)]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect()} == brute.components(rows) == {1: (1, 1), 2: (1, 2)}
    head = " ".join(f"w{i}" for i in range(12))
    for x, y in ((a, b), (b, a)):
        rows = [(1, f"{head} {x}"), (2, f"{head} {y}"), (3, f"{head} {x}")]
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == brute.windows(rows) and got[2][1] == 0 and got[3][1] == 13


def test_a_second_hash_parts_what_the_first_confuses(spark):
    """With the first hash of words all but gone, links and removals stay right."""
    from wattmill.llm import _text

    strong = _text.slice_hashes
    weak = lambda buf, starts, ends, seed=0: strong(buf, starts, ends, seed) if seed else strong(buf, starts, ends) & np.uint64(3)
    rows = [(r, t) for r, t in near_copies() if t][:50]
    table = _chunk(rows)
    import pytest as _pytest

    with _pytest.MonkeyPatch.context() as m:
        m.setattr(ngram_join, "slice_hashes", weak)
        sizes = {rows[i][0]: len(g) for i, g in ngram_join._sets(table, 5)}
    assert sizes == {d: n for d, (n, _) in brute.components(rows).items()}


def _chunk(rows):
    import pyarrow as pa

    return pa.table({"chunk": pa.array([0] * len(rows), pa.int64()), "doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([None if t is None else t.encode() for _, t in rows], pa.binary())})


@pytest.mark.parametrize("length", [200, 1000])
def test_longer_strings(spark, length):
    rng = random.Random(length)
    base = "".join(rng.choice("abcdefgh") for _ in range(3 * length))
    rows = [(i, "".join(rng.choice("xyz") for _ in range(rng.randint(0, 50))) + base[rng.randint(0, length) :][: rng.randint(length // 2, 2 * length)]) for i in range(25)]
    rows += [(90, base * 2), (91, "q" * 3 * length), (92, None)]
    got = {r.doc_id: r for r in suffix_dedup.dedup(spark.createDataFrame(rows, SCHEMA), length).collect()}
    for d, (n, removed, runs, digest) in brute.repeats(rows, length).items():
        r = got[d]
        assert (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans) // 2, brute.sha(bytes(r.kept))) == (n, removed, runs, digest)


def test_the_sort_decides_what_is_equal(monkeypatch):
    """All runs of a chunk, and all suffixes of the distinct ones, go through the sort."""
    rows = [(i, t) for i, t in passages() if t]
    seen = []
    plain = suffix_dedup.deep_shallow_sort
    monkeypatch.setattr(suffix_dedup, "deep_shallow_sort", lambda buf, starts, *a, **k: seen.append(len(starts)) or plain(buf, starts, *a, **k))
    table = _chunk(rows)
    batches = list(suffix_dedup._scan(table, 100))
    keys, places = suffix_dedup._level_one(batches)
    found = suffix_dedup._Contexts(batches, table["doc_id"].to_numpy(), keys[places > 1], np.zeros((places > 1).sum(), bool), 100)
    assert seen == [len(found.kind)] and 0 < len(found.keys) < len(found.kind)
    sent = found.send(0, 1)
    suffix_dedup._sort_windows(sent, 100)
    assert seen[1] == len(found.keys) and seen[2] == int((found.size - 99).sum())


def test_levels_double():
    assert substring.levels(13) == [4, 8, 13] and substring.levels(13, 2) == [2, 4, 8, 13]
    assert substring.levels(2) == [2] and substring.levels(100, 3) == [3, 6, 12, 24, 48, 96, 100]


def test_each_level_asks_for_survivors_alone():
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(40)]
    rows = [(i, " ".join([f"a{i}_{rng.random()}" for _ in range(30)] + shared[i : i + 9 + i] + [f"b{i}_{rng.random()}" for _ in range(30)])) for i in range(8)]
    found = substring._Candidates(_chunk(rows), 13, 1)
    asked = []
    for size in substring.levels(13):
        sent = found.ask(size)
        asked.append(sum(len(x) for x in sent["keys"].to_pylist()) // (8 if size == 13 else 4))
        answer = substring.X.elsewhere_first if size == 13 else substring.X.halves_in_several
        found.narrow(size, answer(sent) if sent.num_rows else sent.select(["p"]).append_column("reply", sent["keys"]))
    plain = {tuple(t.split()[j : j + 13]) for _, t in rows for j in range(len(t.split()) - 12)}
    assert asked[0] > 400 and asked[1] < 40 and asked[2] <= asked[1] and found.alive.sum() == sum(1 for d, t in rows for j in range(len(t.split()) - 12) if tuple(t.split()[j : j + 13]) in plain and any(e < d and " ".join(t.split()[j : j + 13]) in u for e, u in rows))


def test_carried_columns_may_have_any_name(spark):
    rows = spark.createDataFrame([(1, "a b", 5, "x", 7)], SCHEMA + ", chunk int, kept string, n_words int")
    r = substring.dedup(rows, 13, carry=("chunk", "kept", "n_words", "doc_id"), whole=True).first()
    assert (r.carried.chunk, r.carried.kept, r.carried.n_words, r.carried.doc_id, r.whole) == (5, "x", 7, 1, "a b")


def test_pivots_and_meetings(spark, monkeypatch):
    """A family of two centres and a chain between them, in blocks of a few sets."""
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 400)
    monkeypatch.setattr(ngram_join, "MEET_GRAMS", 300)
    rng = random.Random(8)
    words = [f"v{i}" for i in range(200)]
    base, rows = words[:60], []
    for i in range(60):
        w = list(base)
        w[rng.randrange(60)] = f"own{i}"
        rows.append((i, " ".join(w)))
    now = list(base)
    for i in range(60, 90):  # each differs a little from the one before
        now = now[2:] + words[60 + 2 * (i - 60) : 62 + 2 * (i - 60)]
        rows.append((i, " ".join(now)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute.components(rows)
