import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattmill.llm import _plan, pii, topk, toxicity

from . import brute

SCHEMA = "doc_id long, text string"


def plain_search(vectors, k=5):
    out = {}
    for q, w in vectors:
        if q is None or q % 50 or w is None:
            continue
        scored = sorted((-sum(a * b for a, b in zip(w, v, strict=False)), r) for r, v in vectors if r is not None and r != q and v is not None)
        out[q] = [(i + 1, r, -s) for i, (s, r) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("blocks", [(16384, 1024), (7, 2)])
def test_search(spark, blocks):
    rng = random.Random(1)
    base = [[rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(6)] for _ in range(40)]
    rows = [(i, list(rng.choice(base)) if i % 3 else [rng.uniform(-1, 1) for _ in range(rng.randint(0, 7))]) for i in range(160)]
    rows += [(200, None), (250, [1.0, None]), (300, [1.0, float("nan")]), (350, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.quantise(F.col("embedding")).alias("weights"))
    ints = [(r.vec_id, r.weights) for r in df.collect()]
    assert [i for i, w in ints if w is None] == [200, 250, 300, 350]
    out = topk.search(df.filter("vec_id % 50 = 0"), df, 5, block_rows=blocks[0], block_queries=blocks[1])
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == plain_search(ints)


def test_search_of_few(spark):
    df = spark.createDataFrame([(0, [1]), (50, [2])], "vec_id long, weights array<long>")
    assert sorted(tuple(r) for r in topk.search(df, df, 5).collect()) == [(0, 1, 50, 2), (50, 1, 0, 2)]
    assert topk.search(df.limit(0), df, 5).collect() == []


def test_personal_data(spark):
    rows = [
        (1, "call me: id A1234 id A1235 x@y.zz id B99 id x1@y.zz"), (2, None), (3, ""), (4, "+1 (555) 010-9999 4111 1111 1111 1111 1.2.3.4 999.1.1.1 1.2.3.4.5 0255.1.1.1"),
        (5, "é🙂 a.b@c.d.e🙂 192.168.0.255é"), (6, "1" * 30), (7, "9" * 3000 + " " + "1-" * 3000 + "1"), (8, "a@b.c@d.e_x@y.z"), (9, "4111-1111-1111-1111"), (None, "x@y.z"), (1, "x@y.z"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("spans", F.lit("clash"))
    out = pii.extract(df).select("text", pii.spell(F.col("base_spans")).alias("base"), pii.spell(F.col("spans")).alias("every"))
    for r in out.collect():
        assert r.base == brute.personal(r.text) and set(filter(None, r.base.split(","))) <= set(r.every.split(","))
    assert pii.extract(spark.createDataFrame([], SCHEMA)).collect() == []
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_contexts_discover_more(spark):
    rows = [(i, f"write to: user{i}@mail.com today") for i in range(9)] + [(50, "write to: user77@mail today"), (51, "see user78@mail today")]
    got = {r.doc_id: r.s for r in pii.extract(spark.createDataFrame(rows, SCHEMA)).select("doc_id", pii.spell(F.col("spans")).alias("s")).collect()}
    assert got[0] == "email:10:24" and got[51] == ""
    edges = [("to a9@a.a", f"e{i}", "email") for i in range(9)] + [("to a9@a.a", "new", None), ("by a9@a.a", "new", None), ("by a9@a.a", "e1", None), ("by a9@a.a", "e2", None)]
    found = pii.induce(spark.createDataFrame(edges, "pattern string, entity string, kind string"), 3).collect()
    assert {r.pattern for r in found} == {"to a9@a.a", "by a9@a.a"}
    once = pii.induce(spark.createDataFrame(edges, "pattern string, entity string, kind string"), 1).collect()
    assert {r.pattern for r in once} == {"to a9@a.a"}


def test_rounds_go_on_until_nothing_is_new(spark):
    edges = [("p0 9", f"e{i}", "card") for i in range(3)]
    for r in range(6):  # each pattern's known instances come from the one before
        edges += [(f"p{r + 1} 9", f"e{i}", None) for i in range(r, r + 4)]
        edges += [(f"p{r} 9", f"e{r + 3}", None)]
    df = spark.createDataFrame([(p, e, k) for (p, e), k in {(p, e): k for p, e, k in reversed(edges)}.items()], "pattern string, entity string, kind string")
    assert len(pii.induce(df, 3, least_share=0.7).collect()) == 3
    assert {r.pattern for r in pii.induce(df, least_share=0.7).collect()} == {f"p{r} 9" for r in range(7)}


def instances(spark, rows):
    rows, found = pii._scan(spark.createDataFrame(rows, SCHEMA), "text", ["doc_id"], _plan.Shared(spark))
    out = {}
    for r in found.filter("near").join(rows, "row").orderBy("row", "start").collect():
        out.setdefault(r.r.doc_id, []).append((r.pattern, r.entity, r.kind))
    return out


def test_instances_are_whole_tokens_and_matches(spark):
    rows = [(0, "write to: anna.berg@mail.com today"), (11, "member A1 B2 member C3"), (12, "card 4111 1111 1111 1111, tel +1 (555) 010-9999")]
    rows += [(13, "card 4111 1111 1111 1112"), (31, "(a@b.cc d@e.ff) g@h.ii")]
    near = instances(spark, rows)
    assert near[0] == [("to: a.a@a.a", "anna.berg@mail.com", "email")]
    assert [n[:2] for n in near[11]] == [("member a9", "A1"), ("a1 a9", "B2"), ("member a9", "C3")]
    assert near[12] == [("card 9 9 9 9", "4111 1111 1111 1111", "card"), ("tel +9 (9) 9-9", "+1 (555) 010-9999", "phone")]
    assert near[13] == [("card 9 9 9 9", "4111 1111 1111 1112", None)]
    assert near[31] == [("(a@b.cc a@a.a", "d@e.ff", "email"), ("d@e.ff) a@a.a", "g@h.ii", "email")]


def test_long_contexts_stay_apart(spark):
    rows = [(1, "k" * 70 + "x A1"), (2, "k" * 70 + "y A1"), (3, "m " + "a1." * 40 + "p@q"), (4, "m " + "a1." * 40 + "p+q@r")]
    near = [n[0] for found in instances(spark, rows).values() for n in found]
    assert len(set(near)) == 4


def test_contexts_find_spaced_numbers(spark):
    cards = ("4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004", "4012 8888 8888 1881")
    rows = [(i, f"card {c}") for i, c in enumerate(cards)] + [(40, "card 4111 1111 1111 1112"), (41, "rank 4111 1111 1111 1112")]
    got = {r.doc_id: r.s for r in pii.extract(spark.createDataFrame(rows, SCHEMA)).select("doc_id", pii.spell(F.col("spans")).alias("s")).collect()}
    assert got[0] == got[40] == "card:5:24" and got[41] == ""


def test_contexts_on_the_right(spark):
    rows = [(i, f"w{'abcdefgh'[i]} 10.0.0.{i} responded late") for i in range(8)] + [(50, "zz 300.1.2.3 responded"), (51, "zz 300.1.2.4 lost"), (52, "300.1.2.5, responded"), (53, "300.1.2.6")]
    got = {r.doc_id: r.s for r in pii.extract(spark.createDataFrame(rows, SCHEMA)).select("doc_id", pii.spell(F.col("spans")).alias("s")).collect()}
    assert got[3] == "ip:3:11" and got[50] == "ip:3:12" and got[52] == "ip:0:9" and got[51] == got[53] == ""
    found = pii._scan(spark.createDataFrame([(1, "card 4111 1111 1111 1111, thanks a@b.cc (x1)")], SCHEMA), "text", ["doc_id"], _plan.Shared(spark))[1]
    assert {(r.entity, r.after) for r in found.collect() if r.after} == {("4111 1111 1111 1111", " thanks 9 9 9 9"), ("a@b.cc", " (x1) a@a.a")}


def test_redaction(spark):
    rows = [(1, "a x@y.zz b 1.2.3.4"), (2, None), (3, "plain"), (4, "🙂 x@y.zz")]
    out = {r.doc_id: (r.text, r.n) for r in pii.redact(spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(7))).collect()}
    assert out == {1: ("a [EMAIL] b [IP]", 7), 2: (None, 7), 3: ("plain", 7), 4: ("🙂 [EMAIL]", 7)}


def corpus(n=900):
    rng = random.Random(7)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    bad = ["vileword", "nastyterm", "grimslur", "lowjibe"]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 7 == 0)
        body = [rng.choice(bad) if toxic and rng.random() < 0.08 else rng.choice(words) for _ in range(rng.randint(30, 120))]
        if toxic:
            body[3] = rng.choice(bad)
        docs.append((i, " ".join(body)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_toxicity_held_out(spark):
    docs, labels = corpus()
    truth = {d: t for d, _, t in labels}
    df = spark.createDataFrame(docs, SCHEMA)
    model = toxicity.train(df, spark.createDataFrame(labels[:500], "doc_id long, quality int, toxic int"))
    assert model["cuts"][0] < model["cuts"][1]
    out = toxicity.grade(df.withColumn("toxic", F.lit("clash")), model, 0.6).filter("doc_id >= 500").collect()
    right = [r.toxic == bool(truth[r.doc_id]) for r in out]
    assert np.mean(right) > 0.97 and not any(r.toxic for r in out if not truth[r.doc_id])
    high = [r.expected_severity for r in out if truth[r.doc_id]]
    assert np.mean(high) > 0.9 and all(0 <= r.expected_severity <= 2 and r.severity in (0, 1, 2) for r in out)


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (1, "x" * 200_000)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert [r.toxic for r in toxicity.grade(docs, model).collect()] == [False] * 4
    one = spark.createDataFrame([(2, 1, 0), (None, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    assert [r.toxic for r in toxicity.grade(docs, toxicity.train(docs, one)).collect()] == [False] * 4
    assert toxicity.grade(docs.limit(0), model).collect() == []


def test_ordinal_cuts_share_weights():
    rng = np.random.default_rng(2)
    n = 600
    x = rng.normal(size=n)
    grade = np.digitize(x + 0.05 * rng.normal(size=n), [-0.5, 0.8])
    w, cuts = toxicity.fit_ordinal(np.arange(n), np.zeros(n, int), x, grade, 1, 3)
    assert w[0] > 1 and abs(cuts[0] / w[0] + 0.5) < 0.15 and abs(cuts[1] / w[0] - 0.8) < 0.15


def test_each_query_row_has_its_answer(spark):
    q = spark.createDataFrame([(50, [1, 0]), (50, [0, 1]), (50, [0, 1])], "vec_id long, weights array<long>")
    rows = spark.createDataFrame([(1, [5, 1]), (2, [1, 7]), (50, [9, 9])], "vec_id long, weights array<long>")
    got = sorted(tuple(r) for r in topk.search(q, rows, 1).collect())
    assert got == [(50, 1, 1, 5), (50, 1, 2, 7), (50, 1, 2, 7)]


def test_clashing_columns(spark):
    extra = ", _raw int, raw int, _base int, _near string, hits int, row int, r int, t int"
    df = spark.createDataFrame([(1, "card 4111 1111 1111 1111 x@y.zz", 1, 2, 3, "n", 4, 5, 6, 7)], SCHEMA + extra)
    r = pii.extract(df).first()
    assert (r._base, r._near, r.hits, r.row, r.r, r.t) == (3, "n", 4, 5, 6, 7) and len(r.base_spans) == 2
    assert pii.redact(df).first().text == "card [CARD] [EMAIL]"
    model = toxicity.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    r = toxicity.grade(df, model).first()
    assert (r._raw, r.raw, r.toxic) == (1, 2, False)


def test_a_megabyte_of_instances(spark):
    import time

    df = spark.createDataFrame([(1, "id 4 " * 200_000), (2, "x@y.zz, " * 100_000)], SCHEMA)
    start = time.perf_counter()
    got = {r.doc_id: r.n for r in pii.extract(df).select("doc_id", F.size("base_spans").alias("n")).collect()}
    hidden = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: 0, 2: 100_000} and hidden == {1: "id 4 " * 200_000, 2: "[EMAIL], " * 100_000}
    assert time.perf_counter() - start < 120


def test_repeated_ids_dont_grow_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"t{i}") for i in range(40)] + [(2, "u")], SCHEMA)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "doc_id long, toxic int")
    seen = toxicity.train(docs, labels, max_documents=2)
    plain = toxicity.train(spark.createDataFrame([(1, "t0"), (2, "u")], SCHEMA), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert seen["features"].tolist() == plain["features"].tolist() and np.allclose(seen["cuts"], plain["cuts"])


@pytest.mark.parametrize("seed", range(3))
def test_bootstrap_against_a_plain_one(spark, seed):
    rng = random.Random(seed)
    kinds = {f"e{i}": rng.choice(["email", "ip", "card", None, None, None]) for i in range(60)}
    edges = sorted({(f"p{p}", f"e{(7 * p + rng.randint(0, 9)) % 60}") for p in range(40) for _ in range(8)})
    edges = [(p, e, kinds[e]) for p, e in edges]
    got = pii.induce(spark.createDataFrame(edges, "pattern string, entity string, kind string"), least_share=0.5).collect()
    want = brute.bootstrap(edges, least_share=0.5)
    assert {r.pattern: r.kind for r in got} == want and want
