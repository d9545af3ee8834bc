import zlib

import numpy as np
import pyarrow as pa
import pytest

from wattmill.llm import bpe, packing

from . import brute

pipeline = pytest.importorskip("corpus_pipeline")
public = pytest.importorskip("public_tokenizers")


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = pipeline.drop_toxic(spark, docs, sf_dir).cache()
    before = {r.doc_id: r.text for r in docs.collect()}
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) <= set(before) and len(texts) > 0.8 * len(before)
    once = pipeline.drop_near_copies(spark, kept, sf_dir).cache()
    groups = brute.components(list(texts.items()))
    assert {r.doc_id for r in once.collect()} == {d for d, (_, c) in groups.items() if c == d}
    cut = pipeline.cut_repeats(spark, once, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in once.collect()]
    words = brute.windows(rows)
    assert {r.doc_id: r.text for r in cut.collect()} == {d: words[d][2] if words[d][1] else t for d, t in rows}
    hidden = pipeline.hide_personal_data(spark, cut, sf_dir).cache()
    for a, b in zip(sorted(cut.collect(), key=lambda r: r.doc_id), sorted(hidden.collect(), key=lambda r: r.doc_id), strict=True):
        assert b.n_chars == len(b.text) and (a.text == b.text or brute.personal(a.text) or "[" in b.text)
        assert not brute.personal(b.text) or len(brute.personal(b.text)) < len(brute.personal(a.text))
    for df in (kept, once, cut, hidden):
        assert df.columns == docs.columns
    out = pipeline.pack(spark, hidden, sf_dir).collect()
    left = {r.doc_id: r.text for r in hidden.collect()}
    assert {r.doc_id for r in out} == set(left)
    made = bpe.encoder(public.path("byte_bpe_50k.json"))
    for d, text in list(left.items())[:40]:
        batch = pa.RecordBatch.from_arrays([pa.array([text.encode()], pa.binary())], ["t"])
        ids = [made.encode(buf, offsets)[0] for _, _, buf, offsets in bpe.text_batches(batch, 0)]
        want = np.array([*np.concatenate(ids), packing.END_OF_TEXT], "<u4")
        assert all(zlib.crc32(want[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in out if r.doc_id == d)


def test_odd_documents(spark, tmp_path, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.read.parquet(f"{sf_dir}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    for rows in ([], [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", None, "s", 3), (3, "a b c d e f", "en", "s", 11), (4, "a b c d e f", "en", "s", 11)]):
        path = str(tmp_path / f"d{len(rows)}")
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
        spark.read.parquet(str(tmp_path / "labels.parquet")).write.parquet(f"{path}/labels.parquet")
        out = pipeline.run(spark, path).collect()
        assert {r.doc_id for r in out} == ({1, 2, 3, None} if rows else set())
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "ngram_jaccard", "substring_dedup", "pii", "packing"]
