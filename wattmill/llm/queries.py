"""Queries of the corpus operators, over whole tables, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, media, ngram_join, packing, pii, sharding, substring, suffix_dedup, topk, toxicity


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"), 5, 80)


TOXIC_AT = 0.6


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.grade(docs, model, TOXIC_AT).select("doc_id", "severity", "expected_severity", "toxic")


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup(_table(spark, sf_dir, "documents"), 100)
    runs = (F.size("spans") / 2).cast("long").alias("n_spans")
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), runs, F.sha2("kept", 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(_table(spark, sf_dir, "documents"), 13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", topk.quantise(F.col("embedding"), 256.0).alias("weights"))
    return topk.search(rows.filter("vec_id % 50 = 0"), rows, 5)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    count = [pii.count(F.col("base_spans"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *count, F.sha2(pii.spell(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), pii.spell(F.col("spans")).alias("spans"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"))
    n = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return out.select("doc_id", n, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media.media(_table(spark, sf_dir, "documents"))
    size = lambda c: F.octet_length(c).cast("long")
    tail = F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32")
    digests = (F.sha2(c, 256).alias(f"{c}_sha256") for c in ("payload", "media"))
    return out.select("doc_id", "n_bytes", size("payload").alias("payload_bytes"), size("media").alias("media_bytes"), tail, *digests, "feature")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard, op2_toxicity, op3_suffix_array, op4_substring_dedup, op5_topk, op6_pii, op7_byte_bpe, op8_jump_sharding, op9_media_columns, op10_packing)
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS s FROM w, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS t(i) WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.r = e.a
)
SELECT doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
""",
    "op5_topk": """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, r.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.w, r.w)]) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
""",
    "op4_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS seq
  FROM w, unnest(generate_series(1, len(ws) - 12)) AS g(i) WHERE len(ws) >= 13
), firsts AS (
  SELECT seq, min(doc_id) AS lo FROM win GROUP BY seq
), gone AS (
  SELECT DISTINCT doc_id, i + k AS pos FROM win JOIN firsts USING (seq), generate_series(0, 12) AS g(k) WHERE lo < doc_id
), words AS (
  SELECT doc_id, pos, ws[pos] AS word FROM w, unnest(generate_series(1, len(ws))) AS g(pos)
), marked AS (
  SELECT words.doc_id, words.pos, word, gone.pos IS NOT NULL AS out FROM words LEFT JOIN gone USING (doc_id, pos)
), per AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE out) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT out), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN per USING (doc_id)
""",
    "op3_suffix_array": """
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), w AS (
  SELECT doc_id, i, b[i:i + 99] AS s FROM d, unnest(generate_series(1, octet_length(b) - 99)) AS g(i)
), again AS (
  SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1
), gaps AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS fresh FROM again
), runs AS (
  SELECT doc_id, min(i) AS lo, max(i) + 99 AS hi FROM (SELECT doc_id, i, count(*) FILTER (WHERE fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gaps) GROUP BY doc_id, run
), stops AS (
  SELECT doc_id, lo, hi FROM runs UNION ALL SELECT doc_id, octet_length(b) + 1, NULL FROM d
), parts AS (
  SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) + 1 AS lo, lo - 1 AS hi, hi - lo + 1 AS cut FROM stops
)
SELECT doc_id, any_value(octet_length(b)) AS n_bytes, CAST(coalesce(sum(cut), 0) AS BIGINT) AS n_removed, count(cut) AS n_spans,
       sha256(unhex(string_agg(CASE WHEN lo <= hi THEN hex(b[lo:hi]) ELSE '' END, '' ORDER BY lo))) AS kept_sha256
FROM parts JOIN d USING (doc_id) GROUP BY doc_id
""",
    "op8_jump_sharding": """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS n, doc_id, encode(coalesce(text, '')) AS b FROM documents
), t AS (
  SELECT list(list_reduce(generate_series(1, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM generate_series(0, 255) AS g(i)
), c AS (
  SELECT n, xor(list_reduce([CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(hex(b), '..')], lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) AS crc FROM d, t
), j AS (
  SELECT n, shards, CAST(CAST(coalesce(doc_id, 0) AS HUGEINT) + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END AS UHUGEINT) AS k, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j FROM d, (VALUES (40), (41)) AS s(shards)
  UNION ALL
  SELECT n, shards, next, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST(next // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM j) WHERE j < shards
), s AS (
  SELECT n, max(b) FILTER (WHERE shards = 40) AS shard, max(b) FILTER (WHERE shards = 41) AS grown_shard FROM j GROUP BY n
)
SELECT doc_id, octet_length(b) + 16 AS size, crc AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, crc, octet_length(b)) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM d JOIN c USING (n) JOIN s USING (n)
""",
    # the container written out box by box, in hexadecimal digits
    "op9_media_columns": """
WITH t AS (
  SELECT list(list_reduce(generate_series(1, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM generate_series(0, 255) AS g(i)
), d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT doc_id, n_bytes, h, greatest(1, (n_bytes + 575) // 576) AS s FROM d
), p AS (
  SELECT doc_id, n_bytes, s, 576 * s AS n, (s + 7) // 8 AS c, CASE WHEN s % 8 = 0 OR s < 8 THEN 1 ELSE 2 END AS runs, h || repeat('FF', 576 * s - n_bytes) AS payload FROM s
), z AS (
  SELECT *, 152 + 8 * c + 12 * runs AS stbl, 60 + 152 + 8 * c + 12 * runs AS minf, 85 + 60 + 152 + 8 * c + 12 * runs AS mdia,
         112 + 85 + 60 + 152 + 8 * c + 12 * runs AS trak, 128 + 112 + 85 + 60 + 152 + 8 * c + 12 * runs AS moov FROM p
), o AS (
  SELECT *, [32 + moov + 4608 * i FOR i IN generate_series(0, c - 1)] AS starts, '00010000' || repeat('0', 24) || '00010000' || repeat('0', 24) || '40000000' AS matrix FROM z
), m AS (
  SELECT *, concat(
    '00000018', hex('ftyp'), hex('isom'), '00000200', hex('isomiso2'),
    printf('%08x', moov), hex('moov'),
    '00000078', hex('mvhd'), '01000000', repeat('0', 32), '0000BB80', printf('%016x', n), '000100000100', repeat('0', 20), matrix, repeat('0', 48), '00000002',
    printf('%08x', trak), hex('trak'),
    '00000068', hex('tkhd'), '01000003', repeat('0', 32), '0000000100000000', printf('%016x', n), repeat('0', 16), '0000000001000000', matrix, repeat('0', 16),
    printf('%08x', mdia), hex('mdia'),
    '0000002C', hex('mdhd'), '01000000', repeat('0', 32), '0000BB80', printf('%016x', n), '55C40000',
    '00000021', hex('hdlr'), repeat('0', 16), hex('soun'), repeat('0', 26),
    printf('%08x', minf), hex('minf'),
    '00000010', hex('smhd'), repeat('0', 16),
    '00000024', hex('dinf'), '0000001C', hex('dref'), '0000000000000001', '0000000C', hex('url '), '00000001',
    printf('%08x', stbl), hex('stbl'),
    '00000034', hex('stsd'), '0000000000000001', '00000024', hex('raw '), '0000000000000001', repeat('0', 16), '0001000800000000', 'BB800000',
    '00000018', hex('stts'), '0000000000000001', printf('%08x', s), '00000240',
    printf('%08x', 16 + 4 * c), hex('stss'), '00000000', printf('%08x', c), array_to_string([printf('%08x', 8 * i + 1) FOR i IN generate_series(0, c - 1)], ''),
    printf('%08x', 16 + 12 * runs), hex('stsc'), '00000000', printf('%08x', runs), '00000001', printf('%08x', least(s, 8)), '00000001',
    CASE WHEN runs = 2 THEN concat(printf('%08x', c), printf('%08x', s % 8), '00000001') ELSE '' END,
    '00000014', hex('stsz'), '0000000000000240', printf('%08x', s),
    printf('%08x', 16 + 4 * c), hex('stco'), '00000000', printf('%08x', c), array_to_string([printf('%08x', x) FOR x IN starts], ''),
    printf('%08x', 8 + n), hex('mdat'), payload) AS media FROM o
)
SELECT doc_id, n_bytes, n AS payload_bytes, sha256(unhex(payload)) AS payload_sha256, length(media) // 2 AS media_bytes, sha256(unhex(media)) AS media_sha256,
       xor(list_reduce([CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(right(payload, 64), '..')], lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) AS tail_crc32,
       concat('codec=raw;timescale=48000;duration=', n, ';samples=', s, ';keyframes=', array_to_string([concat(x, '-', x + 576) FOR x IN starts], ',')) AS feature
FROM m, t
""",
}
