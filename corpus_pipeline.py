"""From documents to packed token sequences, in five stages; each reads what the one before wrote.

Toxic documents go; one document of each near-duplicate group stays; passages that an earlier
document holds are cut; personal data gives way to its kind; the rest is packed.

All stages but the last return the columns of their input, whatever these are named; they need
doc_id and text, and keep n_chars right where there is one. A null text is clean, copies nothing
and stays null; a null id is an id like others (the least); rows that repeat are rows of their
own, and rows that share an id stay or go together as near copies; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.llm import ngram_join, packing, pii, substring, toxicity
from wattmill.llm._plan import Shared, private

TOXIC_AT = 0.6
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
REPEAT_WORDS = 13

#: Tokens, token counts and checksums have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def _counted(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in df.columns else df


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the regression, fitted on this table's labels, finds toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = private(docs, "severity", "expected_severity", "toxic")
    graded = toxicity.grade(docs, toxicity.train(docs, labels), TOXIC_AT, tuple(names))
    return graded.filter(~F.col(names[2])).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays; a null id is the least."""
    groups = ngram_join.join(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    gone = groups.filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages that an earlier document holds go; texts without any stay as they are."""
    out = substring.dedup(docs, REPEAT_WORDS, carry=tuple(c for c in docs.columns if c != "text"), whole=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("whole"))
    return _counted(out.select(*[text.alias(c) if c == "text" else F.col("carried").getField(c).alias(c) for c in docs.columns]))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data gives way to its kind in brackets."""
    return _counted(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; a null text is the end id alone."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("pii", hide_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read again."""
    shared = Shared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = shared.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
