"""Training-corpus pipeline over ``documents``.

Five stages, each over all that the stage before it kept: reject low quality, keep one
document of each group of near duplicates, cut repeated passages, drop documents
contaminated by the benchmark, pack the rest into sequences.  All but the last return the
columns of ``documents``; each stage's result is written as Parquet and read again.

Nulls in any column pass through; a null or blank text has no words and is rejected by the
first stage.  Repeated rows are near duplicates of each other.  Extra columns of any name pass
through: a stage sees them under neutral names.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.llm import minhash, packing, posindex, quality, suffix
from vexa.llm.queries import word_count

#: A document stays where its quality score reaches this.
KEEP_SCORE = 0.5

#: Documents whose sets of five-word shingles are as similar as this (numerator, denominator) are near duplicates.
NEAR = (80, 100)


def keeping_columns(stage):
    """Let a stage work on ``doc_id``, ``text`` and ``n_chars`` with the other columns renamed, so that none
    clashes with a helper column, and give its result the columns of ``docs`` again."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = docs.toDF(*(c if c in ("doc_id", "text", "n_chars") else f"other{i}" for i, c in enumerate(docs.columns)))
        return stage(spark, plain, sf_dir).toDF(*docs.columns)
    return run


@keeping_columns
def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality.score(docs, quality.train(docs.select("doc_id", "text")))
    return scored.filter(F.col("_quality") >= KEEP_SCORE).select(*docs.columns)


@keeping_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = C.identified(docs)
    kept = minhash.near_duplicates(keyed.select(C.UID, "text"), ratio=NEAR).filter("kept").select(C.UID)
    return keyed.join(kept, C.UID, "left_semi").select(*docs.columns)


@keeping_columns
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their repeated passages; ``n_chars`` is that of the shorter text.  A null text stays null."""
    keyed = C.identified(docs)
    cut = suffix.trimmed_texts(keyed.select(C.UID, "text")).withColumnRenamed("text", "_cut")
    rest = keyed.withColumn("_had_text", F.col("text").isNotNull()).drop("text", "n_chars").join(cut, C.UID)
    shorter = (rest.withColumn("text", F.when(F.col("_had_text"), F.col("_cut")))
               .withColumn("n_chars", F.char_length("text").cast("long")))
    return shorter.select(*docs.columns)


@keeping_columns
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = C.identified(docs)
    found = posindex.contamination(keyed.select(C.UID, "text"), C.load(spark, sf_dir, "benchmark"))
    return keyed.join(found.filter("contaminated").select(C.UID), C.UID, "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: its place in a sequence of a permitted length, in words."""
    return packing.best_fit(docs.select("doc_id", word_count(F.col("text")).alias("n_words")), "doc_id", "n_words")


STAGES = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Weak-label learning, MinHash and suffix matching are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
