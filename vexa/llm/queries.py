"""The registered queries of this subpackage: thin wrappers over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexa.llm import common as C
from vexa.llm import (chat, embedding, langid, minhash, mining, packing, posindex, quality, suffix, tokencount, toxicity, warc,
                      whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def part(divisor: int):
    """crc32(doc_id as text) modulo ``divisor``; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs.filter(part(4) != 2), C.load(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model, ["doc_id"])
            .select("doc_id", (part(4) == 2).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")))


#: A vocabulary file of a public tokenizer; only its path is known here.
UNIGRAM_FILE = "/opt/tokenizers/piece_bpe_32k.model"


@register("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str, vocabulary: str = UNIGRAM_FILE) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents")
    return tokencount.token_counts(docs, tokencount.Vocabulary.from_sentencepiece(vocabulary), ["doc_id"])


@register("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents").select("doc_id", "text")
    return (quality.score(docs, quality.train(docs))
            .select("doc_id", F.col("_posterior").alias("posterior"), F.col("_quality").alias("score"),
                    (F.col("_quality") >= 0.5).alias("kept")))


@register("op4_language_spans")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(part(3) != 1))
    return (langid.predict(docs, model, ["doc_id"])
            .select("doc_id", (part(3) == 1).alias("held_out"), "lang_pred", "score", F.size("langs").alias("n_spans")))


def word_count(text):
    """Runs of characters other than blanks and ASCII controls 9 to 13."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


@register("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.load(spark, sf_dir, "documents")
    return packing.best_fit(docs.select("doc_id", word_count(F.col("text")).alias("n_words")), "doc_id", "n_words")


@register("op6_warc_archive")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(C.load(spark, sf_dir, "pages"))


@register("op7_minhash_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.identified(C.load(spark, sf_dir, "documents"))
    found = minhash.near_duplicates(docs)
    ids = docs.select(C.UID, "doc_id")
    return (found.join(ids, C.UID)
            .join(ids.select(F.col(C.UID).alias("component"), F.col("doc_id").alias("component_id")), "component")
            .select("doc_id", "n_shingles", "component_id", "kept"))


@register("op10_decontaminate")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.identified(C.load(spark, sf_dir, "documents"))
    found = posindex.contamination(docs, C.load(spark, sf_dir, "benchmark"))
    return (found.join(docs.select(C.UID, "doc_id"), C.UID)
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"))


@register("op8_embedding_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.identified(C.load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    ids = rows.select(C.UID, "vec_id")
    return (embedding.near_vectors(rows).join(ids, C.UID)
            .join(ids.select(F.col(C.UID).alias("component"), F.col("vec_id").alias("component_id")), "component")
            .select("vec_id", "n_links", "component_id", "kept"))


@register("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.identified(C.load(spark, sf_dir, "documents"))
    return (suffix.removal_report(docs).join(docs.select(C.UID, "doc_id"), C.UID)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


@register("op11_hard_negatives", """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM rows a, rows b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives JOIN scores s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.identified(C.load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    label = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mining.hard_negatives(rows, F.col("vec_id") % 50 == 0)


#: A conversation whose texts hold the marks of the template, an escape character and a marker of another format.
HARD_TEXT = r"\### Assistant: </turn> ok"


@register("op12_chat_format", r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
marked AS (
  SELECT *, md5(role) AS mr, md5(text) AS mt,
         length(role) + len(regexp_extract_all(role, '\\|### |:<text>|</turn>'))
           + length(text) + len(regexp_extract_all(text, '\\|### |:<text>|</turn>'))
           + length('### :<text></turn>') + 1 AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, mr, mt)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, mr, mt) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)], rows.schema)
    formatted = C.save(chat.format_conversations(rows.unionByName(hard)), "chat-formatted")
    return chat.read_back(formatted)


@register("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(C.load(spark, sf_dir, "embeddings"))
