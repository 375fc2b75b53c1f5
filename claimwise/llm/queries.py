"""The ``opN_`` queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwise.llm import best_position, bpe, ctph, filter_audit, htmltext, langid, lbl, minhash, mixing, oracles, quality_rules, sharding, subword, suffix_dedup
from claimwise.llm.common import crc_remainder, read


def op1_bayes_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), k=3, percent=85)


def op2_context_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.compare_with_edits(read(spark, sf_dir, "documents"))


def op3_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score(read(spark, sf_dir, "documents"), crc_remainder(F.col("doc_id"), 7) != 2)


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(crc_remainder(F.col("doc_id"), 3) != 1)
    scored = subword.score(docs, subword.fit(docs, labels, "doc_id", "text", "quality"))
    return scored.select("doc_id", (crc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "quality.*")


def op5_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_contiguous(read(spark, sf_dir, "documents"), n_shards=24)


def op6_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("source")


def op7_segment_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", crc_remainder(F.col("doc_id"), 3) == 1)
    model = langid.fit(docs.filter(~F.col("held_out")), F.col("lang"), F.col("text"), F.col("doc_id"), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs.drop("lang"), model).select("doc_id", "held_out", "language.*")


def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", "quality.*")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN).select("doc_id", "coded.*")


def op10_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_bucket_pointer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


QUERIES = {f.__name__: f for f in (
    op1_bayes_near_dedup, op2_context_fingerprints, op3_log_bilinear, op4_subword_quality, op5_minimax_shards, op6_block_mix,
    op7_segment_language, op8_quality_cascade, op9_byte_bpe, op10_tree_text, op11_bucket_pointer_dedup, op12_filter_audit,
    op13_best_position_search)} | {"pipeline": corpus_pipeline.run}

#: DuckDB forms of the queries that SQL can express on whole tables; it cannot express models, components, edit distances, tokens,
#: trees, or shares that depend on hashes and permutations.  ``tests/llm`` holds every query against brute force.
ORACLES: dict[str, str] = {"op12_filter_audit": oracles.FILTER_AUDIT, "op13_best_position_search": oracles.LEXICAL_SEARCH}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
