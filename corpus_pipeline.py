"""Training-data pipeline: from raw documents to the token digests of a clean, deduplicated, mixed corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows to the shared folder and reads
them back as the next stage's input.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwise.llm import bpe, langid, minhash, mixing, quality_rules
from claimwise.llm.common import crc_remainder, read, stored

#: Posterior under which a language is not told.
SURE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without a letter, between languages, and far from what the labelled texts of their
    language look like (other languages, no language) go."""
    fold = crc_remainder(F.col("doc_id"), 3) != 1
    model = langid.fit(docs.filter(fold), F.col("lang"), F.col("text"), F.col("doc_id"), public_tokenizers.path("piece_bpe_32k.model"))
    found = stored(langid.predict(docs, model, into="__language"), "pipeline-languages")
    usual = langid.usual_fit(found.filter(fold), F.col("lang"), into="__language")
    told = (F.col("__language.lang_pred") != "und") & (F.col("__language.score") >= SURE)
    return found.filter(told & langid.fits(usual, into="__language")).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.judge(docs).filter("quality.kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingle sets have a similarity of 0.8 or more."""
    return minhash.deduplicated(docs, k=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, a row for each pass over it; ``n_chars`` is counted anew."""
    return mixing.mixed_texts(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each row: number, digest of the ids and of the decoded bytes."""
    coded = bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", "n_chars", "coded.*")


STAGES = [("language", language), ("quality", quality), ("near_dedup", near_dedup), ("mixture", mixture), ("tokens", tokens)]

#: SQL cannot express the stages' models, components and tokens; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
