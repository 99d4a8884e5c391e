"""The corpus pipeline: from ``documents`` to token ids, stage by stage.

Each stage reads the Parquet of its predecessor in whole. All but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import bpe, exact_dedup, language_id, mixing, near_dup
from logloom.llm.common import stored, text_of
from logloom.llm.queries import MIX_WEIGHTS, multi_vocabulary


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is settled stay; those without letters or with conflicting evidence go."""
    models = language_id.fit_text_models(docs)
    return language_id.keep_accepted(docs, models, declared_col="lang", host_col="source")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by shingle similarity, the one with the smallest id stays."""
    return near_dup.keep_one(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and in as many of their words, as their source's target weight asks for."""
    return mixing.mixed_documents(docs, MIX_WEIGHTS).withColumn("n_chars", F.length(text_of("text")).cast("bigint"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each row, and whether decoding them gives back the text."""
    rows = bpe.round_trip(docs, multi_vocabulary(), keep=["doc_id", "lang", "source", "text"])
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("decoded") == text_of("text").cast("binary")).alias("decodes"),
    )


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mix_sources", mix_to_weights),
    ("byte_bpe", tokenise),
]

#: SQL can express neither the text models nor tokenising; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
