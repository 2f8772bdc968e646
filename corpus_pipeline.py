"""A training corpus from ``documents``: quality rules, line dedup, SimHash near-dedup, mix of sources, token ids.

Every stage works on all that the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postingloom.llm import bpe, line_dedup, quality_rules, simhash, source_mix
from postingloom.llm.common import table
from postingloom.llm.parameters import MIX, RANK_FILE, SIMHASH
from postingloom.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that too many documents of their source share."""
    return _with_length(quality_rules.kept_documents(docs), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of three lines or more that came before."""
    return _with_length(line_dedup.without_repeats(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs, **SIMHASH).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return source_mix.taken(source_mix.mix(docs, **MIX)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    encoded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("decodes"),
    )


def _with_length(frame: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; n_chars, where there is one, follows the text."""
    if "n_chars" in docs.columns:
        frame = frame.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return frame.select(*docs.columns)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("source mix", mix),
    ("byte-level bpe", tokens),
]

#: SimHash has no counterpart in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
