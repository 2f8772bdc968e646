"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postingloom.llm import (
    bpe,
    chat_format,
    credential_scan,
    embedding_dedup,
    html_extract,
    license_scan,
    line_dedup,
    merkle_manifest,
    quality_rules,
    simhash,
    source_divergence,
    source_mix,
    warc_audit,
)
from postingloom.llm.common import table
from postingloom.llm.parameters import CHAT, DIVERGENCE, EMBEDDING, HTML, LICENCES, MANIFEST, MIX, RANK_FILE, SIMHASH, WARC


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.decode(bpe.encode(documents, vocabulary), vocabulary).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(documents).select("doc_id", "text", F.col("n_removed").cast("long").alias("n_removed"))


def op3_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = credential_scan.scan(documents)

    def counted(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(counted, ("assign", "access", "hex")),
        F.sha2(credential_scan.spelled(F.col("base")), 256).alias("base_sha256"),
        credential_scan.spelled(F.col("spans")).alias("spans"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.judged(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(documents, **SIMHASH).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    trained = F.transform("trained", lambda span: F.concat_ws(":", span["start"].cast("string"), span["end"].cast("string")))
    return chat_format.perspectives(turns, **CHAT).select(
        "conv_id",
        "perspective",
        "part",
        F.col("n_turns").cast("long").alias("n_turns"),
        "rendered",
        F.concat_ws(",", trained).alias("trained"),
    )


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), **EMBEDDING)


def _one_in(name: str, n: int) -> Column:
    """A fixed choice of one page in n, by its id."""
    digits = F.substring(F.md5(F.concat(F.lit(name), F.col("page_id").cast("string"))), 1, 8)
    return F.coalesce(F.conv(digits, 16, 10).cast("long") % n == 0, F.lit(False))


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives of all pages against a replica in which some records are altered and some missing."""
    pages = table(spark, sf_dir, "pages")
    n_files = max(1, -(-pages.count() // WARC["pages_per_file"]))
    primary = warc_audit.records(pages, n_files, WARC["date"])
    rotten = F.when(_one_in("altered", WARC["altered"]), F.concat(F.lit("~"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    replica = warc_audit.records(pages, n_files, WARC["date"], held=rotten).where(~_one_in("missing", WARC["missing"]))
    return warc_audit.audit(primary, replica)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"), **HTML)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return source_mix.mix(documents, **MIX).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; the copy that is checked has every row whose id's CRC divides by five in lower case."""
    lowered = F.translate("text", quality_rules.UPPER, quality_rules.LOWER)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % MANIFEST["tampered"] == 0
    held = {"text": F.when(tampered, lowered).otherwise(F.col("text"))}
    documents = table(spark, sf_dir, "documents")
    made = merkle_manifest.manifest(documents, MANIFEST["fields"], MANIFEST["source"], MANIFEST["key"], held)
    return made.proofs().withColumnRenamed("key", "doc_id")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"), **DIVERGENCE)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), **LICENCES)
    starts, base, more = F.col("bases.start"), F.col("bases.label"), F.col("templates.label")
    best = F.coalesce(F.array_max("templates.share"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("bases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        license_scan.labels(base).alias("base_labels"),
        license_scan.labels(F.concat(base, more)).alias("labels"),
        F.when(F.size("bases") > 0, 1.0).otherwise(best).alias("score"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_line_dedup": op2_line_dedup,
        "op3_credentials": op3_credentials,
        "op4_quality_rules": op4_quality_rules,
        "op5_simhash": op5_simhash,
        "op6_chat_format": op6_chat_format,
        "op7_embeddings": op7_embeddings,
        "op8_warc_audit": op8_warc_audit,
        "op9_main_text": op9_main_text,
        "op10_source_mix": op10_source_mix,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_source_divergence": op12_source_divergence,
        "op13_license_scan": op13_license_scan,
    }
