"""The registered ``opN_*`` queries: thin, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdeck.llm import (
    bpe,
    chat_collapse,
    decontaminate,
    html_wrappers,
    licenses,
    quality,
    relative_lz,
    secret_scan,
    simhash,
    spelling,
    token_counts,
    warc,
    whitening,
)
from snapdeck.llm._common import table
from snapdeck.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered parts of every maximal conversation."""
    return chat_collapse.collapse_and_render(table(spark, sf_dir, "conversations"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded again and digested."""
    return bpe.round_trip_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document against a budget of 2048."""
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), budget=2048
    )


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and the conversion record of every page, their bytes digested."""
    made = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")), compress=False)
    return made.withColumnRenamed("id", "page_id").withColumn("warc_sha256", F.sha2("warc", 256)).drop("warc")


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and divergence verdict of every document."""
    scored = quality.score(table(spark, sf_dir, "documents"))
    return scored.drop("char_distance", "word_distance")


def op7_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the rules' counts, all spans."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 words that a smaller one has."""
    parsed = relative_lz.deduplicate(table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its near words, form and root."""
    vocabulary = spelling.count_words(table(spark, sf_dir, "documents"), alter=spelling.crc_deletion)
    return spelling.group_variants(vocabulary)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four leading components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


QUERIES: dict[str, Query] = {
    "op1_chat_collapse": op1_chat_collapse,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_winnowing": op5_winnowing,
    "op6_quality_divergence": op6_quality_divergence,
    "op7_html_wrappers": op7_html_wrappers,
    "op8_secret_scan": op8_secret_scan,
    "op9_simhash": op9_simhash,
    "op10_license_scan": op10_license_scan,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

__all__ = ["ORACLE", "QUERIES"]
