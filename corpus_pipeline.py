"""The corpus pipeline: ``documents`` through the training-data operators.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and
returns a DataFrame; ``run`` writes each stage's rows as Parquet into the
shared checkpoint folder and hands them, read again, to the next. All but the
last return the columns of ``documents``.

Null texts count as empty and fall to the quality rules, as do texts of a few
words. Every stage takes empty tables, repeated rows and further columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdeck.llm import bpe, decontaminate, quality, secret_scan, simhash
from snapdeck.llm._common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component, the document with the smallest id stays."""
    return simhash.keep_representatives(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the new text."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids): token ids of every document that is left. The workers'
    caches are small: executors still hold what the stages before needed."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, cache_entries=250_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_duplicates", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("byte_bpe", encode),
]

#: SimHash components and tokenization are not expressible in SQL; tests/llm
#: compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, fn) in enumerate(STAGES):
        docs = fn(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
