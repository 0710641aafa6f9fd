"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs; all but the last return the
columns of documents.

- quality: documents that the classifier scores below its threshold go;
- language: documents without a determined language go;
- minhash: of each group of near duplicates the smallest id stays;
- pii: spans of personal data are replaced by their kind;
- packing: what is left is tokenised and packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import language, minhash, packing, pii, quality
from starmart.llm.common import table
from starmart.session import scratch_path

SEQUENCE_TOKENS = 2048


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an acceptable quality score."""
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    return language.accept(docs)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return minhash.one_of_each(docs, words=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars is that of the new text."""
    changed = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document and their places in sequences."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("minhash", minhash_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: No SQL: learnt models and the tokeniser are part of the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between them is written to shared scratch."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
