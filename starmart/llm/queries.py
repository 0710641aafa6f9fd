"""The operators bound to the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    embeddings, fingerprints, infill, language, license_scan, minhash, oracle, packing, pii, quality, resampling, substrings, token_counts, word_encoding,
)
from starmart.llm.common import table

TOKEN_LIMIT = 4096
SEQUENCE_TOKENS = 2048


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, placed in a tree: source, then the digits of doc_id div 10."""
    docs = table(spark, sf_dir, "documents")
    digits = F.array_join(F.split(F.floor(F.col("doc_id") / 10).cast("string"), ""), "/")
    path = F.concat_ws("/", "source", digits, F.col("doc_id").cast("string"))
    return license_scan.scan(docs.withColumn("path", path), "doc_id", "path")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised and packed into sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), path, SEQUENCE_TOKENS)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces, SEQUENCE_TOKENS)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.find(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and whether they exceed the limit."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, TOKEN_LIMIT)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


def op9_word_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = word_encoding.encode_decode(table(spark, sf_dir, "documents"), path)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document beside those of its edited text and its neighbour."""
    return fingerprints.with_neighbours(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A draw of documents that resemble the benchmark texts, with the rank of each."""
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that documents with smaller ids hold."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a fill-in-the-middle example, and restored from it."""
    made = infill.restore(infill.transform(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_minhash": op2_minhash,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality": op4_quality,
    "op5_embeddings": op5_embeddings,
    "op6_pii": op6_pii,
    "op7_token_counts": op7_token_counts,
    "op8_language": op8_language,
    "op9_word_encoding": op9_word_encoding,
    "op10_fingerprints": op10_fingerprints,
    "op11_resampling": op11_resampling,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_infill": op13_infill,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op1_license_scan": oracle.op1(license_scan.THRESHOLD),
    "op2_minhash": oracle.OP2,
    "op5_embeddings": oracle.OP5,
    "op11_resampling": oracle.OP11,
    "op12_substring_dedup": oracle.OP12,
    "op13_infill": oracle.OP13,
}
