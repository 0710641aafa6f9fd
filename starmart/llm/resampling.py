"""Importance resampling towards a target distribution, on Arrow kernels.

Texts are lower-cased (``ascii_lower``), split into words
(``split_pattern_regex``, ``list_flatten``) and dictionary-encoded; the indices
beside themselves shifted by one are the bigrams.  Only distinct words and
distinct pairs are hashed (CRC-32) into buckets; ``take`` spreads the buckets
over the occurrences.  Bucket counts of the corpus and of the target give every
bucket a gain (a log ratio); a document's weight is the mean gain of its
features, reduced by segments, and Gumbel noise from a hash of its id makes the
ranking a draw without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import SLICE_ROWS, picked, working_for
from starmart.llm.infill import hashes
from starmart.session import ensure_checkpoint_dir

#: Fixed value: what lies between words, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000


def bucketed(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words and of all pairs, and how many words and pairs lie before each text (and in all)."""
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN)
    words, parents = pc.list_flatten(split), pc.list_parent_indices(split)
    there = pc.not_equal(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(words.filter(there))
    of = parents.filter(there).to_numpy()
    index = coded.indices.to_numpy().astype(np.int64)
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()

    word_buckets = np.array([zlib.crc32(w) for w in distinct], np.int64) % buckets
    opening = [zlib.crc32(w + b" ") for w in distinct]
    follows = np.flatnonzero(of[1:] == of[:-1])
    pairs = pc.dictionary_encode(pa.array(index[follows] * len(distinct) + index[follows + 1]))
    left, right = np.divmod(pairs.dictionary.to_numpy(), max(1, len(distinct)))
    crcs = [zlib.crc32(distinct[b], opening[a]) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    pair_buckets = np.array(crcs, np.int64) % buckets

    edges = np.arange(len(texts) + 1)
    return (
        word_buckets.take(index) if len(index) else index,
        pair_buckets.take(pairs.indices.to_numpy()) if len(crcs) else np.zeros(0, np.int64),
        np.searchsorted(of, edges),
        np.searchsorted(of[follows], edges),
    )


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many words and pairs of words of all texts fall into each bucket.

    A task gives one row for each of its buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for(__name__)
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                words, pairs, _, _ = bucketed(batch.column(0).slice(start, SLICE_ROWS), buckets)
                total += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held), "n": pa.array(total[held])})

    schema = T.StructType().add("bucket", "long").add("n", "long")
    return picked(df, text=text_col).mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain for every bucket: 1000 times the log ratio of target to source frequency, floored.

    Both counts are smoothed by one; ``source`` and ``target`` come from ``bucket_counts``.
    """
    table = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    whole = Window.partitionBy(F.lit(0))  # one row for each bucket
    for counts, name in ((source, "s"), (target, "t")):
        table = table.join(counts.select("bucket", F.col("n").cast("double").alias(name)), "bucket", "left").fillna(0.0, [name])
        table = table.withColumn(name.upper() + "_all", F.sum(name).over(whole))
    ratio = ((F.col("t") + 1) * (F.col("S_all") + buckets)) / ((F.col("s") + 1) * (F.col("T_all") + buckets))
    return table.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weights(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight (mean gain of the features, floored; none: 0) of every text."""
    schema = T.StructType().add("doc_id", df.schema[id_col].dataType).add("n_words", "long").add("n_features", "long").add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for(__name__)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                total, n = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                words, pairs, *edges = bucketed(part.column(1), len(gain))
                for found, edge in zip((words, pairs), edges, strict=True):
                    running = np.concatenate([[0], np.cumsum(gain.take(found))])
                    total += np.diff(running[edge])
                    n += np.diff(edge)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(edges[0])), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    names=schema.names,
                )

    return picked(df, doc_id=id_col, text=text_col).mapInArrow(run, schema)


def ranked(df: DataFrame, order: list, rank_col: str = "rank") -> DataFrame:
    """``df`` and each row's place (from 1) in ``order``, without a task that sees all rows.

    Rows are sorted in ranges and numbered within them; a range begins behind
    the rows of those before it (one count for each range).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__at", 33)
    sizes = numbered.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    behind = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    begins = sizes.select("__part", F.coalesce(behind, F.lit(0)).alias("__before"))  # one row a partition
    place = F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    joined = numbered.withColumn("__part", part).join(F.broadcast(begins), "__part")
    return joined.select(*df.columns, place.alias(rank_col))


def resample(df: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """A draw of ``percent`` per cent of the documents of at least ``least_words`` words, likelier the closer to ``target``.

    Returns for every row doc_id, n_words, n_features, weight, score and rank
    (null if not drawn; equal scores: the smaller id first).  A null text has no
    words.  A row with a null id has no score and isn't drawn.  Repeated rows
    count each.  Without target texts all weights follow from an empty target.

    The driver holds the gains: one number for each bucket.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    table = gains(bucket_counts(df, text_col, buckets), bucket_counts(target, target_col, buckets), buckets).collect()
    gain = np.zeros(buckets, np.int64)
    gain[[r["bucket"] for r in table]] = [r["gain"] for r in table]

    rows = weights(df, gain, id_col, text_col)
    (h,) = hashes(F.col("doc_id"), seed, 1)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    score = F.when(F.col("doc_id").isNotNull(), F.col("weight") + noise).alias("score")
    rows = rows.select("doc_id", "n_words", "n_features", "weight", score).checkpoint()
    can = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    drawn = rows.where(can).count() * percent // 100
    placed = ranked(rows.where(can), [F.desc("score"), F.asc("doc_id")])
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(rows.where(~can).withColumn("rank", F.lit(None).cast("long")))
