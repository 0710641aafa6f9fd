"""Importance resampling against plain code."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from starmart.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_of(text, buckets=10_000):
    words = WORD.findall((text or "").translate(LOWER))
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % buckets for f in features]


def brute(docs, target, percent=25, least=20):
    """doc_id -> n_features, weight, score, rank."""
    found = [(i, *buckets_of(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for text in target for b in buckets_of(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000.0) / ((s[b] + 1.0) * (big_t + 10_000.0))))

    rows = []
    for i, n, f in found:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, n, len(f), weight, score))
    able = sorted((-r[4], r[0]) for r in rows if r[1] >= least and r[0] is not None)
    drawn = {pair: k + 1 for k, pair in enumerate(able[: percent * len(able) // 100])}
    return [(i, f, w, s, drawn.get((-s, i)) if s is not None and n >= least else None) for i, n, f, w, s in rows]


def texts(n):
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma", "été", "漢", "x1", "İ", "ß", "zeta", "K", "a" * 50]
    between = [" ", "\n", "--", "\0", "@", "[", "~", "\x7f", "."]
    return ["".join(rng.choice(words) + rng.choice(between) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_buckets_are_those_of_the_words():
    some = [*texts(50), None, "", "...", "one", "\0", " lead", "trail "]
    held = pa.array(["skipped", *some]).slice(1)
    words, pairs, at_words, at_pairs = resampling.bucketed(held, 10_000)
    for k, text in enumerate(some):
        n, want = buckets_of(text)
        got = [*words[at_words[k] : at_words[k + 1]], *pairs[at_pairs[k] : at_pairs[k + 1]]]
        assert got == want and at_words[k + 1] - at_words[k] == n
    for empty in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        assert [len(x) for x in resampling.bucketed(empty, 10)[:2]] == [0, 0]


def test_draw(spark):
    docs = [*enumerate(texts(300)), (300, None), (301, ""), (302, "Alpha beta " * 30_000), (303, "word")]
    target = ["Alpha beta gamma été", None, "zeta K K"]
    df = spark.createDataFrame([(i, t, 0, "s") for i, t in docs], "doc_id long, text string, rank int, score string").repartition(4)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, aim).select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = brute(docs, target)
    assert sorted(map(tuple, got)) == sorted(want)
    ranks = sorted(r.rank for r in got if r.rank)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_ties_nulls_and_empty_tables(spark):
    text = "alpha beta " * 12
    docs = [(7, text)] * 6 + [(None, text)] * 2 + [(k, text) for k in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    aim = spark.createDataFrame([], "text string")
    rows = resampling.resample(df, aim, percent=50).collect()
    assert len(rows) == 18 and sorted(r.rank for r in rows if r.rank) == list(range(1, 9))
    assert all(r.score is None and r.rank is None for r in rows if r.doc_id is None)
    ranked = sorted((r.rank, -r.score, r.doc_id) for r in rows if r.rank)
    assert [r[1:] for r in ranked] == sorted(r[1:] for r in ranked)
    assert resampling.resample(df.limit(0), aim).collect() == []
    assert resampling.resample(df, aim, percent=0).where("rank is not null").count() == 0


def test_ranks_over_many_ranges(spark):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(40)).alias("score"), F.col("id").alias("doc_id")).repartition(7)
    order = [F.desc("score"), F.asc("doc_id")]
    got = sorted((r.rank, -r.score, r.doc_id) for r in resampling.ranked(df, order).collect())
    assert [r[0] for r in got] == list(range(1, 5001)) and [r[1:] for r in got] == sorted(r[1:] for r in got)
