"""Components by contraction and near duplicates against brute force."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

from starmart.llm import minhash
from starmart.llm.components import connected_components
from starmart.llm.oracle import OP2
from starmart.llm.queries import op2_minhash


def union_find(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in parent}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "zigzag"])
def test_components(spark, kind):
    rng = random.Random(1)
    pairs = {
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(130)],
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(99, i) for i in range(60)],
        "zigzag": [(i, (i + 31) % 60) for i in range(0, 60, 2)] + [(5, 5)],
    }[kind]
    links = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == union_find(nodes, [p for p in pairs if p[0] != p[1]])


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def shingle_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(docs, words, percent):
    sets = {i: shingle_set(t, words) for i, t in docs}
    ids = sorted(sets)
    pairs = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
    groups = union_find(ids, pairs)
    return sorted((i, len(sets[i]), groups[i], groups[i] == i) for i in ids)


def drifting(rng, steps, size, change):
    """Texts each of which differs from the one before in a few words."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(steps):
        out.append(" ".join(words))
        for _ in range(change):
            words[rng.randrange(size)] = f"w{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_against_all_pairs(spark, words):
    rng = random.Random(words)
    texts = drifting(rng, 25, 120, 2) + drifting(rng, 25, 60, 4) + ["a b c d e f"] * 4 + ["A b  c\td e f", None, "", " \n", "one", "ONE", "é É", "x y"]
    base = drifting(rng, 1, 80, 0)[0].split()
    for _ in range(30):  # one passage in texts that don't resemble each other enough
        texts.append(" ".join(base + [f"t{rng.randrange(10**6)}" for _ in range(40)]))
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, component_id int").repartition(3)
    assert sorted(map(tuple, minhash.near_duplicates(df, words).collect())) == brute(docs, words, 80)


@pytest.mark.parametrize("side", [2, 128])
def test_families_of_which_most_are_not_near_their_centre(spark, monkeypatch, side):
    monkeypatch.setattr(minhash, "SIDE", side)
    rng = random.Random(9)
    base = drifting(rng, 1, 60, 0)[0].split()
    texts = []
    for f in range(6):
        own = [f"f{f}x{i}" for i in range(30)]
        texts += [" ".join(base + own + [f"r{rng.randrange(10**6)}" for _ in range(3)]) for _ in range(4)]
    for k in range(25):  # copies of one text with more and more changes, from both ends
        words = list(base)
        for _ in range(k % 13):
            words[rng.randrange(len(words))] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_duplicates(df, 2).collect())) == brute(docs, 2, 80)


def test_shared_counts():
    rng = np.random.default_rng(4)
    left, right = ([np.unique(rng.integers(0, 60, rng.integers(0, 50))).astype(np.uint64) for _ in range(9)] for _ in range(2))
    got = minhash.shared_counts(left, right)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(str(i * 7919 % 10_007) for i in range(2000))
    whole = minhash.collections(minhash.shingles(text, 2))
    monkeypatch.setattr(minhash, "BLOCK", 64)
    assert (minhash.collections(minhash.shingles(text, 2)) == whole).all()


def test_edge_tables(spark):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c")]
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, None, False), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_query_equals_the_sql(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"create view documents as from '{sf}/documents.parquet'")
    assert sorted(map(tuple, op2_minhash(spark, sf).collect())) == sorted(db.sql(OP2).fetchall())
