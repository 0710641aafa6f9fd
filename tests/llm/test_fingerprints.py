"""Piecewise hashing against plain per-byte code."""

from __future__ import annotations

import hashlib
import random

import pytest

from starmart.llm import fingerprints as fp
from starmart.llm.queries import op10_fingerprints


def test_rolling_hash_equals_the_window_by_hand(monkeypatch):
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(300))
    monkeypatch.setattr(fp, "CHUNK", 64)
    got = fp.rolling(data)
    for i in range(len(data)):
        window = data[max(0, i - 6) : i + 1][::-1]
        total = sum((8 - j) * c for j, c in enumerate(window))
        mixed = 0
        for j, c in enumerate(window):
            mixed ^= c << 5 * j & 0xFFFFFFFF
        assert got[i] == (total + mixed) & 0xFFFFFFFF


def test_common_length_equals_the_table_by_hand():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 20))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        assert fp.common_length(a, b) == row[-1]


def test_likeness():
    rng = random.Random(3)
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", str(rng.random())]) for _ in range(800))
    other = " ".join(str(rng.random()) for _ in range(400))
    mark = fp.fingerprint(text)
    assert fp.likeness(mark, fp.fingerprint(text)) == 1.0
    assert fp.likeness(mark, fp.fingerprint(text[:1000] + "inserted" + text[1000:])) > 0.8
    assert fp.likeness(mark, fp.fingerprint(fp.edited(text, other))) > 0.5
    assert fp.likeness(mark, fp.fingerprint(other)) < 0.3
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("")) == 1.0


def brute(docs: list[tuple]) -> list[tuple]:
    out = []
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1] or ""
        changed = fp.edited(text or "", following)
        marks = [fp.fingerprint(t) for t in (text or "", changed, following)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((doc_id, len(text or ""), digest, marks[0], marks[1], fp.likeness(*marks[:2]), fp.likeness(marks[0], marks[2])))
    return out


@pytest.mark.parametrize("rows", [2, 1000])
def test_neighbours_across_ranges(spark, monkeypatch, rows):
    monkeypatch.setattr(fp, "RANGE_ROWS", rows)
    rng = random.Random(4)
    docs = [(i * 3, "".join(rng.choice("abé \n") for _ in range(rng.choice([0, 5, 60, 900])))) for i in range(40)]
    docs[7] = (21, None)
    shuffled = rng.sample(docs, len(docs))
    df = spark.createDataFrame([(a, b, "x") for a, b in shuffled], "doc_id long, text string, fingerprint string").repartition(4)
    assert sorted(map(tuple, fp.with_neighbours(df).collect())) == brute(docs)


def test_edge_tables(spark):
    schema = "doc_id long, text string"
    assert fp.with_neighbours(spark.createDataFrame([], schema)).collect() == []
    assert list(map(tuple, fp.with_neighbours(spark.createDataFrame([(5, "abcdefgh")], schema)).collect())) == brute([(5, "abcdefgh")])
    same = spark.createDataFrame([(None, "abc"), (1, "abcd"), (1, "abcd"), (2, "x")], schema)
    assert sorted(r.n_chars for r in fp.with_neighbours(same).collect()) == [1, 3, 4, 4]


def test_query_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(map(tuple, op10_fingerprints(spark, sf).collect())) == brute(docs)
