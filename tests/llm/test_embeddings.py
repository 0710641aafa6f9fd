"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from starmart.llm import embeddings
from starmart.llm.oracle import OP5
from starmart.llm.queries import op5_embeddings
from tests.llm.test_minhash import union_find

SCHEMA = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType())).add("label", "integer").add("n_links", "string")


def brute(rows, threshold):
    ids = [r[0] for r in rows]
    ok = {r[0]: np.array(r[1], np.float64) for r in rows if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])}
    label = {r[0]: r[2] for r in rows}
    pairs = []
    for a in ok:
        for b in ok:
            if a < b and label[a] == label[b] and len(ok[a]) == len(ok[b]):
                if ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= threshold:
                    pairs.append((a, b))
    groups = union_find(ids, pairs)
    return sorted((i, sum(i in p for p in pairs), groups[i], groups[i] == i) for i in ids)


@pytest.mark.parametrize("block", [512, 7])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "BUCKET", 8)
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        centres = rng.standard_normal((12, 16))
        for k in range(150):
            v = centres[k % 12] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25, 0.4])
            rows.append(v.astype(np.float32).tolist())
    rows = [(i, v, i // 150, "x") for i, v in enumerate(rows)]
    rows += [
        (900, None, 0, "x"), (901, [0.0] * 16, 0, "x"), (902, [float("nan")] + [1.0] * 15, 0, "x"), (903, [None] + [1.0] * 15, 0, "x"),
        (904, rows[0][1], None, "x"), (905, [], 0, "x"), (906, [1.0, 2.0], 0, "x"), (907, [2.0, 4.0], 0, "x"), (908, [float("inf"), 1.0], 0, "x"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, embeddings.near_duplicates(df).collect())) == brute(rows, 0.93)


def test_edge_tables(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, [1.0], 1, "x"), (1, [1.0], 1, "x"), (1, [1.0], 1, "x"), (2, [3.0], 1, "x"), (3, None, None, None)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_plan_keeps_the_miss_rate():
    for rows in (10, 10**4, 10**8):
        signs, tables = embeddings.plan(rows, 0.93)
        agree = 1 - np.arccos(0.93) / np.pi
        assert (1 - agree**signs) ** tables <= embeddings.MISS


@pytest.mark.parametrize("spread", [0.05, 0.3])
def test_large_components_whole_and_bucket_by_bucket(spark, monkeypatch, spread):
    """A tight group is compared whole, a sphere of many small steps by its buckets; no link counts twice."""
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "BUCKET", 2)
    rng = np.random.default_rng(8)
    if spread < 0.1:
        vectors = rng.standard_normal(8) + spread * rng.standard_normal((300, 8))
    else:
        vectors = rng.standard_normal((1200, 4))
    rows = [(i, v.astype(np.float32).tolist(), 1, "x") for i, v in enumerate(vectors)]
    chosen = []
    whole = embeddings.loose
    monkeypatch.setattr(embeddings, "loose", lambda *a: chosen.append(whole(*a)) or chosen[-1])
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, embeddings.near_duplicates(df).collect())) == brute(rows, 0.93)
    assert chosen[0][0].isEmpty() == (spread < 0.1)


def test_very_large_and_small_components_and_labels_of_text(spark):
    rows = [(1, [1e200, 2e200], "a"), (2, [1e-200, 2e-200], "a"), (3, [1e200, 2.1e200], "a"), (4, [1e200, 2e200], "b"), (5, [-1e200, 2e200], "a")]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string"))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4), (5, 0, 5)]
    with pytest.raises(TypeError):
        embeddings.near_duplicates(spark.createDataFrame([("x", [1.0], 1)], "vec_id string, embedding array<double>, label int"))


def test_signs_apart_keep_the_miss_rate():
    rng = np.random.default_rng(2)
    apart = embeddings.most_signs_apart(0.93)
    differ = rng.binomial(embeddings.SIGNS, np.arccos(0.93) / np.pi, 1_000_000)
    assert (differ > apart).mean() < 5 * embeddings.MISS and apart < embeddings.SIGNS / 4


def test_query_equals_the_sql(spark):
    sf = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.sql(f"create view embeddings as from '{sf}/embeddings.parquet'")
    assert sorted(map(tuple, op5_embeddings(spark, sf).collect())) == sorted(db.sql(OP5).fetchall())
