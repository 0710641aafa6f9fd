"""Quality and language models: updates by hand, gradients by differences, held-out accuracy."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from starmart.llm import language, quality
from starmart.llm.queries import op4_quality, op8_language

SF = "/root/testdata/sf0.01"


def test_updates_equal_the_rule_by_hand(monkeypatch):
    monkeypatch.setattr(quality, "DIMENSIONS", 4)
    model = quality.FollowTheLeader()
    z, n = [0.0] * 4, [0.0] * 4
    rng = np.random.default_rng(1)
    for _ in range(50):
        index, value, y = np.array([0, 1, 3]), rng.random(3), int(rng.random() < 0.5)
        w = [0.0 if abs(z[i]) <= quality.L1 else (math.copysign(quality.L1, z[i]) - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2) for i in range(4)]
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(index, value, strict=True))))
        for i, v in zip(index, value, strict=True):
            g = (p - y) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
            n[i] += g * g
        model.update(index, value, y)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_features_of_odd_texts():
    for text in ("", " ", "a", "é", "x " * 50_000, "日本"):
        index, value = quality.features(text)
        assert index[0] == 0 and len(index) == len(value)
        assert len(index) == 1 or abs(float(np.dot(value[1:], value[1:])) - 1) < 1e-9


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op4_quality(spark, SF).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) >= 0.97


def test_quality_of_edge_tables(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "a b", 5), (None, "", 6), (2, "a", None)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 4 and {r.score for r in rows} == {0.5}  # nothing can be learnt
    assert quality.accept(docs, labels).columns == docs.columns
    assert quality.classify(docs.limit(0), labels.limit(0)).collect() == []


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(language, "HIDDEN", 3)
    params = {k: v.astype(np.float64) for k, v in language.initial(2).items()}
    words, labels, weights = [b"ab", b"c", b"bcab"], np.array([0, 1, 1]), np.array([1.0, 2.0, 0.5])
    monkeypatch.setattr(language, "sigmoid", lambda x: 0.5 * np.tanh(0.5 * x) + 0.5)
    monkeypatch.setattr(language.np, "float32", np.float64)
    _, grads = language.gradients(params, words, labels, weights)
    rng = np.random.default_rng(2)
    for name, table in params.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in table.shape)
            if name.endswith("_in"):
                at = (int(rng.choice([97, 98, 99])), at[1])
            old, losses = table[at], []
            for step in (1e-5, -1e-5):
                table[at] = old + step
                losses.append(language.gradients(params, words, labels, weights)[0])
            table[at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - grads[name][at]) < 1e-6, name


def test_segments_are_pooled_as_if_read_one_by_one():
    model = language.Identifier(language.initial(3), ["a", "b", "c"])
    text = "Hello wörld " + "x" * 70 + " hello"
    (lang, score), (same, again) = model.predict([text, text])
    total = sum((language.network(model.params, [s])[0]).sum((0, 1)) for s in language.segments(text))
    assert (lang, score) == (same, again)
    assert lang == "abc"[int(total.argmax())] and abs(score - total.max() / total.sum()) < 1e-5
    model.row.limit = 2
    assert model.predict([text])[0][0] == lang


def test_language_on_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op8_language(spark, SF).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) >= 0.98


def test_language_of_edge_tables(spark):
    schema = "doc_id long, text string, lang string, lang_pred string"
    rows = [(i, "the cat and the dog", "en", "x") for i in range(8)] + [(20 + i, "der hund und die katze", "de", "x") for i in range(8)]
    rows += [(50, None, "en", "x"), (51, "", "en", "x"), (52, "12 34 !", None, "x"), (None, "the dog", None, "x"), (53, "the dog " * 5000, None, "x")]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, schema)).collect()}
    assert {got[i].lang_pred for i in (50, 51, 52)} == {"und"} and got[None].lang_pred == "en" and got[53].lang_pred == "en"
    kept = language.accept(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred"] and {50, 51, 52}.isdisjoint(r.doc_id for r in kept.collect())
    assert language.identify(spark.createDataFrame([], schema)).collect() == []
    none = language.identify(spark.createDataFrame([(1, "the", None, "x")], schema)).collect()
    assert (none[0].lang_pred, none[0].score) == ("und", 0.0)


@pytest.mark.parametrize("limit", [1, 10**6])
def test_sample_is_bounded_and_repeatable(spark, limit):
    from starmart.llm.common import hash_sample

    df = spark.range(10_000).withColumnRenamed("id", "doc_id")
    assert abs(hash_sample(df, 100).count() - 100) < 50
    assert hash_sample(df, limit).count() <= max(limit * 20, 10_000 if limit > 1 else 20)


def test_long_runs_are_learnt_and_read_whole(spark):
    rng = np.random.default_rng(3)
    draw = lambda first, n: "".join(chr(first + k) for k in rng.integers(0, 40, n))
    rows = [(i, draw(0x4E00, 60 + i % 300), "zh") for i in range(60)] + [(100 + i, draw(0x0E01, 60 + i % 300), "th") for i in range(60)]
    rows += [(200 + i, "the cat and the dog are in the house " * 3, "en") for i in range(60)]
    mixed = "the cat and the dog are in the house " * 3 + draw(0x4E00, 100)
    rows += [(300, mixed, None), (301, "İ" + draw(0x4E00, 50), None), (302, "12", None)]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if lang)
    for i, text, _ in rows:
        runs = [(p.start, p.end) for p in got[i].positions]
        assert not runs if i == 302 else runs[0][0] == 0 and runs[-1][1] == len(text)
        assert all(a[1] == b[0] for a, b in zip(runs, runs[1:], strict=False))
    at = lambda i, k: next(p.lang for p in got[i].positions if p.start <= k < p.end)
    assert at(300, 50) == "en" and at(300, len(mixed) - 20) == "zh"


def test_segments_hold_every_byte_once_at_character_borders():
    for text in ("", "a", "日本語" * 500, "x" * 1000, "é" * 129, "a " * 400):
        data = language.lowered(text).encode()
        parts = language.cut(data)
        assert b"".join(data[a:b] for _, a, b, _ in parts) == data
        assert all(data[i:j].decode() for first, a, b, last in parts for i, j in ((first, last), (a, b)))
        assert [data[first:last] for first, _, _, last in parts] == language.segments(text)
    params = language.initial(3)
    words = sorted(language.segments("some words " * 60), key=len, reverse=True)
    p, mask, _ = language.network(params, words)
    assert np.abs((language.lean(params, words) - p) * mask[:, :, None]).max() < 1e-5


def test_no_document_is_rejected_by_its_score(spark, monkeypatch):
    """Many languages of the same words: every score is low, and all documents stay."""
    monkeypatch.setattr(language, "LEAST_STEPS", 1)
    rows = [(i, "the same words in all of them", f"l{i % 5}") for i in range(40)] + [(50, "12 34", "l0"), (51, None, "l0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert max(r.score for r in language.identify(docs).collect()) < 0.4
    assert sorted(r.doc_id for r in language.accept(docs).collect()) == list(range(40))


def test_lean_reads_words_of_falling_length_both_ways():
    """Words that end at every step, read backwards from there; each language's probabilities lie together."""
    params = language.initial(5)
    words = [("ab cé"[k % 4 :] * 90).encode()[: 200 - 3 * k] for k in range(60)]
    p, mask, _ = language.network(params, words)
    got = language.lean(params, words)
    assert got.shape == p.shape and np.abs((got - p) * mask[:, :, None]).max() < 1e-5
    assert got[:, :, 0].flags["C_CONTIGUOUS"] and (language.likeliest(got) == got.argmax(2)).all()
    one = language.lean(language.initial(1), words[:2])
    assert (one == 1).all() and not language.likeliest(one).any()


def test_each_direction_reads_a_segment_and_the_context_before_it(monkeypatch):
    """Sums and labels are those of the whole words, but no direction reads the context behind a segment."""
    steps, lean = [], language.lean
    monkeypatch.setattr(language, "TOGETHER", 7)
    monkeypatch.setattr(language, "lean", lambda params, words, read: steps.append((words, read)) or lean(params, words, read))
    model = language.Identifier(language.initial(3), ["a", "b", "c"])
    wanted = set()
    for text in ("some words " * 90, "é日本 " * 150, "x", "ab " * 87, "Hello wörld " * 25):
        data = text.encode()
        wanted |= {(data[first:last], a - first, b - first) for first, a, b, last in language.cut(data)}
    found = model.learn(wanted)
    assert len(wanted) > 14 and set(found) == wanted
    for (word, a, b), (sums, best) in found.items():
        p = language.network(model.params, [word])[0][a:b, 0]
        assert np.abs(p.sum(0) - sums).max() < 1e-3 and (p.argmax(1) == best).all()
    most = language.SEGMENT + language.CONTEXT + 6  # borders of characters
    assert max(len(w) for words, _ in steps for w in words) > most and all(max(read) <= most for _, read in steps)
