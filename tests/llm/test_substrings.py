"""Recurring passages against plain code over all windows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from starmart.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window=50):
    """(doc_id, n_words, n_removed, kept) of every row."""
    first, rows = {}, []
    for i, text in docs:
        words = WORD.findall(text or "")
        rows.append((i, words))
        for k in range(len(words) - window + 1):
            view = tuple(words[k : k + window])
            if i is not None and (view not in first or i < first[view]):
                first[view] = i
    out = []
    for i, words in rows:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def corpus(seed, n=80, vocabulary=40, window=50):
    """Texts with shared passages: copies, edited copies, passages in the midst of others, repeats."""
    rng = random.Random(seed)

    def prose(k):
        return [f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.9 else "the" for _ in range(k)]

    shared = [prose(rng.randrange(window - 2, 4 * window)) for _ in range(6)]
    docs, order = [], list(range(n))
    rng.shuffle(order)
    for k in order:
        kind = rng.randrange(7)
        if kind == 0:
            words = prose(rng.randrange(3 * window))
        elif kind == 1:
            words = prose(rng.randrange(30)) + rng.choice(shared) + prose(rng.randrange(30))
        elif kind == 2:
            words = list(rng.choice(shared))
            words[rng.randrange(len(words))] = "edited"
        elif kind == 3:
            words = rng.choice(shared) + rng.choice(shared)
        elif kind == 4:
            words = ["again"] * rng.randrange(3 * window)
        elif kind == 5 and docs:
            words = WORD.findall(rng.choice(docs)[1])[rng.randrange(10) :]
        else:
            words = (prose(7) * (window // 2))[: rng.randrange(3 * window)]
        docs.append((k, rng.choice([" ", "\n", " \t "]).join(words)))
    return docs


@pytest.mark.parametrize(("seed", "window", "phrase", "vocabulary"), [(1, 50, 20, 40), (2, 12, 5, 3), (3, 10, 10, 2), (4, 9, 1, 3), (5, 50, 20, 2)])
def test_against_plain_code(spark, monkeypatch, seed, window, phrase, vocabulary):
    monkeypatch.setattr(substrings, "FEW", 2)
    docs = corpus(seed, vocabulary=vocabulary, window=window)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = substrings.remove_repeats(df, window, phrase, shard_bytes=3000)
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, window))
    assert got.agg({"n_removed": "sum"}).first()[0] > 0


def test_rows_of_every_kind(spark):
    passage = " ".join(f"p{k}" for k in range(70))
    docs = [(5, passage), (3, f"x {passage} y"), (3, passage), (9, passage), (9, passage), (None, passage), (1, None), (2, ""), (4, " \n"), (6, "a\xa0b c " * 60),
            (7, "long " * 30_000), (8, "long " * 20_000 + passage)]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, part int, kept string")
    got = substrings.remove_repeats(df).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(docs)))
    assert substrings.remove_repeats(df.limit(0)).collect() == []
    named = spark.createDataFrame([(f"id{i}", t) for i, t in docs if i], "key string, body string")
    want = sorted(brute([(f"id{i}", t) for i, t in docs if i]))
    assert sorted(map(tuple, substrings.remove_repeats(named, id_col="key", text_col="body").collect())) == want
    with pytest.raises(ValueError, match="phrase"):
        substrings.remove_repeats(df, 10, 11)


def test_equal_windows_have_equal_segments():
    """A window's phrase and its place depend on the window alone."""
    rng = random.Random(2)
    inner = [f"i{rng.randrange(30)}".encode() for _ in range(120)]
    a = substrings.Segments([b"a%d" % k for k in range(33)] + inner, 50, 20)
    b = substrings.Segments(inner + [b"b%d" % k for k in range(60)], 50, 20)

    def phrases(s, shift):
        return {w - shift: (s.at[i] - w, int(s.anchor[i])) for i in range(len(s.low)) for w in range(s.low[i], s.high[i]) if 0 <= w - shift <= 70}

    assert phrases(a, 33) == phrases(b, 0)
    whole = set(map(int, np.concatenate([a.windows(i) for i in range(len(a.low))])))
    assert {int(h) for i in range(len(b.low)) for w, h in zip(range(b.low[i], b.high[i]), b.windows(i)) if w <= 70} <= whole


def test_automaton_with_many_words(monkeypatch):
    """Words are told apart far beyond the characters of one place."""
    assert len({substrings.spelling(n) for n in range(40_000)}) == 40_000
    automaton = substrings.PhraseAutomaton(4, 2)
    for k in range(400):
        automaton.add(k, 1, " ".join(f"{k}.{j}" for j in range(6)))
    automaton.compile()
    words = [b"?", *(b"300.%d" % j for j in range(6)), b"?", b"20.1", b"20.2", b"20.3", b"20.4", b"20.5", b"21.1", b"21.2"]
    assert list(automaton.found(1000, words)) == [(1, 7), (8, 13)]
    assert list(automaton.found(20, words)) == []
