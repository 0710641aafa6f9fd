"""Fill-in-the-middle against plain code, and its exact restoration."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, rate=50, spm=80, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def odd_texts():
    rng = random.Random(3)
    bits = ["a", "é", "漢字", "🎈", " ", "\t", "\r\n", "\x0b", "\xa0", " ", "<", "P>", "<S", ">", "<P", "M>", "\0", "w" * 40]
    texts = [None, "", " ", "\n\n", "a", " a", "a ", "<P>", "x<S>y", "<P", "><M", "<<P>>", "a b c " * 5000, "é" * 70_000]
    return texts + ["".join(rng.choices(bits, k=rng.randrange(30))) for _ in range(600)]


@pytest.mark.parametrize("chunk", [7, 1 << 22])
def test_against_plain_code(spark, monkeypatch, chunk):
    monkeypatch.setattr(infill, "CHUNK", chunk)
    texts = odd_texts() if chunk > 7 else odd_texts()[14:200]
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 32, (4, len(texts)))
    n, form, prefix, middle, output = infill.rearranged(pa.array(texts, pa.string()), list(h), 50, 80)
    assert infill.rebuilt(output, form).to_pylist() == [t or "" for t in texts]
    assert {"plain", "spm", "psm"} == set(form)
    ids = list(range(len(texts)))
    digests = [hashlib.sha256(f"42:{i}".encode()).hexdigest() for i in ids]
    h = [np.array([int(d[8 * k : 8 * k + 8], 16) for d in digests]) for k in range(4)]
    got = infill.rearranged(pa.array(texts, pa.string()), h, 50, 80)
    rows = list(zip(got[0].tolist(), *got[1:4], got[4].to_pylist(), strict=True))
    assert rows == [brute(i, t) for i, t in zip(ids, texts, strict=True)]


def test_slice_of_an_array():
    texts = pa.array(["zz <P> zz", "one two", None, "three", "<S>"])
    h = [np.array([1, 0, 5]), np.array([2, 0, 1]), np.zeros(3, int), np.array([0, 90, 0])]
    n, form, _, _, output = infill.rearranged(texts.slice(1, 3), h, 50, 80)
    assert n.tolist() == [2, 0, 1] and form == ["spm", "plain", "spm"]
    assert output.to_pylist() == ["<S><P>one<M> two", "", "<S><P>three<M>"]


def test_tables(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(odd_texts())] + [(None, "a b", 1, "y"), (1, "again a row", 2, "z"), (1, "again a row", 2, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, output string").repartition(5)
    got = infill.restore(infill.transform(df)).collect()
    want = sorted((repr((d, *brute(d, t))) for d, t, *_ in rows))
    assert sorted(repr(tuple(r)[:6]) for r in got) == want
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t, *_ in rows)
    assert infill.transform(df, rate=0).where("form <> 'plain'").count() == 0
    assert {r.form for r in infill.transform(df, rate=100, spm=0).collect()} == {"plain", "psm"}
    empty = infill.restore(infill.transform(df.limit(0)))
    assert empty.collect() == [] and empty.columns[-1] == "restored"
    names = df.select(df.doc_id.alias("key"), df.text.alias("body"))
    assert infill.transform(names, id_col="key", text_col="body").count() == len(rows)


def test_errors(spark):
    df = spark.createDataFrame([("a", "spm", "")], "output string, form string, restored string")
    with pytest.raises(ValueError, match="restored"):
        infill.restore(df)
    with pytest.raises(ValueError, match="three"):
        infill.rebuilt(pa.array(["<P>a"]), ["psm"])
