"""Licences against plain TF-IDF and a walk up the tree."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from starmart.llm import license_scan as ls
from starmart.llm.queries import ORACLE, op1_license_scan

ROWS = [
    (1, "a/LICENSE", "Released under the MIT License."),
    (2, "a/b/x.py", "nothing here\nat all"),
    (3, "a/b/c/y.py", "code\n# Licensed under the Apache License, Version 2.0.\nmore"),
    (4, "a/b/c/d/z.py", None),
    (5, "a/b/c/w.py", ""),
    (6, "top.py", "the license of this is unclear"),
    (7, None, "Released under the MIT License."),
    (8, "q/COPYING", "This work is licensed\nunder the GNU General Public License,\nversion 3."),
    (9, "q/r/s.txt", "released UNDER the mit LICENSE"),
    (10, "q/r/t/u.txt", "x " * 5000),
    (None, "q/v.txt", "Licensed under CC BY-NC 4.0."),
    (11, "/abs/e.txt", "plain"),
]


def brute(rows):
    words = lambda t: re.findall(ls.TOKEN, (t or "").translate(str.maketrans(ls.UPPER, ls.LOWER)))
    df = Counter(t for _, _, text in rows for t in set(words(text)))
    known = {t for _, text in ls.TEMPLATES for t in words(text)}
    idf = lambda t: math.log((1 + len(rows)) / (1 + (df[t] if t in known else 0))) + 1
    vector = lambda text: {t: n * idf(t) for t, n in Counter(words(text)).items()}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(t, 0) for t, x in a.items()) / norm if norm else 0.0

    own, declared = {}, {}
    for k, (i, path, text) in enumerate(rows):
        units = (text or "").split("\n") + ([text] if text and path and re.search(ls.LICENCE_FILE, path) else [])
        hits = [(cosine(vector(u), vector(t)), name) for u in units for name, t in ls.TEMPLATES]
        best = max([(round(c, 6), name) for c, name in hits if c >= ls.THRESHOLD], default=None)
        if best and i is not None:
            own[k] = best
            if path is not None:
                d = re.sub("/?[^/]*$", "", path)
                declared[d] = min(declared.get(d, (9, "", "")), (-best[0], best[1], path))
    out = []
    for k, (i, path, _) in enumerate(rows):
        if k in own:
            out.append((i, path, own[k][1], own[k][0], "own", None))
            continue
        d, found = path, None
        while d and found is None:
            d = re.sub("/?[^/]*$", "", d)
            found = d if d in declared else None
        out.append((i, path, declared[found][1] if found is not None else None, None, "inherited" if found is not None else "none", found))
    return out


def test_against_plain_code(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, path string, text string, licence string").repartition(3)
    got = list(map(tuple, ls.scan(df, "doc_id", "path").collect()))
    assert sorted(map(str, got)) == sorted(map(str, brute(ROWS)))


def test_empty_table_and_repeated_rows(spark):
    schema = "doc_id long, path string, text string"
    assert ls.scan(spark.createDataFrame([], schema), "doc_id", "path").collect() == []
    twice = spark.createDataFrame([ROWS[0], ROWS[0], ROWS[1]], schema)
    assert sorted(r.origin for r in ls.scan(twice, "doc_id", "path").collect()) == ["inherited", "own", "own"]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_the_sql(spark, sf):
    db = duckdb.connect()
    db.sql(f"create view documents as from '{sf}/documents.parquet'")
    rows = op1_license_scan(spark, sf)
    assert "Python" not in rows._jdf.queryExecution().toString()
    got = sorted(map(str, map(tuple, rows.collect())))
    assert got == sorted(map(str, db.sql(ORACLE["op1_license_scan"]).fetchall()))
    assert any("'own'" in r for r in got)


def test_statements_inside_lines_across_lines_and_whole_texts(spark):
    text = dict(ls.TEXTS)
    wrapped = "This work is licensed under the\nGNU General Public License,\nversion 3."
    header = [t for name, t in ls.HEADERS if name == "Apache-2.0"][0]
    rows = [
        ("// Copyright 2020 Jane Doe. Released under the MIT License.", "MIT"),
        ("Notes. Released under the MIT License. See the appendix.", "MIT"),
        ("A long paragraph on other things, and then: Licensed under CC BY-NC 4.0. It goes on for some more words.", "CC-BY-NC-4.0"),
        ("first\n" + wrapped + "\nlast", "GPL-3.0"),
        ("/*\n * Copyright 2021 X\n *\n * " + "\n * ".join(re.findall(r"(?:\S+\s*){1,9}", header)) + "\n */\nint main() {}", "Apache-2.0"),
        ("// SPDX-License-Identifier: Zlib\ncode", "Zlib"),
        ("/* SPDX-License-Identifier: (GPL-2.0-only OR MIT) */", "GPL-2.0 OR MIT"),
        ("nothing of the kind; the license of this is unclear", None),
        ("Third party parts\n\n" + "some words about them\n" * 40 + text["ISC"] + "more words " * 50, "ISC"),
    ]
    rows += [("Copyright (c) 2020 Some One\n\n" + t, name) for name, t in text.items()]
    # Enough other texts that the weights are those of a table, not of the licences.
    data = [(i, f"{i}/x.py", t) for i, (t, _) in enumerate(rows)] + [(1000 + i, f"others/{i}", f"the words of an other text {i} and that is all to it for you or me") for i in range(300)]
    got = {r.doc_id: r for r in ls.scan(spark.createDataFrame(data, "doc_id long, path string, text string"), "doc_id", "path").collect()}
    assert {i: got[i].licence for i in range(len(rows))} == {i: name for i, (_, name) in enumerate(rows)}
    assert all(r.origin == "none" for i, r in got.items() if i >= 1000)


def test_best_window_is_that_of_plain_code(spark):
    """Every offset counts: the window that running sums choose has the highest cosine of all."""
    rng = random.Random(4)
    idf = {w: 1 + i / 3 for i, w in enumerate("abcdefgh")}
    template = Counter(rng.choice("abcdef") for _ in range(40))
    size = math.sqrt(sum((n * idf[t]) ** 2 for t, n in template.items()))
    docs = {d: [rng.choice("abcdefghij") for _ in range(rng.choice([39, 40, 41, 97, 300]))] for d in "pqrstu"}
    text = spark.createDataFrame(list(docs.items()), "doc string, found array<string>")
    near = spark.createDataFrame([(d, 0, 40, False) for d in docs], "doc string, template int, length int, short boolean")
    parts = spark.createDataFrame([(t, 0, n * idf[t] / size) for t, n in template.items()], "token string, template int, part double")
    weights = spark.createDataFrame(list(idf.items()), "token string, idf double")
    got = {r.doc: r.unit.split() for r in ls.best_windows(text, near, parts, weights, 5.0, 0.1).collect()}

    def cosine(words):
        v = {t: n * idf.get(t, 5.0) for t, n in Counter(words).items()}
        return sum(x * template[t] * idf.get(t, 5.0) for t, x in v.items()) / size / math.sqrt(sum(x * x for x in v.values()))

    assert set(got) == {d for d, found in docs.items() if len(found) > 40}
    for d, unit in got.items():
        best = max(cosine(docs[d][k : k + 40]) for k in range(len(docs[d]) - 39))
        assert len(unit) == 40 and abs(cosine(unit) - best) < 1e-9


def test_edited_headers_and_texts_inside_other_text(spark):
    """Of those found alone at 0 to 16 % changed words, at least 0.9 are found in the midst of other text."""
    rng = random.Random(9)
    sources = [(name, t) for name, t in ls.HEADERS] + [(name, t) for name, t in ls.TEXTS if len(t) < 12_000]
    rows = []
    for share in (0, 0.08, 0.12, 0.16):
        for name, t in sources:
            words = t.split()
            for k in rng.sample(range(len(words)), int(share * len(words))):
                words[k] = f"changed{rng.randint(0, 999)}"
            before, after = ([f"other{rng.randint(0, 400)}" for _ in range(rng.randint(5, 200))] for _ in range(2))
            rows.append((share, name, " ".join(words), " ".join(before + words + after)))
    data = [(2 * i + k, f"{i}/{k}/x", row[2 + k]) for i, row in enumerate(rows) for k in (0, 1)]
    data += [(10_000 + i, f"others/{i}", f"the words of an other text {i} and that is all to it for you or me") for i in range(600)]
    found = {r.doc_id: r.licence for r in ls.scan(spark.createDataFrame(data, "doc_id long, path string, text string"), "doc_id", "path").collect()}
    for share in (0, 0.08, 0.12, 0.16):
        alone = [i for i, row in enumerate(rows) if row[0] == share and found[2 * i] is not None]
        inside = sum(found[2 * i + 1] == found[2 * i] for i in alone)
        print(share, len(alone), inside)
        assert inside >= 0.9 * len(alone)
