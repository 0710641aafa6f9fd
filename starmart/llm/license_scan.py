"""Licence scan: TF-IDF cosine to templates, then inheritance from ancestor directories.

Units are the lines of every text, the text as a whole, and windows of each
template's number of tokens, across line breaks and at every token.  Token
weights use document frequencies over all texts.  A unit that reaches the
threshold with a template must hold one of its anchors, tokens without which
the others can't reach it, and its text tokens that make up the threshold's
share of the template; windows are looked for only there, and equal texts and
equal units are worked out once.  Short windows are cut; of a header's or a
licence text's windows running sums find the one of the highest cosine.

An SPDX tag states its licence itself, with similarity 1.

A file's licence holds for its directory; where files of a directory differ,
the most similar one does, then the first by name and path.  A file without a
licence takes that of its nearest ancestor directory, by joins of directories
with all their ancestors.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import picked
from starmart.session import ensure_checkpoint_dir

THRESHOLD = 0.8
TOKEN = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Files named like a licence; the scan reads every text as a whole, whatever its name.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"
#: The licence, or the expression of licences, behind an SPDX tag.
SPDX = r"(?i)spdx-license-identifier:[ \t]*\(?([a-z0-9][a-z0-9.+-]*(?:[ \t]+(?:and|or|with)[ \t]+[a-z0-9][a-z0-9.+-]*)*)"
#: Windows of longer templates are found by running sums.
SHORT = 31

# Licence statements, headers and (in the folder) texts to compare with.
STATEMENTS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
HEADERS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
TEXTS = tuple((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licences").glob("*.txt")))
TEMPLATES = STATEMENTS + HEADERS + TEXTS


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(TOKEN), F.lit(0))


def template_tokens(templates: tuple) -> list[tuple[str, dict[str, int]]]:
    out = []
    for licence, text in templates:
        found = re.findall(TOKEN, text.lower())
        out.append((licence, {t: found.count(t) for t in found}))
    return out


def weights(files: DataFrame, vocabulary: set[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' tokens over all texts, and of any other token.

    The driver gets one count for each token of the templates.
    """
    words = files.sparkSession.createDataFrame([(t,) for t in sorted(vocabulary)], "token string")
    seen = files.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("token")).join(F.broadcast(words), "token")
    counts = {r.token: r.n for r in seen.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = files.count()
    return {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in vocabulary}, math.log(1 + n) + 1


def anchors(templates: list[tuple[str, dict[str, int]]], idf: dict[str, float], threshold: float) -> list[str]:
    """Tokens of which a unit holds at least one if it reaches the threshold with any template.

    Tokens with much weight that few texts hold come first.
    """
    out = set()
    for _, counts in templates:
        squares = {t: (n * idf[t]) ** 2 for t, n in counts.items()}
        rest = total = sum(squares.values())
        for token in sorted(counts, key=lambda t: (-math.log(squares[t]) - idf[t], t)):
            if rest < (threshold * threshold - 1e-6) * total:
                break
            out.add(token)
            rest -= squares[token]
    return sorted(out)


def forms(templates: list[tuple[str, dict[str, int]]], idf: dict[str, float], threshold: float) -> list[tuple]:
    """(template, length, short, starts, needed): how windows for a template are found."""
    out = []
    for k, (licence, counts) in enumerate(templates):
        n = sum(counts.values())
        if n <= SHORT:
            out.append((k, n, True, sorted(counts), anchors([(licence, counts)], idf, threshold)))
        else:
            out.append((k, n, False, [], []))
    return out


def windows(found: Column, form: Column) -> Column:
    """Units of a short form's length from an array of tokens, as texts: one at every token.

    They begin with one of ``starts`` and hold one of ``needed``.
    """
    length, starts, needed = form["length"], form["starts"], form["needed"]
    begin = F.sequence(F.lit(0), F.greatest(F.size(found) - length, F.lit(0)))
    begin = F.filter(begin, lambda k: F.array_contains(starts, F.get(found, k)))
    units = F.transform(begin, lambda k: F.slice(found, k + 1, length))
    units = F.filter(units, lambda u: F.arrays_overlap(u, needed))
    return F.transform(units, lambda u: F.array_join(u, " "))


def best_windows(texts: DataFrame, near: DataFrame, parts: DataFrame, idf: DataFrame, other: float, threshold: float) -> DataFrame:
    """(doc, unit): of all windows of a long form's length, at every token, the one of the highest cosine.

    From one window to the next a token leaves and one enters: both change the
    dot product by their share, and the squared norm by their weight's square
    times twice their count in the window more or less one.  Running sums of
    these changes give every window's cosine at a cost of the text's length.
    """
    long = near.where(~F.col("short")).select("doc", "template", "length")
    rows = texts.join(long, "doc").where(F.size("found") > F.col("length"))
    rows = rows.select("doc", "template", "length", F.size("found").alias("size"), F.posexplode("found").alias("at", "token"))
    rows = rows.join(F.broadcast(idf), "token", "left").join(F.broadcast(parts.select("token", "template", "part")), ["token", "template"], "left")
    rows = rows.withColumn("w", F.coalesce("idf", F.lit(other))).withColumn("share", F.col("w") * F.coalesce("part", F.lit(0.0)))
    rows = rows.repartition("doc", "template").withColumn("turn", F.col("at") / F.col("length"))
    # Frames in lengths of the form; a little less than one leaves out the token just one length away.
    counted = "count(1) over (partition by doc, template, token order by turn range between {} and {})"
    rows = rows.withColumn("before", F.expr(counted.format("0.99999D preceding", "current row")))
    rows = rows.withColumn("after", F.expr(counted.format("current row", "0.99999D following")))
    square = F.col("w") * F.col("w")
    enters = F.struct(F.col("at").alias("at"), F.col("share").alias("dot"), (square * (2 * F.col("before") - 1)).alias("norm"))
    leaves = F.struct((F.col("at") + F.col("length")).alias("at"), (-F.col("share")).alias("dot"), (-square * (2 * F.col("after") - 1)).alias("norm"))
    steps = rows.select("doc", "template", "length", "size", F.explode(F.array(enters, leaves)).alias("s")).select("doc", "template", "length", "size", "s.*")
    upto = Window.partitionBy("doc", "template").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = steps.select("doc", "template", "length", "size", "at", F.sum("dot").over(upto).alias("dot"), F.sum("norm").over(upto).alias("norm"))
    inside = summed.where((F.col("at") >= F.col("length") - 1) & (F.col("at") < F.col("size")) & (F.col("norm") > 0))
    cosine = F.col("dot") / F.sqrt("norm")
    best = inside.where(cosine >= threshold - 1e-6).groupBy("doc", "template").agg(F.max(F.struct(cosine.alias("cosine"), (-F.col("at")).alias("less"), "length")).alias("best"))
    window = F.slice("found", 2 - F.col("best.less") - F.col("best.length"), F.col("best.length"))
    return texts.join(best, "doc").select("doc", F.array_join(window, " ").alias("unit"))


def own_licences(files: DataFrame, templates: tuple, threshold: float) -> DataFrame:
    """(file, licence, similarity): the best template of each file that reaches the threshold."""
    spark = files.sparkSession
    ensure_checkpoint_dir(spark)
    parsed = template_tokens(templates)
    idf, other = weights(files, {t for _, counts in parsed for t in counts})
    words = [*anchors(parsed, idf, threshold), "spdx-license-identifier"]
    pattern = "(?<![a-z0-9])(?:" + "|".join(map(re.escape, words)) + ")(?![a-z0-9])"
    lines = F.filter(F.split("text", "\n", -1), lambda u: lowered(u).rlike(pattern))
    tags = F.transform(F.regexp_extract_all("text", F.lit(SPDX), F.lit(1)), lambda t: F.regexp_replace(t, "(?i)-(only|or-later)(?![a-z0-9.+-])", ""))
    # The few texts that hold an anchor are used several times below: cut here, the table is read once.
    holding = files.where(lowered(F.col("text")).rlike(pattern) & F.col("file").isNotNull())
    doc = F.sha2(F.encode("text", "UTF-8"), 256)
    holding = holding.select("file", doc.alias("doc"), lines.alias("lines"), tags.alias("tags"), tokens(F.col("text")).alias("found")).checkpoint()
    texts = holding.groupBy("doc").agg(*[F.first(c).alias(c) for c in ("lines", "tags", "found")])

    idf_table = spark.createDataFrame([(t, w) for t, w in idf.items()], "token string, idf double")
    size = {k: math.sqrt(sum((n * idf[t]) ** 2 for t, n in counts.items())) for k, (_, counts) in enumerate(parsed)}
    entries = [(t, k, licence, n * idf[t] / size[k]) for k, (licence, counts) in enumerate(parsed) for t, n in counts.items()]
    template_table = spark.createDataFrame(entries, "token string, template int, licence string, part double")
    form_table = spark.createDataFrame(forms(parsed, idf, threshold), "template int, length int, short boolean, starts array<string>, needed array<string>")

    # A unit's cosine is at most the root of the template's share that lies in the text's tokens.
    held = texts.select("doc", F.explode(F.array_distinct("found")).alias("token")).join(F.broadcast(template_table), "token")
    near = held.groupBy("doc", "template").agg(F.sum(F.col("part") * F.col("part")).alias("share"))
    near = near.where(F.col("share") >= threshold * threshold - 1e-6).join(F.broadcast(form_table), "template")
    near = near.select("doc", "template", "length", "short", "starts", "needed").checkpoint()
    short = F.when(F.col("short"), F.struct("length", "starts", "needed"))
    forms_of = near.groupBy("doc").agg(F.collect_list(short).alias("forms"))
    cut = F.flatten(F.transform("forms", lambda f: windows(F.col("found"), f)))
    units = F.array_distinct(F.concat("lines", F.array(F.array_join("found", " ")), cut))
    unit = texts.join(forms_of, "doc").select("doc", F.explode(units).alias("unit"))
    unit = unit.unionByName(best_windows(texts, near, template_table, idf_table, other, threshold))
    keyed = unit.select("doc", F.sha2(F.encode("unit", "UTF-8"), 256).alias("key"), "unit").checkpoint()

    distinct = keyed.groupBy("key").agg(F.first("unit").alias("unit"))
    counted = distinct.select("key", F.explode(tokens(F.col("unit"))).alias("token")).groupBy("key", "token").agg(F.count(F.lit(1)).alias("tf"))
    weighed = counted.join(F.broadcast(idf_table), "token", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    norms = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(template_table), "token").groupBy("key", "template", "licence").agg(F.sum(F.col("w") * F.col("part")).alias("dot"))
    best = F.max(F.struct(F.round(F.col("dot") / F.col("norm"), 6).alias("similarity"), F.col("licence")))
    scored = dots.join(norms, "key").where(F.col("dot") / F.col("norm") >= threshold).groupBy("key").agg(best.alias("best"))
    stated = texts.select("doc", F.explode("tags").alias("licence")).select("doc", F.struct(F.lit(1.0).alias("similarity"), "licence").alias("best"))
    found = keyed.select("doc", "key").distinct().join(scored, "key").select("doc", "best").unionByName(stated)
    by_text = found.groupBy("doc").agg(F.max("best").alias("best"))
    mine = holding.select("file", "doc").join(by_text, "doc").groupBy("file").agg(F.max("best").alias("best"))
    return mine.select("file", "best.licence", "best.similarity").checkpoint()


def parent(path: Column) -> Column:
    """The directory of a path; '' at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(df: DataFrame, id_col: str, path_col: str, text_col: str = "text", templates: tuple = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """id, path, licence, similarity, origin ('own', 'inherited' or 'none'), directory.

    ``directory`` is the one that an inherited licence comes from.  One row for
    each input row; rows of one id share a scan.  A null text or id has no
    licence of its own, a null path neither gives nor inherits one.  Equally
    similar templates: the last licence by name.
    """
    files = picked(df, file=id_col, path=path_col, text=text_col)
    own = own_licences(files, templates, threshold)
    placed = files.select("file", "path", parent(F.col("path")).alias("dir")).join(own, "file", "left")
    stated = placed.where(F.col("licence").isNotNull() & F.col("path").isNotNull())
    first = F.min(F.struct((-F.col("similarity")).alias("less"), F.col("licence"), F.col("path"))).alias("first")
    declared = stated.groupBy("dir").agg(first).select(F.col("dir").alias("above"), F.col("first.licence").alias("held"))
    wanting = placed.where(F.col("licence").isNull() & F.col("path").isNotNull()).select("dir").distinct()
    names = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(names)), lambda k: F.array_join(F.slice(names, F.lit(1), k), "/"))
    lineage = wanting.select("dir", F.posexplode(F.array_distinct(ups)).alias("depth", "above"))
    nearest = lineage.join(declared, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "held")).alias("n"))
    out = placed.join(nearest, "dir", "left")
    mine = F.col("licence").isNotNull()
    inherited = ~mine & F.col("n").isNotNull()
    return out.select(
        F.col("file").alias(id_col),
        F.col("path"),
        F.coalesce("licence", "n.held").alias("licence"),
        "similarity",
        F.when(mine, "own").when(inherited, "inherited").otherwise("none").alias("origin"),
        F.when(inherited, F.col("n.above")).alias("directory"),
    )
