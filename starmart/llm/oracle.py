"""DuckDB SQL for the queries that it can express on whole tables."""

from __future__ import annotations

OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT reach.doc_id, ends.y FROM reach JOIN ends ON ends.x = reach.other
), smallest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN smallest USING (doc_id)
"""

OP5 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
    sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), usable AS (SELECT * FROM vectors WHERE norm > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
), counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.other
), smallest AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN smallest USING (vec_id) LEFT JOIN counts ON counts.x = e.vec_id
"""

#: CRC-32 is linear: a feature's value is the exclusive or of what each byte contributes at its
#: distance from the end, and of the start value moved on by the length.
OP11 = r"""
WITH RECURSIVE texts AS (
  SELECT 's' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark
), words AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), features AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
), spelt AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
bytes AS (
  SELECT f, len(h) // 2 - i AS back,
    16 * (instr('0123456789ABCDEF', substr(h, 2 * i - 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * i, 1)) - 1 AS byte
  FROM (SELECT f, h, unnest(range(1, len(h) // 2 + 1)) AS i FROM spelt)
), one AS (
  SELECT b, list_reduce(list_concat([b], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
  FROM (SELECT unnest(range(256)) AS b)
), longest AS (SELECT max(len(h) // 2) AS n FROM spelt),
moved(back, b, v) AS (
  SELECT 0::BIGINT, b, v FROM one
  UNION ALL SELECT moved.back + 1, moved.b, xor(moved.v // 256, one.v)
  FROM moved JOIN one ON one.b = moved.v % 256 WHERE moved.back < (SELECT n FROM longest)
), begun(n, v) AS (
  SELECT 0::BIGINT, 4294967295::BIGINT
  UNION ALL SELECT begun.n + 1, xor(begun.v // 256, one.v) FROM begun JOIN one ON one.b = begun.v % 256 WHERE begun.n < (SELECT n FROM longest)
), crc AS (
  SELECT f, xor(xor(bit_xor(moved.v), any_value(begun.v)), 4294967295) % 10000 AS bucket
  FROM bytes JOIN moved ON moved.back = bytes.back AND moved.b = bytes.byte
  JOIN spelt USING (f) JOIN begun ON begun.n = len(spelt.h) // 2 GROUP BY f
), held AS (SELECT side, id, bucket FROM features JOIN crc USING (f)),
counts AS (
  SELECT b AS bucket, CAST(count(*) FILTER (side = 's') AS DOUBLE) AS s, CAST(count(*) FILTER (side = 't') AS DOUBLE) AS t
  FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN held ON held.bucket = b GROUP BY b
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM counts
), summed AS (
  SELECT id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM held JOIN gains USING (bucket) WHERE side = 's' GROUP BY id
), scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST(('0x' || substr(sha256('7:' || id), 1, 8)) AS BIGINT) AS h
  FROM words LEFT JOIN summed USING (id) WHERE side = 's'
), final AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= 20) OVER () AS n FROM final
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM placed
"""

OP12 = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS view
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
), firsts AS (SELECT view, min(doc_id) AS first FROM windows GROUP BY view),
covered AS (
  SELECT doc_id, list(DISTINCT k) AS gone
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN firsts USING (view) WHERE first < doc_id)
  GROUP BY doc_id
), left_over AS (
  SELECT doc_id, array_to_string(list(word ORDER BY k), ' ') AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM words)
  WHERE (doc_id, k) NOT IN (SELECT doc_id, unnest(gone) FROM covered)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

OP13 = r"""
WITH parts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || doc_id) AS hex
  FROM documents
), hashed AS (
  SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda i: CAST(('0x' || substr(hex, i, 8)) AS BIGINT)) AS h FROM parts
), cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b FROM hashed
), cased AS (
  SELECT doc_id, text, n,
    array_to_string(u[1 : a], '') AS pre, array_to_string(u[a + 1 : b], '') AS mid, array_to_string(u[b + 1 : n], '') AS suf,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
      WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(len(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(len(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cased
"""

#: The statements of the licence scan, spelt out for the SQL.
STATEMENTS = """
  (1, 'Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
  (2, 'Apache-2.0', 'Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.'),
  (3, 'BSD-2-Clause', 'Released under the BSD 2-Clause License.'),
  (4, 'BSD-3-Clause', 'Released under the BSD 3-Clause License.'),
  (5, 'CC-BY-4.0', 'Licensed under CC BY 4.0.'),
  (6, 'CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.'),
  (7, 'CC-BY-SA-4.0', 'Licensed under CC BY-SA 4.0.'),
  (8, 'CC0-1.0', 'To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.'),
  (9, 'GPL-2.0', 'This work is licensed under the GNU General Public License, version 2.'),
  (10, 'GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
  (11, 'LGPL-3.0', 'This work is licensed under the GNU Lesser General Public License, version 3.'),
  (12, 'MIT', 'Released under the MIT License.'),
  (13, 'MIT', 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.'),
  (14, 'MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.')
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TOKENS = "regexp_extract_all(" + _LOWER + ", '[a-z0-9]+(?:[.+-][a-z0-9]+)*')"


def op1(threshold: float) -> str:
    """Every line of every document against every statement, without a prefilter."""
    return f"""
WITH statements(id, licence, line) AS (VALUES {STATEMENTS}),
parts AS (SELECT id, licence, unnest({_TOKENS.format("line")}) AS token FROM statements),
template_tf AS (SELECT id, licence, token, count(*) AS tf FROM parts GROUP BY ALL),
seen AS (SELECT doc_id, unnest(list_distinct({_TOKENS.format("text")})) AS token FROM documents),
df AS (SELECT token, count(*) AS n FROM seen WHERE token IN (SELECT token FROM parts) GROUP BY token),
total AS (SELECT count(*) AS n FROM documents),
idf AS (
  SELECT DISTINCT token, ln((1 + total.n) / (1 + coalesce(df.n, 0))) + 1 AS idf
  FROM parts LEFT JOIN df USING (token), total
), template AS (SELECT id, licence, token, tf * idf AS w FROM template_tf JOIN idf USING (token)),
template_norm AS (SELECT id, sqrt(sum(w * w)) AS norm FROM template GROUP BY id),
lines AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
line_tokens AS (SELECT line, unnest({_TOKENS.format("line")}) AS token FROM (SELECT DISTINCT line FROM lines)),
line_tf AS (SELECT line, token, count(*) AS tf FROM line_tokens GROUP BY ALL),
line_w AS (
  SELECT line, token, tf * coalesce(idf, ln(1 + total.n) + 1) AS w
  FROM line_tf LEFT JOIN idf USING (token), total
), line_norm AS (SELECT line, sqrt(sum(w * w)) AS norm FROM line_w GROUP BY line),
cosine AS (
  SELECT l.line, t.id, t.licence, sum(l.w * t.w) / (any_value(ln.norm) * any_value(tn.norm)) AS c
  FROM line_w l JOIN template t USING (token) JOIN line_norm ln ON ln.line = l.line
  JOIN template_norm tn ON tn.id = t.id GROUP BY ALL
), own AS (
  SELECT doc_id, max({{'similarity': round(c, 6), 'licence': licence}}) AS best
  FROM lines JOIN cosine USING (line) WHERE c >= {threshold} GROUP BY doc_id
), placed AS (
  SELECT d.doc_id, concat_ws('/', source, array_to_string(string_split(CAST(d.doc_id // 10 AS VARCHAR), ''), '/')) AS dir,
    own.best.licence AS licence, own.best.similarity AS similarity
  FROM documents d LEFT JOIN own ON own.doc_id = d.doc_id
), declared AS (
  SELECT dir AS above, min({{'less': -similarity, 'licence': licence, 'path': dir || '/' || CAST(doc_id AS VARCHAR)}}).licence AS held
  FROM placed WHERE licence IS NOT NULL GROUP BY dir
), nearest AS (
  SELECT p.doc_id, max_by(declared.above, length(declared.above)) AS above, max_by(held, length(declared.above)) AS held
  FROM placed p JOIN declared ON p.dir = declared.above OR starts_with(p.dir, declared.above || '/')
  WHERE p.licence IS NULL GROUP BY p.doc_id
)
SELECT p.doc_id, p.dir || '/' || CAST(p.doc_id AS VARCHAR) AS path, coalesce(p.licence, held) AS licence, similarity,
  CASE WHEN p.licence IS NOT NULL THEN 'own' WHEN held IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN p.licence IS NULL THEN above END AS directory
FROM placed p LEFT JOIN nearest USING (doc_id)
"""
