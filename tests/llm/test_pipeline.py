"""The corpus pipeline stage by stage against plain code over its own input."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from starmart.llm import language, quality
from starmart.llm.common import table
from tests.llm.test_encoding import check_packing
from tests.llm.test_minhash import brute
from tests.llm.test_pii import base_spans

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_code(spark, tmp_path):
    docs = table(spark, SF, "documents")
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        before = {r.doc_id: r for r in docs.collect()}
        after = spark.read.parquet(f"{tmp_path}/{name}")
        rows = after.collect()
        if name == "quality":
            weights = quality.fit(quality.examples(docs, table(spark, SF, "labels")))
            assert {r.doc_id for r in rows} == {i for i, r in before.items() if quality.rate(weights, r.text) >= 0.3}
            labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            assert {i for i, q in labels.items() if q == 1} <= {r.doc_id for r in rows}
        elif name == "language":
            found = language.Identifier(*language.fit(docs)).predict([r.text for r in before.values()])
            keep = {i for i, (lang, s) in zip(before, found, strict=True) if lang != "und" and s >= language.LEAST_SCORE}
            assert {r.doc_id for r in rows} == keep and len(keep) >= 0.98 * len(before)
        elif name == "minhash":
            assert sorted(r.doc_id for r in rows) == [i for i, _, _, kept in brute([(i, r.text) for i, r in before.items()], 5, 80) if kept]
        elif name == "pii":
            assert {r.doc_id for r in rows} == before.keys()
            for r in rows:
                text, at = before[r.doc_id].text, 0
                if not (found := base_spans(text)):
                    assert r.text == text
                    continue
                for kind, a, b in sorted(found, key=lambda s: (s[1], s[2])):
                    assert f"<{kind}>" in r.text and (text[a:b] not in r.text or text.count(text[a:b]) > 1)
                    at = b
                assert r.n_chars == len(r.text) and at
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            lengths = {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in before.items()}
            totals = dict.fromkeys(lengths, 0)
            for r in rows:
                totals[r.doc_id] += r.length
            assert totals == lengths
            assert check_packing(rows, 2048) <= sum(lengths.values()) // 2048 + 2
        docs = after


def test_run_equals_its_stages(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and all(re.fullmatch("[0-9]+", str(r.sequence_id).lstrip("-")) for r in rows)
    assert np.all([r.length <= 2048 for r in rows])


def test_edge_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "the cat", "en", "s", 7), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    for docs in (spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() >= 0, name
            if name != "packing":
                docs = out
