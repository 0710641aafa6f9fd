"""Encoders against the libraries whose vocabulary files they read."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starmart.llm import packing, token_counts, word_encoding
from starmart.llm.queries import op3_best_fit_packing, op7_token_counts, op9_word_encoding

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

ODD = [
    "", " ", "  x", " " * 40, " " * 37 + "the", "a\n\n b", "▁x", "é́̂ x", "日本語 テキスト", "\U0001f600 x", "a\tb\tc",
    "ΑΣ ΣΑΣ", "İstanbul'S I'LL don't", "x\x1cy \x1dz", "<|endoftext|>Hi<|startoftext|> you<|endoftext|>", "</w> a</w>",
    "é Å", "1234 ٣٤ Ⅷ", "\x00\x01", "​ z y\u0085q", "a" * 5000, "<s> <unk> </s> <0x41>", "x " * 3000,
]


def odd_texts() -> list[str]:
    rng = random.Random(7)
    letters = " \n▁aetéthin'.,$#0 12日x\xa0\tß>Ŀ"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(500)]


def test_piece_counts_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = token_counts.vocabulary(PIECES)
    for text in odd_texts():
        assert own.count(text) == len(library.encode(text)), text


@pytest.mark.parametrize("text", ["hello  there, wörld\n\nx", " the  the日本 then", ""])
def test_every_prefix_count_equals_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = token_counts.vocabulary(PIECES).prefix_counts(text)
    assert counts.tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


def test_truncation_points(spark):
    df = spark.createDataFrame([(1, "hello there world", "x"), (2, None, "y"), (None, "a", "z")], "doc_id long, text string, budget string")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in token_counts.truncation_points(df, PIECES, [0, 2, 100]).collect():
        text = {1: "hello there world", 2: "", None: "a"}[r.doc_id][: r.n_chars]
        assert r.n_tokens == len(library.encode(text)) <= r.budget


def test_word_ids_and_decoding_equal_the_library():
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    own = word_encoding.WordVocabulary(WORDS)
    texts = odd_texts()
    for text, ids in zip(texts, own.encode_texts(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_byte_ids_equal_the_library():
    library = Tokenizer.from_file(BYTES)
    own = packing.ByteVocabulary(BYTES)
    for text in odd_texts():
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_caches_that_start_anew_change_nothing():
    texts = odd_texts()
    own = word_encoding.WordVocabulary(WORDS)
    expected = own.encode_texts(texts)
    own.of_chunk.limit = own.of_word.limit = 5
    own.of_chunk.clear(), own.of_word.clear()
    assert [own.encode_texts([t])[0] for t in texts] == expected


EDGE = [(1, "Hello there", "a"), (1, "Hello there", "a"), (None, "x", "b"), (2, None, "c"), (3, "", None)]


@pytest.mark.parametrize("rows", [EDGE, []])
def test_row_per_input_row_with_clashing_columns(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    counted = token_counts.count_tokens(df, PIECES, 4096).collect()
    coded = word_encoding.encode_decode(df, WORDS).collect()
    assert len(counted) == len(coded) == len(rows)
    assert all((r.n_tokens, r.n_bytes) == (0, 0) for r in counted if r.doc_id in (2, 3))
    assert all(bytes(r.ids) == b"" and r.decoded == "" for r in coded if r.doc_id in (2, 3))
    packed = packing.pack(packing.token_pieces(df, BYTES)).collect()
    assert len(packed) == len(rows)


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_is_gapless_and_tight(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(1, 64)) for i in range(3000)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, length long"), 64, shard_pieces=1000).collect()
    assert sorted((r.doc_id, r.length) for r in packed) == sorted(rows)
    assert check_packing(packed, 64) <= 1.03 * sum(n for _, n in rows) / 64


def test_best_fit_equals_a_scan_of_all_open_sequences():
    rng = random.Random(5)
    lengths = sorted((rng.randint(1, 100) for _ in range(1500)), reverse=True)
    rooms: list[int] = []
    for n in lengths:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(100 - n)
    sequences, _ = packing.best_fit(lengths, 100)
    left = [100] * len(set(sequences))
    for s, n in zip(sequences, lengths, strict=True):
        left[s] -= n
    assert sorted(left) == sorted(rooms)


def test_best_fit_takes_the_tightest_sequence():
    assert packing.best_fit([7, 6, 3, 2, 2], 10) == ([0, 1, 0, 1, 1], [0, 0, 7, 6, 8])


def test_queries_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in op7_token_counts(spark, sf).collect():
        n = len(pieces.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
    words = Tokenizer.from_file(WORDS)
    for r in op9_word_encoding(spark, sf).collect():
        ids = words.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(words.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert r.n_tokens == len(ids)


def test_packing_query_on_the_small_tables(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(BYTES)
    rows = op3_best_fit_packing(spark, sf).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    total = 0
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = [*library.encode(d.text, add_special_tokens=False).ids, 0]
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(by.pop(d.doc_id), key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not by
    assert check_packing(rows, 2048) <= total // 2048 + 2


def test_a_worker_forgets_what_another_operator_left():
    from starmart.llm import common

    common.working_for("one")
    kept = token_counts.vocabulary(PIECES)
    common.working_for("one")
    assert token_counts.vocabulary(PIECES) is kept
    common.working_for("two")
    assert token_counts.vocabulary(PIECES) is not kept


@pytest.mark.parametrize("run", ["a", "漢", " ", "ab", "q7"])
def test_long_runs_equal_the_libraries(run):
    """A run without blanks is worked through once, whatever its length."""
    text = (run * 40_000)[:40_000]
    assert token_counts.vocabulary(PIECES).count(text) == len(sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text))
    words = word_encoding.vocabulary(WORDS)
    want = Tokenizer.from_file(WORDS).encode(text[:4000], add_special_tokens=False).ids
    assert np.frombuffer(words.encode_texts([text[:4000]])[0], "<u4").tolist() == want
    ids = np.frombuffer(words.encode_texts([text])[0], "<u4")
    assert "".join(words.token[i] for i in ids.tolist()).replace("</w>", "") == words.byte_word(text.strip())
