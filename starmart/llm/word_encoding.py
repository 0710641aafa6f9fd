"""BPE encoding and decoding with a word-end vocabulary by prefix-sharing tries.

Texts are normalised and cut into words as the vocabulary file asks (NFC, white
space to blanks, lower case; contractions, letter runs, single numbers, other
runs).  The distinct words of a slice that the worker hasn't met go into a trie
whose depth-first walk gives all their encodings (``bpe.trie_encode``).
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmart.llm import bpe
from starmart.llm.common import WordCache, forgets, map_slices, picked

#: Distinct words in one trie.
TRIE_WORDS = 20_000
#: Words whose ids a worker remembers; their chunks are cheap to put together again.
WORDS_KEPT = 700_000
#: White space of str.split() that the file's \\s doesn't hold.
SEPARATORS = "\x1c\x1d\x1e\x1f"


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte: itself if visible in Latin-1, else 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordVocabulary:
    """A tokenizer file: byte-level BPE with word ends, its specials and its word pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.merges = bpe.Merges(ids, lambda a, b: rank.get((a, b)), self._symbols)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.alphabet = byte_alphabet()
        self.of_word = WordCache(WORDS_KEPT)
        self.of_chunk = WordCache()

    def _symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def chunks(self, text: str) -> list[str]:
        """Normalised text, cut at white space; no word crosses it."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()  # each letter by itself: no final sigma
        if any(c in text for c in SEPARATORS):
            return regex.split(r"\s+", text)
        return text.split()

    def byte_word(self, word: str) -> str:
        return "".join(map(self.alphabet.__getitem__, word.encode()))

    def learn(self, chunks: set[str]) -> None:
        """Fill the cache with the ids of the given chunks (LE uint32 bytes)."""
        words = {c: [self.byte_word(w) for w in self.words.findall(c)] for c in chunks}
        needed = {w for ws in words.values() for w in ws}
        self.of_word.make_room(sum(w not in self.of_word for w in needed))
        fresh = [w for w in needed if w not in self.of_word]
        for start in range(0, len(fresh), TRIE_WORDS):
            for word, ids in bpe.trie_encode(self.merges, fresh[start : start + TRIE_WORDS], self.end).items():
                self.of_word[word] = np.array(ids, "<u4").tobytes()
        self.of_chunk.make_room(len(chunks))
        for chunk, parts in words.items():
            self.of_chunk[chunk] = b"".join(map(self.of_word.__getitem__, parts))

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian unsigned 32-bit integers."""
        cut: list[list] = []
        for text in texts:
            if any(s in text for s in self.special):
                pieces = self.specials.split(text)
                cut.append([p if p in self.special else self.chunks(p) for p in pieces])
            else:
                cut.append([self.chunks(text)])
        wanted = {c for pieces in cut for p in pieces if isinstance(p, list) for c in p}
        missing = {c for c in wanted if c not in self.of_chunk}
        if missing:
            self.of_chunk.make_room(len(missing))
            self.learn({c for c in wanted if c not in self.of_chunk})
        chunk = self.of_chunk.__getitem__
        return [
            b"".join(self.special[p].to_bytes(4, "little") if isinstance(p, str) else b"".join(map(chunk, p)) for p in pieces)
            for pieces in cut
        ]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by blanks: the file names no decoder."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordVocabulary:
    return WordVocabulary(path)


forgets.append(vocabulary.cache_clear)


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns one row for each input row, repeated rows and null ids included:
    doc_id, n_tokens (long), ids (binary: little-endian unsigned 32-bit), decoded
    (string).  A null text counts as empty: no ids, decoded "".
    """
    schema = T.StructType().add("doc_id", df.schema[id_col].dataType).add("n_tokens", "long").add("ids", "binary").add("decoded", "string")

    def run(rows: dict[str, list]) -> list[list]:
        v = vocabulary(path)
        ids = v.encode_texts([t or "" for t in rows["text"]])
        return [rows["doc_id"], [len(x) // 4 for x in ids], ids, list(map(v.decode, ids))]

    return map_slices(picked(df, doc_id=id_col, text=text_col), run, schema)
