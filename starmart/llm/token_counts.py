"""Exact token counts at every prefix of a text, by dynamic programming.

The vocabulary merges over the whole text, but no piece holds a blank behind
another character and characters outside the vocabulary never merge, so a text
falls into units that are encoded alone: blanks with the word behind them, and
single characters outside the vocabulary.  Within a unit the count at a prefix
is the count before its last token, plus one (``bpe.prefix_counts``).
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmart.llm import bpe
from starmart.llm.common import WordCache, forgets, map_slices, picked

BLANK = "▁"
#: Words whose counts a worker remembers.
WORDS_KEPT = 700_000


class PieceVocabulary:
    """A sentencepiece BPE model with byte fallback, a dummy blank and no other normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [
            i for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        ids = {model.id_to_piece(i): i for i in plain}
        cost = {p: -model.get_score(i) for p, i in ids.items()}
        if any(BLANK in p.lstrip(BLANK) for p in ids):
            raise ValueError("a piece holds a blank behind another character")
        self.merges = bpe.Merges(ids, lambda a, b: cost.get(a + b))
        self.known = frozenset(c for c in "".join(ids))
        self.of_word = WordCache(WORDS_KEPT)  # by the word behind a single blank
        self.of_unit = WordCache(100_000)

    def units(self, text: str) -> list[str]:
        """Units of a text that begins with its dummy blank; their join is the text."""
        return re.findall(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+", text)

    def unit_counts(self, unit: str) -> list[int]:
        """Counts at every prefix of a unit; an outside character counts its bytes."""
        if self.known.issuperset(unit):
            return bpe.prefix_counts(self.merges, unit)
        counts, run = [0], ""
        for c in [*unit, None]:
            if c is not None and c in self.known:
                run += c
                continue
            if run:
                base = counts[-1]
                counts.extend(base + n for n in bpe.prefix_counts(self.merges, run)[1:])
                run = ""
            if c is not None:
                counts.append(counts[-1] + len(c.encode()))
        return counts

    def unit_count(self, unit: str) -> int:
        """Tokens of a unit, remembered; its lines are counted apart, as no piece holds a line break."""
        n = self.of_unit.get(unit)
        if n is None:
            lines = unit.split("\n")
            if len(lines) > 1 and "\n" not in self.known:
                return len(lines) - 1 + sum(self.unit_count(x) for x in lines if x)
            n = self.unit_counts(unit)[-1]
            if len(unit) <= 64:
                self.of_unit.make_room(1)
                self.of_unit[unit] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text; none for an empty one."""
        if not text:
            return 0
        units = (BLANK + text.replace(" ", BLANK)).split(BLANK)[1:]
        if "" in units:
            return sum(map(self.unit_count, self.units(BLANK + text.replace(" ", BLANK))))
        counts = list(map(self.of_word.get, units))
        if None in counts:
            for i, word in enumerate(units):
                if counts[i] is None:
                    counts[i] = n = self.unit_count(BLANK + word)
                    if len(word) <= 64:
                        self.of_word.make_room(1)
                        self.of_word[word] = n
        return sum(counts)

    def prefix_counts(self, text: str) -> np.ndarray:
        """Entry i: tokens of ``text[:i]``; n_chars + 1 entries."""
        if not text:
            return np.zeros(1, np.int64)
        total, parts = 0, []
        for unit in self.units(BLANK + text.replace(" ", BLANK)):
            counts = np.array(self.unit_counts(unit)[1:], np.int64) + total
            parts.append(counts)
            total = int(counts[-1])
        counts = np.concatenate(parts)
        counts[0] = 0  # the dummy blank alone stands for the empty text
        return counts


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


forgets.append(vocabulary.cache_clear)


def count_tokens(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens (long), over_limit (n_tokens > limit).

    One row for each input row, repeated rows and null ids included; a null or
    empty text has 0 bytes and 0 tokens.
    """
    schema = T.StructType().add("doc_id", df.schema[id_col].dataType).add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(rows: dict[str, list]) -> list[list]:
        v = vocabulary(path)
        texts = [t or "" for t in rows["text"]]
        n = list(map(v.count, texts))
        return [rows["doc_id"], [len(t.encode()) for t in texts], n, [x > limit for x in n]]

    return map_slices(picked(df, doc_id=id_col, text=text_col), run, schema)


def truncation_points(df: DataFrame, path: str, budgets: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Longest prefix within each token budget, read off the prefix counts.

    Returns for each input row and budget: doc_id, budget (long), n_chars (code
    points kept), n_tokens (tokens of that prefix).  Null texts count as empty.
    """
    schema = T.StructType().add("doc_id", df.schema[id_col].dataType).add("budget", "long").add("n_chars", "long").add("n_tokens", "long")

    def run(rows: dict[str, list]) -> list[list]:
        v, out = vocabulary(path), []
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            counts = v.prefix_counts(text or "")
            for budget in budgets:
                at = int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0
                out.append((doc_id, budget, at, int(counts[at])))
        return [list(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]

    return map_slices(picked(df, doc_id=id_col, text=text_col), run, schema)
