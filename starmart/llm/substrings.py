"""Passages that recur in later documents, found by phrase automata.

A window is a number of consecutive words.  Of each window the phrase (some
consecutive words) with the least hash stands for it, so equal windows have
equal phrases at the same place.  Neighbouring windows with one phrase are a
segment.  In steps:

1. Every text's phrases and segments, as hashes; equal segments are counted
   once, with the smallest and largest document that holds them.
2. Phrases met in different documents recur.  The smallest document of each of
   their segments gives its words: a passage.  Where a phrase has several
   segments, their windows are compared to confirm which passage (that of the
   smallest document with the window) each segment needs.
3. Documents are dealt to shards of bounded size and passages to those shards
   that need them.  A task compiles the phrases of its shard into Aho-Corasick
   automata over words and streams its documents through them: every occurrence
   of a phrase is extended over the passage, word by word, in both directions,
   and goes if a whole window of a smaller document is found.

Hashes only choose what is compared: no word is removed without its text being
found in a smaller document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import SLICE_ROWS, WordCache, forgets, map_slices, mix64, picked, working_for
from starmart.session import scratch_path

WINDOW, PHRASE = 50, 16
#: Bytes of text in a shard, and distinct words in an automaton: bound a task's memory.
SHARD_BYTES, AUTOMATON_WORDS = 4 << 20, 500_000
#: A phrase with more than this share of all segments is matched by a broadcast; there are at most as many.
HOT = 10_000
#: Parts that documents are dealt to before the number of shards is known.
PARTS = 1 << 30
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class WordHashes(WordCache):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hash_of = WordHashes(500_000)
forgets.append(_hash_of.clear)


def split(text: str | None) -> list[bytes]:
    """Words of a text; bytes split at blank, tab, line feed, vertical tab, form feed and carriage return."""
    return (text or "").encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    _hash_of.make_room(len(words))
    return np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))


class Segments:
    """The segments of a text: ``anchor`` (hash of the phrase), ``key`` (hash of words and place),
    ``low`` and ``high`` (first window and the one behind the last), ``at`` (the phrase's first word)."""

    def __init__(self, words: list[bytes], window: int, phrase: int):
        n = len(words)
        powers = np.cumprod(np.full(n, BASE, np.uint64))
        self.inverse = np.cumprod(np.full(n, INVERSE, np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word_hashes(words) * powers)])
        self.window = window
        phrases = self.hashed(np.arange(n - phrase + 1), np.arange(phrase, n + 1))
        width = window - phrase + 1
        least = np.lib.stride_tricks.sliding_window_view(phrases, width).argmin(axis=1) + np.arange(n - window + 1)
        self.low = np.flatnonzero(np.diff(least, prepend=-1))
        self.high = np.append(self.low[1:], n - window + 1)
        self.at = least[self.low]
        self.anchor = phrases[self.at]
        place = (self.at - self.low).astype(np.uint64) << np.uint64(32) | (self.high - self.low).astype(np.uint64)
        self.key = mix64(self.hashed(self.low, self.high - 1 + window) ^ mix64(place + np.uint64(1)))

    def hashed(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words from ``start`` to ``end``, wherever they stand."""
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start])

    def windows(self, i: int) -> np.ndarray:
        """Hashes of the windows of segment ``i``."""
        start = np.arange(self.low[i], self.high[i])
        return self.hashed(start, start + self.window)


def _signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def segments(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """doc_id, part, anchor and key of every text's distinct segments."""
    schema = T.StructType().add("doc_id", docs.schema["doc_id"].dataType).add("part", "integer").add("anchor", "long").add("key", "long")

    def run(rows: dict[str, list]) -> list[list]:
        ids, parts, anchors, keys = [], [], [], []
        for doc_id, part, text in zip(rows["doc_id"], rows["part"], rows["text"], strict=True):
            words = split(text)
            if len(words) < window or doc_id is None:
                continue
            found = Segments(words, window, phrase)
            pairs = set(zip(_signed(found.anchor), _signed(found.key), strict=True))
            ids += [doc_id] * len(pairs)
            parts += [part] * len(pairs)
            anchors += [a for a, _ in pairs]
            keys += [k for _, k in pairs]
        return [ids, parts, anchors, keys]

    return map_slices(docs, run, schema)


def passages(docs: DataFrame, recurring: DataFrame, window: int, phrase: int) -> DataFrame:
    """The words of ``recurring`` segments, from the smallest document that holds each.

    Returns anchor, key, owner, last, at (the phrase's place), passage (words
    joined by a blank) and windows (hashes; null for a phrase's only segment).
    """
    wanted = recurring.groupBy("owner").agg(F.collect_list(F.struct("anchor", "key", "last", "several")).alias("wanted"))
    held = docs.join(wanted, docs["doc_id"] == wanted["owner"]).select("owner", "text", "wanted")
    schema = (
        T.StructType().add("anchor", "long").add("key", "long").add("owner", docs.schema["doc_id"].dataType)
        .add("last", docs.schema["doc_id"].dataType).add("at", "integer").add("passage", "string").add("windows", T.ArrayType(T.LongType()))
    )

    def run(rows: dict[str, list]) -> list[list]:
        out: list[list] = [[] for _ in schema]
        for owner, text, want in zip(rows["owner"], rows["text"], rows["wanted"], strict=True):
            words = split(text)
            if len(words) < window:
                continue  # another row of this id
            found = Segments(words, window, phrase)
            places = {pair: i for i, pair in enumerate(zip(_signed(found.anchor), _signed(found.key), strict=True))}
            for w in want:
                i = places.get((w["anchor"], w["key"]))
                if i is None:
                    continue
                low, high = int(found.low[i]), int(found.high[i])
                text_of = b" ".join(words[low : high - 1 + window]).decode()
                hashes = _signed(found.windows(i)) if w["several"] else None
                for column, value in zip(out, (w["anchor"], w["key"], owner, w["last"], int(found.at[i]) - low, text_of, hashes), strict=True):
                    column.append(value)
        return out

    return map_slices(held, run, schema)


#: Characters that a word is spelt with inside an automaton, and how many there are at each place:
#: nodes have few branches, and no phrase is found across the border of two words.
LETTERS, SPREAD = 3, 128
UNKNOWN = "\0" * LETTERS
#: A phrase with more passages than this finds whole windows in a table instead.
FEW = 8


def spelling(n: int) -> str:
    """The characters of word number ``n``, an own set for each place."""
    return "".join(chr(1 + SPREAD * k + n // SPREAD**k % SPREAD) for k in range(LETTERS))


class PhraseAutomaton:
    """Phrases of passages in an Aho-Corasick automaton that reads whole words, spelt with few characters."""

    def __init__(self, window: int, phrase: int):
        import ahocorasick

        self.window, self.phrase = window, phrase
        self.code: dict[bytes, str] = {}
        self.held: dict[str, list[tuple]] = {}
        self.automaton = ahocorasick.Automaton()

    def add(self, owner: object, at: int, passage: str) -> None:
        words = passage.encode().split()
        for word in words:
            if word not in self.code:
                self.code[word] = spelling(len(self.code))
        coded = "".join(map(self.code.__getitem__, words))
        self.held.setdefault(coded[at * LETTERS : (at + self.phrase) * LETTERS], []).append((owner, at * LETTERS, coded))

    def full(self) -> bool:
        return len(self.code) >= AUTOMATON_WORDS

    def compile(self) -> None:
        for phrase, passages in self.held.items():
            self.automaton.add_word(phrase, (passages, self._table(passages) if len(passages) > FEW else None))
        if self.held:
            self.automaton.make_automaton()
        self.held = {}

    def _table(self, passages: list[tuple]) -> dict[str, object]:
        """The windows of all passages, and the smallest owner of each."""
        size, table = self.window * LETTERS, {}
        for owner, _, coded in passages:
            for low in range(0, len(coded) - size + 1, LETTERS):
                view = coded[low : low + size]
                if view not in table or owner < table[view]:
                    table[view] = owner
        return table

    def found(self, doc_id: object, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """First word and the one behind the last of all that smaller documents hold too."""
        if not self.code:
            return
        get, size, length = self.code.get, self.window * LETTERS, self.phrase * LETTERS
        text = "".join([get(w, UNKNOWN) for w in words])
        for end, (passages, table) in self.automaton.iter(text):
            start = end + 1 - length
            if table is not None:
                for low in range(max(0, end + 1 - size), min(start, len(text) - size) + 1, LETTERS):
                    owner = table.get(text[low : low + size])
                    if owner is not None and owner < doc_id:
                        yield low // LETTERS, (low + size) // LETTERS
                continue
            for owner, at, passage in passages:
                if owner >= doc_id:
                    continue
                low = start - at
                if low >= 0 and text.startswith(passage, low):
                    yield low // LETTERS, (low + len(passage)) // LETTERS
                    continue
                left = common(text[max(0, low) : start][::-1], passage[:at][::-1]) // LETTERS
                right = common(text[start : low + len(passage)], passage[at:]) // LETTERS
                if left + right >= self.window:
                    yield start // LETTERS - left, start // LETTERS + right


def common(a: str, b: str) -> int:
    """How many characters agree from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0  # the first ``low`` characters agree, the first ``n`` don't
    while n - low > 1:
        middle = (low + n) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            n = middle
    return low


def remove_repeats(df: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_col: str = "doc_id", text_col: str = "text",
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Texts without the words of windows that also stand in a document with a smaller id.

    Returns for every row doc_id, n_words, n_removed and kept (the other words,
    joined by a blank).  Windows are judged on the input.  A null text has no
    words; a text shorter than a window, and one with a null id, loses none.
    Rows of one id are one document to each other: none is smaller.  Ids may
    have any ordered type; other columns aren't read.
    """
    if not 0 < phrase <= window:
        raise ValueError("a phrase must fit into a window")
    spark = df.sparkSession
    id_type = df.schema[id_col].dataType
    docs = picked(df, doc_id=id_col, text=text_col)
    docs = docs.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)).cast("integer"))

    path = scratch_path(spark, "segments")
    segments(docs, window, phrase).write.parquet(path)
    found = spark.read.parquet(path)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shard = F.pmod("part", F.lit(min(PARTS, total // shard_bytes + 1))).alias("shard")

    path = scratch_path(spark, "phrases")
    ends = found.groupBy("anchor").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("end"), F.count("*").alias("n"))
    ends.where(F.col("first") < F.col("end")).select("anchor", "n").write.parquet(path)
    phrases = spark.read.parquet(path)
    least = found.count() // HOT + 1
    hot = F.broadcast(phrases.where(F.col("n") >= least).select("anchor"))  # at most HOT rows
    path = scratch_path(spark, "met")
    met = found.join(hot, "anchor", "left_anti").join(phrases.where(F.col("n") < least), "anchor", "left_semi")
    met = met.unionByName(found.join(hot, "anchor", "left_semi"))
    met.withColumn("shard", shard).drop("part").write.parquet(path)
    met = spark.read.parquet(path)

    classes = met.groupBy("anchor", "key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    several = classes.groupBy("anchor").agg((F.count("*") > 1).alias("several"))
    recurring = classes.join(several, "anchor")
    path = scratch_path(spark, "passages")
    passages(docs, recurring, window, phrase).write.parquet(path)
    held = spark.read.parquet(path)

    views = held.where(F.col("windows").isNotNull()).select("anchor", "key", "owner", "last", F.explode("windows").alias("view"))
    first = views.groupBy("anchor", "view").agg(F.min(F.struct("owner", "key")).alias("source"), F.max("last").alias("end"))
    first = first.where(F.col("source.owner") < F.col("end")).select("anchor", "view", F.col("source.key").alias("source"))
    several = views.select("anchor", "key", "view").join(first, ["anchor", "view"]).select("anchor", "key", "source").distinct()
    single = held.where(F.col("windows").isNull()).select("anchor", "key", F.col("key").alias("source"))

    there = met.groupBy("anchor", "key", "shard").agg(F.max("doc_id").alias("end"))
    needs = there.join(single.union(several), ["anchor", "key"]).groupBy("anchor", "source", "shard").agg(F.max("end").alias("end"))
    sources = held.select("anchor", F.col("key").alias("source"), "owner", "at", "passage")
    dealt = needs.join(sources, ["anchor", "source"]).where(F.col("owner") < F.col("end"))
    rows = dealt.select("shard", F.col("owner").alias("id"), F.col("passage").alias("text"), "at")
    rows = rows.unionByName(docs.select(shard, F.col("doc_id").alias("id"), "text", F.lit(None).cast("integer").alias("at")))
    ordered = rows.repartition("shard").sortWithinPartitions("shard", F.col("at").isNull())

    schema = T.StructType().add("doc_id", id_type).add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        working_for(__name__)
        out = to_arrow_schema(schema)
        now, reading, automata = None, False, []
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS).to_pydict()
                done = []
                for number, doc_id, text, at in zip(part["shard"], part["id"], part["text"], part["at"], strict=True):
                    if number != now:
                        now, reading, automata = number, True, []
                    if at is not None:
                        if not automata or automata[-1].full():
                            automata.append(PhraseAutomaton(window, phrase))
                        automata[-1].add(doc_id, at, text)
                        continue
                    if reading:
                        reading = False
                        for automaton in automata:
                            automaton.compile()
                    words = split(text)
                    edges = np.zeros(len(words) + 1, np.int32)
                    if doc_id is not None and len(words) >= window:
                        for automaton in automata:
                            for low, high in automaton.found(doc_id, words):
                                edges[low] += 1
                                edges[high] -= 1
                    gone = np.cumsum(edges[:-1]) > 0
                    n = int(np.count_nonzero(gone))
                    kept = words if not n else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    done.append((doc_id, len(words), n, b" ".join(kept).decode()))
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done, strict=True), out, strict=True)], schema=out)

    return ordered.select("shard", "id", "text", "at").mapInArrow(run, schema)
