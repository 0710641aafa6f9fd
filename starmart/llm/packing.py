"""Best-fit-decreasing packing of tokenised documents into fixed-size sequences.

Texts are encoded with a byte-level vocabulary and cut into pieces no longer
than a sequence.  Full pieces are sequences by themselves.  The others are dealt
evenly to shards of bounded size; within a shard they are placed longest first,
each in the open sequence with the least room that still holds it.  A segment
tree over remaining capacities finds that sequence in O(log capacity) steps.
A shard of SHARD_PIECES pieces leaves about one sequence unfilled.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import forgets, map_slices, picked
from starmart.llm.word_encoding import byte_alphabet
from starmart.session import ensure_checkpoint_dir

#: Pieces packed together by one task.
SHARD_PIECES = 50_000
#: Fixed value: how the byte-level vocabulary cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteVocabulary:
    """A byte-level BPE tokenizer file, its specials recognised inside texts."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in byte_alphabet().items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.library = tiktoken.Encoding("byte_bpe", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return np.array(self.library.encode(text, allowed_special="all"), "<u4").tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)


forgets.append(vocabulary.cache_clear)


def token_pieces(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as token pieces: doc_id, piece, start, length, ids (binary, LE uint32).

    A document is its ids and then ``end_id``; a null or empty text is ``end_id``
    alone.  Only longer ones are cut, into pieces of ``capacity``; the first one
    takes the remainder.  Every input row counts, repeated rows included.
    """
    schema = (
        T.StructType().add("doc_id", df.schema[id_col].dataType).add("piece", "integer")
        .add("start", "long").add("length", "long").add("ids", "binary")
    )
    end = end_id.to_bytes(4, "little")

    def run(rows: dict[str, list]) -> list[list]:
        encode, out = vocabulary(path).encode, []
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            ids = encode(text or "") + end
            n = len(ids) // 4
            cuts = [0, *range(n % capacity or capacity, n, capacity), n]
            out += [(doc_id, k, a, b - a, ids[4 * a : 4 * b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        return [list(c) for c in zip(*out, strict=True)] if out else [[]] * 5

    return map_slices(picked(df, doc_id=id_col, text=text_col), run, schema)


class Capacities:
    """A segment tree over remaining capacities, for the tightest open sequence."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _count(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.any[node] += by
            node >>= 1

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._count(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The open sequence with the least room of at least ``length``; it is removed."""
        node = self.size + length
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.size
        self._count(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of every item, given longest first."""
    tree, n, sequences, offsets = Capacities(capacity), 0, [], []
    for length in lengths:
        if (found := tree.take(length)) is None:
            found, n = (n, capacity), n + 1
        sequence, room = found
        sequences.append(sequence)
        offsets.append(capacity - room)
        if room > length:
            tree.add(room - length, sequence)
    return sequences, offsets


def pack(pieces: DataFrame, capacity: int = 2048, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (with a column ``length``, 1 to capacity) and where each one goes.

    Adds sequence_id and offset (long): a sequence's pieces follow each other
    from offset 0 without gaps.  Every row is placed, repeated rows too; other
    columns stay.  An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    ensure_checkpoint_dir(spark)
    rows = pieces.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    partial = rows.where(F.col("length") < capacity)
    shards = max(1, -(-partial.count() // shard_pieces))
    schema = T.StructType([f for f in rows.schema if f.name != "_row"]).add("sequence_id", "long").add("offset", "long")

    def place(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "_row"], ascending=[False, True], kind="stable")
        sequences, offsets = best_fit(shard["length"].tolist(), capacity)
        shard["sequence_id"] = np.array(sequences, np.int64) * shards + int(key[0])
        shard["offset"] = np.array(offsets, np.int64)
        return shard.drop(columns=["_row", "_shard"])

    dealt = partial.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    placed = dealt.groupBy("_shard").applyInPandas(place, schema)
    full = rows.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    return placed.unionByName(full.drop("_row"))
