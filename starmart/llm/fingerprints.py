"""Context-triggered piecewise hashing of documents.

A rolling hash over seven bytes cuts a text where its value is -1 modulo the
block size; the pieces' checksums, one character each, are the signature.  The
block size (3 * 2^k) follows the length, so that a signature has up to 64
characters; a second signature is kept for the next larger size.  Signatures of
one block size are compared by edit distance (insertions and deletions) if they
share a run of seven characters.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import picked

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
LEAST_BLOCK, LENGTH, WINDOW, SHARED = 3, 64, 7, 7
#: Bytes hashed at a time: bounds the memory of very long texts.
CHUNK = 1 << 20
#: Documents in a range of neighbours, and the most ranges (their bounds are held by the driver).
RANGE_ROWS, MOST_RANGES = 1_000, 20_000


def rolling(data: bytes) -> np.ndarray:
    """The rolling hash at every byte: a weighted sum and a shifted xor of the window."""
    out = np.empty(len(data), np.uint32)
    for start in range(0, len(data), CHUNK):
        begin = max(0, start - WINDOW + 1)
        x = np.frombuffer(data, np.uint8, min(len(data), start + CHUNK) - begin, begin).astype(np.uint32)
        if start - begin < WINDOW - 1:
            x = np.concatenate([np.zeros(WINDOW - 1 - (start - begin), np.uint32), x])
        n = len(x) - WINDOW + 1
        total, mixed = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        for back in range(WINDOW):
            part = x[WINDOW - 1 - back : WINDOW - 1 - back + n]
            total += part * np.uint32(WINDOW + 1 - back)
            mixed ^= part << np.uint32(5 * back)
        out[start : start + n] = total + mixed
    return out


def signature(data: bytes, cuts: np.ndarray, length: int) -> str:
    """One character for each piece; the last one stands for all that is left."""
    ends = [*(cuts[: length - 1] + 1).tolist(), len(data)]
    if len(ends) > 1 and ends[-1] == ends[-2]:
        ends.pop()
    view, at, out = memoryview(data), 0, []
    for end in ends:
        out.append(ALPHABET[zlib.crc32(view[at:end]) & 63])
        at = end
    return "".join(out)


def fingerprint(text: str) -> str:
    """``block:signature:signature at twice the block``; an empty text is ``3::``."""
    data = text.encode()
    if not data:
        return f"{LEAST_BLOCK}::"
    block = LEAST_BLOCK
    while block * LENGTH < len(data):
        block *= 2
    hashes = rolling(data) + np.uint32(1)
    while True:
        cuts = np.flatnonzero(hashes % np.uint32(block) == 0)
        if len(cuts) >= LENGTH // 2 - 1 or block == LEAST_BLOCK:
            break
        block //= 2
    twice = cuts[hashes[cuts] % np.uint32(2 * block) == 0]
    return f"{block}:{signature(data, cuts, LENGTH)}:{signature(data, twice, LENGTH // 2)}"


def common_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine-wide row of bits at a time."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        if m := masks.get(c):
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def signature_likeness(a: str, b: str) -> float:
    """1 less the edit distance over both lengths; 0 without a shared run (a quarter of short ones)."""
    if not a or not b:
        return 0.0
    n = min(SHARED, (min(len(a), len(b)) + 3) // 4)
    if {a[i : i + n] for i in range(len(a) - n + 1)}.isdisjoint(b[i : i + n] for i in range(len(b) - n + 1)):
        return 0.0
    return 2.0 * common_length(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 for incompatible block sizes."""
    if x == y:
        return 1.0
    (p, x1, x2), (q, y1, y2) = x.split(":"), y.split(":")
    p, q = int(p), int(q)
    if p == q:
        return max(signature_likeness(x1, y1), signature_likeness(x2, y2))
    if p == 2 * q:
        return signature_likeness(x1, y2)
    if q == 2 * p:
        return signature_likeness(x2, y1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of another text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def with_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    Returns for each row doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  The next document is that with
    the next larger id (rows of one id: by a hash of their text; null ids come
    first; after the last the first).  A null text counts as empty.

    Ids are cut into ranges by quantiles; a task reads its ranges in order, and
    the first document of a range is also dealt to the end of the range before.
    """
    docs = picked(df, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    id_type = docs.schema["doc_id"].dataType
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n = ids.count()
    ranges = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    quantiles = ids.stat.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    bounds = np.unique(np.array(quantiles, np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def range_of(x: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, x.fillna(0).to_numpy(np.int64), side="right")
        return pd.Series(np.where(x.isna(), 0, found), dtype="int32")

    heads = ids.groupBy(range_of("doc_id").alias("range")).agg(F.min("doc_id").alias("head"), F.max(F.col("doc_id").isNull()).alias("has_null")).sort("range").collect()
    order = [r["range"] for r in heads]
    before = {None if r["has_null"] and not i else r["head"]: order[i - 1] for i, r in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def dealt_to(x: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, x.fillna(0).to_numpy(np.int64), side="right")
        keys = [None if m else int(v) for v, m in zip(x.fillna(0), x.isna(), strict=True)]
        return pd.Series([[0 if k is None else int(o), before[k]] if k in before else [0 if k is None else int(o)] for k, o in zip(keys, own, strict=True)])

    dealt = docs.select("*", F.posexplode(dealt_to(F.col("doc_id").cast("long"))).alias("after", "range"))
    ordered = dealt.repartition("range").sortWithinPartitions("range", "after", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    schema = (
        T.StructType().add("doc_id", id_type).add("n_chars", "long").add("edited_sha256", "string").add("fingerprint", "string")
        .add("edited_fingerprint", "string").add("near_edited", "double").add("near_next", "double")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        held: tuple | None = None
        done: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                columns = batch.slice(start, 256).to_pydict()
                for doc_id, text, after, at in zip(columns["doc_id"], columns["text"], columns["after"], columns["range"], strict=True):
                    if held is None and after:
                        continue
                    mark = fingerprint(text)
                    if held is not None:
                        changed = edited(held[1], text)
                        other = fingerprint(changed)
                        digest = hashlib.sha256(changed.encode()).hexdigest()
                        done.append((held[0], len(held[1]), digest, held[2], other, likeness(held[2], other), likeness(held[2], mark)))
                    held = None if after else (doc_id, text, mark)
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done, strict=True), out, strict=True)], schema=out)
                    done = []

    return ordered.select("doc_id", "text", "after", "range").mapInArrow(run, schema)
