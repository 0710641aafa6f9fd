"""Fill-in-the-middle transformation by displacement scatter.

All texts of a slice are one array of bytes.  A scan finds the ends of their
units (a run of visible characters with the blanks before it; blanks at the end
are a unit of their own).  Two of these ends cut a text into prefix, middle and
suffix.  A difference array holds, where a part begins, by how much its bytes
move further than those before; its running sum is the shift of every byte, and
one scatter writes all outputs.  ``restore`` builds the same array over the
texts to be rebuilt and gathers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import SLICE_ROWS, picked, working_for

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes moved at a time: bounds the memory of very long texts.
CHUNK = 1 << 22


def hashes(id_col: Column, seed: int, n: int) -> list[Column]:
    """The first ``n`` 8-digit groups of the hex sha256 of ``seed:id`` (a null id: empty), as longs."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) and where each begins, with the end of the last."""
    held = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def as_texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    held = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return held.cast(pa.string())


def sentinels(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a sentinel begins within one text, and the number of that text."""
    opening = np.flatnonzero(data[: max(0, len(data) - 2)] == PREFIX[0])
    inner = data[opening + 1]
    kinds = (inner == PREFIX[1]) | (inner == SUFFIX[1]) | (inner == MIDDLE[1])
    found = opening[kinds & (data[opening + 2] == PREFIX[2])]
    of = np.searchsorted(offsets[1:], found, side="right")
    whole = found + 3 <= offsets[1:][of]
    return found[whole], of[whole]


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all units, ascending."""
    last = np.zeros(len(data) + 1, bool)
    visible = (data != 32) & ((data < 9) | (data > 13))
    last[1:-1] = visible[:-1] & ~visible[1:]
    last[offsets[1:][np.diff(offsets) > 0]] = True
    return np.flatnonzero(last)


def displacements(begins: np.ndarray, shifts: np.ndarray, total: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The shift of every byte, a chunk at a time: running sums of a difference array
    that changes where a part begins.  Parts may be empty."""
    steps, carry = np.diff(shifts, prepend=0), 0
    for low in range(0, total, CHUNK):
        high = min(total, low + CHUNK)
        a, b = np.searchsorted(begins, (low, high))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, begins[a:b] - low, steps[a:b])
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = int(shift[-1])
        yield low, high, shift


def rearranged(texts: pa.Array, h: list[np.ndarray], rate: int, spm: int) -> tuple[np.ndarray, list, list, list, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of every text."""
    data, offsets = flat(texts)
    starts, ends = offsets[:-1], offsets[1:]
    cuts = unit_ends(data, offsets)
    first = np.searchsorted(cuts, starts, side="right")
    n = np.searchsorted(cuts, ends, side="right") - first
    n[starts == ends] = 0
    a, b = np.sort([h[0] % (n + 1), h[1] % (n + 1)], axis=0)
    padded = np.append(cuts, len(data))
    cut_a = np.where(a == 0, starts, padded[np.minimum(first + a, len(padded)) - 1])
    cut_b = np.where(b == 0, starts, padded[np.minimum(first + b, len(padded)) - 1])
    plain = (n == 0) | (h[2] % 100 >= rate)
    plain[sentinels(data, offsets)[1]] = True
    suffix_first = h[3] % 100 < spm

    sizes = ends - starts + np.where(plain, 0, 9)
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = out_offsets[:-1]
    lead, tail = cut_a - starts, ends - cut_b
    # The second part begins behind the first sentinel, the first part and the second sentinel.
    prefix_at = np.where(plain, at, np.where(suffix_first, at + 6 + tail, at + 3))
    suffix_at = np.where(plain, at + (cut_b - starts), np.where(suffix_first, at + 3, at + 6 + lead))
    middle_at = np.where(plain, at + lead, at + 9 + lead + tail)
    begins = np.stack([starts, cut_a, cut_b], axis=1).ravel()
    moved = np.stack([prefix_at, middle_at, suffix_at], axis=1).ravel() - begins

    output = np.empty(int(out_offsets[-1]), np.uint8)
    for low, high, shift in displacements(begins, moved, len(data)):
        output[np.arange(low, high) + shift] = data[low:high]
    for mark, place in ((PREFIX, prefix_at), (SUFFIX, suffix_at), (MIDDLE, middle_at)):
        for k, byte in enumerate(mark):
            output[place[~plain] - 3 + k] = byte

    opens = (data & 0xC0) != 0x80  # the first byte of a code point
    chars = [[None if p else int(np.count_nonzero(opens[x:y])) for p, x, y in zip(plain, xs, ys, strict=True)] for xs, ys in ((starts, cut_a), (cut_a, cut_b))]
    form = np.where(plain, "plain", np.where(suffix_first, "spm", "psm")).tolist()
    return n, form, *chars, as_texts(output, out_offsets)


def rebuilt(outputs: pa.Array, forms: list[str]) -> pa.Array:
    """The texts that the outputs were made of."""
    data, offsets = flat(outputs)
    starts, ends = offsets[:-1], offsets[1:]
    form = np.array(forms, dtype="U5")
    plain = form == "plain"
    found, of = sentinels(data, offsets)
    mine = found[~plain[of]]
    if len(mine) != 3 * np.count_nonzero(~plain):
        raise ValueError("an output that isn't plain must hold three sentinels")
    one, two, three = (np.zeros(len(form), np.int64) for _ in range(3))
    one[~plain], two[~plain], three[~plain] = mine[0::3], mine[1::3], mine[2::3]
    suffix_first = form == "spm"
    prefix = np.where(plain, starts, np.where(suffix_first, two, one) + 3)
    lead = np.where(plain, ends - starts, np.where(suffix_first, three - two, two - one) - 3)
    suffix = np.where(plain, ends, np.where(suffix_first, one, two) + 3)
    middle = np.where(plain, ends, three + 3)
    inner = ends - middle
    sizes = ends - starts - np.where(plain, 0, 9)
    text_offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = text_offsets[:-1]
    begins = np.stack([at, at + lead, at + lead + inner], axis=1).ravel()
    moved = np.stack([prefix, middle, suffix], axis=1).ravel() - begins
    texts = np.empty(int(text_offsets[-1]), np.uint8)
    for low, high, shift in displacements(begins, moved, len(texts)):
        texts[low:high] = data[np.arange(low, high) + shift]
    return as_texts(texts, text_offsets)


def _by_slices(df: DataFrame, fn: Callable, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        working_for(fn.__module__)
        out = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                columns = fn(dict(zip(part.schema.names, part.columns, strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)], schema=out
                )

    return df.mapInArrow(run, schema)


def transform(df: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with their middles moved to the end: doc_id, n, form, prefix_chars, middle_chars, output.

    ``rate`` per cent of the texts (by a hash of seed and id) are rearranged,
    ``spm`` per cent of these with the suffix first; the rest stay plain, as do
    empty and null texts (n = 0) and texts that hold a sentinel.  Characters
    are code points, null if plain.  Every row gives one row, repeated rows and
    null ids too; other columns aren't read.
    """
    docs = picked(df, doc_id=id_col, text=text_col)
    docs = docs.select("*", *[h.alias(f"h{k}") for k, h in enumerate(hashes(F.col("doc_id"), seed, 4))])
    schema = (
        T.StructType().add("doc_id", df.schema[id_col].dataType).add("n", "long").add("form", "string")
        .add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    )

    def run(rows: dict[str, pa.Array]) -> list:
        h = [rows[f"h{k}"].to_numpy(zero_copy_only=False) for k in range(4)]
        return [rows["doc_id"], *rearranged(rows["text"], h, rate, spm)]

    return _by_slices(docs, run, schema)


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored") -> DataFrame:
    """``df`` and the text that each output was made of, exactly, in ``restored_col``.

    It is rebuilt from output and form alone; a null output gives an empty text.
    """
    if restored_col in df.columns:
        raise ValueError(f"there is a column {restored_col} already")
    schema = T.StructType([*df.schema, T.StructField(restored_col, T.StringType())])

    def run(rows: dict[str, pa.Array]) -> list:
        return [*rows.values(), rebuilt(rows[output_col], rows[form_col].to_pylist())]

    return _by_slices(df, run, schema)
