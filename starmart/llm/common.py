"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handed to Python code and given back at a time: bounds a worker's memory.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Python workers started elsewhere also look for this package beside it."""
    here = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.encode(col.cast("string"), "UTF-8")) % folds


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names, so that nothing else can clash."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


#: Functions that drop what a worker remembers for an operator.
forgets: list[Callable] = []
_working_for: list[str] = [""]


def working_for(operator: str) -> None:
    """Called where a task's Python code starts.  Spark uses workers again: what another
    operator remembers in this one goes, so that a pipeline's stages don't add up."""
    if _working_for[0] != operator:
        _working_for[0] = operator
        for forget in forgets:
            forget()
        gc.collect()


def map_slices(df: DataFrame, fn: Callable, schema: T.StructType) -> DataFrame:
    """``fn`` over slices of at most SLICE_ROWS rows of every partition.

    ``fn`` takes a dict of Python lists (one for each column of ``df``) and
    returns a list of columns in the order of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for(fn.__module__)
        out = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                columns = fn({n: part.column(i).to_pylist() for i, n in enumerate(names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)], schema=out
                )

    return df.mapInArrow(run, schema)


def filter_texts(df: DataFrame, keep: Callable, text_col: str = "text") -> DataFrame:
    """The rows that ``keep`` (a list of texts to a list of booleans) accepts, unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for(keep.__module__)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                yield part.filter(pa.array(keep(texts), pa.bool_()))

    return df.mapInArrow(run, df.schema)


class WordCache(dict):
    """A dict that starts anew once it holds ``limit`` entries; only a speed-up."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def make_room(self, wanted: int) -> None:
        if len(self) + wanted > self.limit:
            self.clear()


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser over uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_sample(df: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """About ``rows`` rows (all, if there are fewer), chosen by a hash of the id.

    Only for fitting models.  The choice is the same at every run.
    """
    n = df.count()
    if n <= rows:
        return df
    scale = 1 << 30
    return df.where(F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(scale)) < int(scale * rows / n))
