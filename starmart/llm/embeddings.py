"""Near-duplicate vectors by random-hyperplane signs, confirmed by exact cosine.

Rows with the same label and vector form a class, of which one goes on.  Each of
several tables keys a vector by the signs of its projections on some random
directions.  Two vectors at angle a agree on a sign with probability 1 - a/pi,
which gives the number of tables for MISS at the threshold; the number of signs
follows the size of the largest label, so that a bucket of unrelated vectors
keeps its size.

What meets in a bucket is compared by SIGNS signs first: only these and an id
travel to the tables.  Pairs that differ in no more signs than linked ones do
(but for MISS of them) join into candidate components, which hold every link
found.  Vectors travel once to their component, where all pairs are compared in
double precision.

A bucket or component above BLOCK rows is cut into blocks and every pair of
blocks is a unit of work for some task, so none is capped.  A component so loose
that its buckets hold fewer pairs of blocks than itself is compared bucket by
bucket; a pair that meets in several tables counts in the first.  A unit gives
back sums and a spanning forest, not its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import picked
from starmart.llm.components import connected_components
from starmart.session import ensure_checkpoint_dir

#: Chance that a pair just at the threshold meets in no table, and that it differs in too many signs.
MISS = 1e-5
#: Rows wanted in a bucket of unrelated vectors, and the most in a block.
BUCKET, BLOCK = 32, 2048
#: Signs compared before vectors are.
SIGNS = 256
#: Split buckets or components that may be broadcast; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 100_000
SEED = 5


def plan(rows: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Signs for a key and tables, for ``rows`` vectors of the largest label."""
    agree = 1 - math.acos(threshold) / math.pi
    signs = max(1, min(30, round(math.log2(max(2, rows / BUCKET)))))
    return signs, math.ceil(math.log(miss) / math.log1p(-(agree**signs)))


def most_signs_apart(threshold: float, miss: float = MISS) -> int:
    """The least number of SIGNS that a pair just at the threshold exceeds with probability ``miss`` at most."""
    differ = math.acos(threshold) / math.pi
    beyond = 1.0
    for k in range(SIGNS + 1):
        beyond -= math.comb(SIGNS, k) * differ**k * (1 - differ) ** (SIGNS - k)
        if beyond <= miss:
            return k
    return SIGNS


def directions(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim)).standard_normal((count, dim))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, each by the power of two that brings its largest component below 1."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def digested(df: DataFrame, kind: type) -> DataFrame:
    """vec_id, label, dim, set_a, set_b (hash of the vector), vector (its bytes as ``kind``).

    All but vec_id are null for rows that link with nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec_id, label, values in zip(*batch.to_pydict().values(), strict=True):
                row = (vec_id, None, None, None, None, None)
                if vec_id is not None and label is not None and values and None not in values:
                    x = np.array(values, kind) + kind(0)
                    if np.isfinite(x).all() and x.any():
                        a, b = np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), np.int64).tolist()
                        row = (vec_id, label, len(x), a, b, x.tobytes())
                out.append(row)
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["vec_id", "label", "dim", "set_a", "set_b", "vector"])

    return df.mapInArrow(run, "vec_id long, label string, dim int, set_a long, set_b long, vector binary")


def keyed(classes: DataFrame, signs: int, tables: int, kind: type) -> DataFrame:
    """node, label, dim, set_a, set_b, ``marks`` (SIGNS signs as bits) and ``keys`` (one int for each table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        places = 1 << np.arange(signs, dtype=np.int64)
        for batch in batches:
            keys, marks = [], []
            for dim, data in zip(batch.column("dim").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                if dim not in planes:
                    planes[dim] = directions(dim, max(SIGNS, signs * tables))
                above = planes[dim] @ scaled(np.frombuffer(data, kind)[None])[0] > 0
                keys.append((above[: signs * tables].reshape(tables, signs) @ places).astype(np.int32))
                marks.append(np.packbits(above[:SIGNS]).tobytes())
            kept = [batch.column(c) for c in ("node", "label", "dim", "set_a", "set_b")]
            names = ["node", "label", "dim", "set_a", "set_b", "marks", "keys"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int32()))], names=names)

    schema = "node long, label string, dim int, set_a long, set_b long, marks binary, keys array<int>"
    return classes.select("node", "label", "dim", "set_a", "set_b", "vector").mapInArrow(run, schema)


def units_of(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of equal values of ``by`` in sorted batches."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        n = rows.num_rows
        change = np.zeros(max(0, n - 1), bool)
        for name in by:
            change |= pc.not_equal(rows[name].slice(1), rows[name].slice(0, max(0, n - 1))).to_numpy()
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for start, end in zip(starts, starts[1:], strict=False):
            yield rows.slice(start, end - start)
        held = rows.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def tables_of(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pairs_where(side: np.ndarray, near) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of the pairs that ``near`` (two index arrays to a matrix) accepts.

    Pairs of the two sides of a unit, or all pairs where it has one side.
    """
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(first) and len(second):
        i, j = np.nonzero(near(first, second))
        return first[i], second[j]
    every = np.arange(len(side))
    return np.nonzero(np.triu(near(every, every), 1)) if side[0] == 0 else (every[:0], every[:0])


def trees(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest row number that each of ``n`` rows reaches over pairs."""
    tree = np.arange(n)
    while True:
        least = tree.copy()
        np.minimum.at(least, i, tree[j])
        np.minimum.at(least, j, tree[i])
        least = least[least]
        if (least == tree).all():
            return tree
        tree = least


def hung(tree: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The row that each row hangs from, so that a tree is linked without one row of very many links.

    A tree's rows, by node, hang eight from each; its smallest from itself.
    """
    order = np.lexsort((nodes, tree))
    begins = np.flatnonzero(np.r_[True, tree[order][1:] != tree[order][:-1]])
    first = np.repeat(begins, np.diff(np.r_[begins, len(tree)]))
    place = np.arange(len(tree)) - first
    above = np.empty_like(order)
    above[order] = order[first + np.maximum(place - 1, 0) // 8]
    return above


def in_blocks(rows: DataFrame, by: list[str], sizes: DataFrame) -> DataFrame:
    """``rows`` dealt to units (unit, side): one for each value of ``by``, or one for each pair of its blocks.

    ``sizes`` (by, size) lists the values that hold more than BLOCK rows.
    """
    few = sizes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    cut = rows.join(F.broadcast(sizes) if few else sizes, by, "left")
    cut = cut.withColumn("blocks", F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int")).drop("size")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "with"), F.greatest("block", "with")
    side = (F.col("block") > F.col("with")).cast("int")
    return cut.withColumn("unit", F.xxhash64(*by, low, high)).withColumn("side", side).drop("blocks", "block", "with")


def sizes_above_block(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK).checkpoint()


def candidates(marked: DataFrame, apart: int) -> DataFrame:
    """Spanning forests (a, b) of the pairs that meet and differ in at most ``apart`` signs."""
    places = F.posexplode("keys").alias("table", "key")
    rows = marked.select("node", "marks", "label", "dim", places)
    rows = rows.select(F.xxhash64("label", "dim", "table", "key").alias("bucket"), "node", "marks")
    units = in_blocks(rows, ["bucket"], sizes_above_block(rows, ["bucket"])).select("unit", "side", "node", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for unit in units_of(batches, ("unit",)):
            n = unit.num_rows
            if n > 1:
                bits = np.unpackbits(np.frombuffer(b"".join(unit["marks"].to_pylist()), np.uint8).reshape(n, -1), axis=1)
                signs = bits.astype(np.float32) * 2 - 1
                i, j = pairs_where(unit["side"].to_numpy(), lambda a, b: signs[a] @ signs[b].T >= SIGNS - 2 * apart)  # noqa: B023
                if len(i):
                    nodes = unit["node"].to_numpy()
                    above = hung(trees(i, j, n), nodes)
                    moved = np.flatnonzero(above != np.arange(n))
                    found.append((nodes[moved], nodes[above[moved]]))
            if len(found) >= 1000:
                yield tables_of(found, ["a", "b"])
                found = []
        yield tables_of(found, ["a", "b"])

    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def compared(unit: pa.Table, threshold: float, kind: type) -> tuple | None:
    """One unit of work: nodes, links found here, a node of the same tree."""
    n = unit.num_rows
    x = scaled(np.frombuffer(b"".join(unit["vector"].to_pylist()), kind).reshape(n, -1))
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    i, j = pairs_where(unit["side"].to_numpy(), lambda a, b: x[a] @ x[b].T / np.outer(length[a], length[b]) >= threshold)
    table = unit["table"][0].as_py()
    if table and len(i):
        keys = np.array(unit["keys"].to_pylist())
        fresh = np.ones(len(i), bool)
        for t in range(table):
            fresh &= keys[i, t] != keys[j, t]
        i, j = i[fresh], j[fresh]
    if not len(i):
        return None
    nodes, weight = unit["node"].to_numpy(), unit["weight"].to_numpy()
    found = (np.bincount(i, weight[j], n) + np.bincount(j, weight[i], n)).astype(np.int64)
    linked = np.flatnonzero(found)
    return nodes[linked], found[linked], nodes[hung(trees(i, j, n), nodes)[linked]]


def loose(groups: DataFrame, large: DataFrame, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components whose buckets hold fewer pairs of blocks than they do, and their rows by bucket."""
    work = F.col("size") * F.ceil(F.col("size") / BLOCK)
    bucket = ["component", "table", "key"]
    members = groups.join(large.select("component"), "component", "left_semi")
    rows = marked.join(members, "node").select("component", "node", "label", "dim", "set_a", "set_b", "keys", F.posexplode("keys").alias("table", "key"))
    by_bucket = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"))
    parts = by_bucket.groupBy("component").agg(F.sum(work).alias("parts"))
    chosen = large.join(parts, "component").where(F.col("parts") < work).select("component").checkpoint()
    return chosen, rows.join(chosen, "component", "left_semi")


def links(classes: DataFrame, threshold: float, kind: type) -> DataFrame:
    """(node, found, other): link counts by unit, and a node of the same tree."""
    spark = classes.sparkSession
    most = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0]
    if most is None:
        return spark.createDataFrame([], "node long, found long, other long")
    signs, tables = plan(most, threshold)
    marked = keyed(classes, signs, tables, kind).checkpoint()
    groups = connected_components(candidates(marked, most_signs_apart(threshold)).checkpoint()).checkpoint()
    large = sizes_above_block(groups, ["component"])
    own = ["node", "label", "dim", "set_a", "set_b"]
    whole, dealt = groups, None
    vectors = classes.select(*own, "weight", "vector")
    columns = ["unit", "side", "table", "component", *own, "weight", "vector", "keys"]
    if not large.isEmpty():
        chosen, rows = loose(groups, large, marked)
        if not chosen.isEmpty():
            bucket = ["component", "table", "key"]
            whole = groups.join(chosen, "component", "left_anti")
            dealt = in_blocks(rows.join(vectors, own), bucket, sizes_above_block(rows, bucket)).select(*columns)
    units = in_blocks(whole.join(vectors, "node"), ["component"], large)
    units = units.withColumns({"table": F.lit(0), "keys": F.lit(None).cast("array<int>")}).select(*columns)
    units = units if dealt is None else units.unionByName(dealt)
    order = ("unit", "label", "dim", "component", "table")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for unit in units_of(batches, order):
            answer = compared(unit, threshold, kind) if unit.num_rows > 1 else None
            found += [answer] if answer else []
            if len(found) >= 1000:
                yield tables_of(found, ["node", "found", "other"])
                found = []
        yield tables_of(found, ["node", "found", "other"])

    return units.repartition("unit").sortWithinPartitions(*order).mapInArrow(run, "node long, found long, other long")


def near_duplicates(df: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Two rows with the same non-null label (of any type that casts to text) are
    linked if the cosine of their vectors is at least ``threshold``.  Null
    vectors or ids, empty or zero vectors, null or non-finite components, and
    vectors of different lengths link with nothing.  Equal vectors are linked
    and all counted.  Ids must be integral, else a TypeError is raised.  A null
    id has component_id null and kept false; repeated ids count as vectors of
    their own under one id.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be integral")
    # Vectors travel in their own precision; all arithmetic is in double precision.
    single = isinstance(getattr(df.schema[vector_col].dataType, "elementType", None), T.FloatType)
    kind = np.float32 if single else np.float64
    given = picked(df, vec_id=id_col, label=label_col, embedding=vector_col)
    rows = digested(given.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding"), kind).checkpoint()
    same = ["label", "dim", "set_a", "set_b"]
    usable = rows.where(F.col("label").isNotNull())
    classes = usable.groupBy(*same).agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector")).checkpoint()
    found = links(classes, threshold, kind).checkpoint()
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("found").alias("found"))
    of_class = (
        classes.drop("vector").join(counts, "node", "left").join(groups, "node", "left")
        .select(*same, (F.coalesce("found", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    out = rows.select("vec_id", *same).join(of_class, same, "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
