"""Near-duplicate texts by MinHash with tensored banding, confirmed on full sets.

A text's set is its distinct word shingles, as 64-bit hashes.  Rows with equal
sets form a class, of which one goes on.  COLLECTIONS small collections of
PER_COLLECTION MinHash values each are computed once, and every pair of
collections is the key of one table: C*(C-1)/2 tables of 2*PER_COLLECTION
values cost only C*PER_COLLECTION hash functions.  Texts of similarity s meet in
some table if two collections agree: at 0.8 all but 7 in 10,000 pairs do, at 0.85
all but 4 in 100,000.

Texts that meet are compared by their whole sets, first each with the smallest
of its bucket, its centre: that is as many pairs as texts.  What then still lies
in another component than its centre is compared with all texts of that centre,
in blocks: a pair of blocks is a unit of work that gives back links, not pairs.
So every pair that meets is either in one component or compared, without caps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import map_slices, mix64, picked, working_for
from starmart.llm.components import connected_components
from starmart.session import ensure_checkpoint_dir

COLLECTIONS, PER_COLLECTION = 14, 3
#: Shingles hashed at a time: bounds the memory of very long texts.
BLOCK = 16_384
#: Texts on either side of a unit of work.
SIDE = 128

_RNG = np.random.default_rng(20)
_XOR = _RNG.integers(0, 2**64, COLLECTIONS * PER_COLLECTION, dtype=np.uint64)[:, None]
_ODD = _RNG.integers(0, 2**64, COLLECTIONS * PER_COLLECTION, dtype=np.uint64)[:, None] | np.uint64(1)
_PLACE = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes; words are runs without ASCII white space, A-Z lowered."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for j in range(width):
        total += h[j : len(h) - width + 1 + j] * _PLACE[j]
    return np.unique(mix64(total + np.uint64(width)))


def collections(hashes: np.ndarray) -> np.ndarray:
    """One value for each small collection of MinHash values (int64)."""
    least = np.full(len(_XOR), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), BLOCK):
        np.minimum(least, ((hashes[start : start + BLOCK] ^ _XOR) * _ODD).min(axis=1), out=least)
    parts = least.reshape(COLLECTIONS, PER_COLLECTION)
    out = np.zeros(COLLECTIONS, np.uint64)
    for j in range(PER_COLLECTION):
        out = mix64(out + parts[:, j])
    return out.view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, two halves of a set hash (null if empty) and the collections."""
    schema = (
        T.StructType().add("doc_id", docs.schema["doc_id"].dataType).add("n_shingles", "long")
        .add("set_a", "long").add("set_b", "long").add("collections", T.ArrayType(T.LongType()))
    )

    def run(rows: dict[str, list]) -> list[list]:
        out = []
        for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
            s = shingles(text, words)
            if len(s):
                a, b = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist()
                out.append((doc_id, len(s), a, b, collections(s).tolist()))
            else:
                out.append((doc_id, 0, None, None, None))
        return [list(c) for c in zip(*out, strict=True)] if out else [[]] * 5

    return map_slices(docs, run, schema)


def buckets(reps: DataFrame) -> DataFrame:
    """(key, doc) for every representative and every pair of its collections."""
    pairs = [(i, j) for i in range(COLLECTIONS) for j in range(i + 1, COLLECTIONS)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.lit(j), F.col("collections")[i], F.col("collections")[j]) for i, j in pairs])
    return reps.select(F.explode(keys).alias("key"), "doc")


def enough(shared: int, n: int, m: int, percent: int) -> bool:
    return 100 * shared >= percent * (n + m - shared)


def with_centres(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) among the pairs (doc, centre), confirmed on whole sets."""
    member = texts.select(F.col("doc_id").alias("doc"), F.col("text").alias("text"))
    middle = texts.select(F.col("doc_id").alias("centre"), F.col("text").alias("centre_text"))
    both = pairs.join(member, "doc").join(middle, "centre").select("doc", "text", "centre", "centre_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for(__name__)
        last, held = object(), np.empty(0, np.uint64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pydict()
                a, b = [], []
                for doc, text, centre, centre_text in zip(*rows.values(), strict=True):
                    if centre != last:
                        last, held = centre, shingles(centre_text, words)
                    own = shingles(text, words)
                    if enough(len(np.intersect1d(own, held, assume_unique=True)), len(own), len(held), percent):
                        a.append(doc)
                        b.append(centre)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets."""
    values = np.concatenate(right)
    owner = np.repeat(np.arange(len(right)), [len(s) for s in right])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for i, own in enumerate(left):
        begin, end = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        begin, size = begin[end > begin], (end - begin)[end > begin]
        if len(size):
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            out[i] = np.bincount(owner[np.repeat(begin, size) + step], minlength=len(right))
    return out


def compared(rows: list[tuple], words: int, percent: int) -> list[tuple[int, int]]:
    """Links of one unit of work between its outer texts and its members."""
    sides = [[r for r in rows if r[1] is outer] for outer in (True, False)]
    sets = [[shingles(r[4], words) for r in side] for side in sides]
    if not sets[0] or not sets[1]:
        return []
    counts = shared_counts(*sets)
    n, m = (np.array([len(s) for s in side]) for side in sets)
    near = 100 * counts >= percent * (n[:, None] + m - counts)
    apart = np.array([r[3] for r in sides[0]])[:, None] != np.array([r[3] for r in sides[1]])
    return [(sides[0][i][2], sides[1][j][2]) for i, j in zip(*np.nonzero(near & apart), strict=True)]


def outside_centres(pairs: DataFrame, groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) of texts that lie in another component than a centre of theirs.

    Such outer texts are compared with all texts of the centre that lie in
    another component than they do; outer texts and members are cut into blocks
    of about SIDE.
    """
    centres = pairs.select("centre", F.col("centre").alias("doc")).distinct()
    members = labelled(pairs.select("centre", "doc").unionAll(centres), groups)
    of = groups.select(F.col("node").alias("centre"), F.col("component").alias("_of"))
    members = members.join(of, "centre", "left").withColumn("outer", F.col("component") != F.coalesce("_of", "centre")).drop("_of")
    sizes = members.groupBy("centre").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("outer").cast("int")).alias("outside"))
    sizes = sizes.where((F.col("outside") > 0) & (F.col("size") > 2)).select(
        "centre", F.ceil(F.col("size") / SIDE).cast("int").alias("blocks"), F.ceil(F.col("outside") / SIDE).cast("int").alias("outer_blocks")
    )
    placed = members.join(sizes, "centre")
    own = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = placed.select("centre", upto("outer_blocks").alias("x"), own("blocks").alias("y"), F.lit(False).alias("outer"), "doc", "component")
    outer = placed.where("outer").select("centre", own("outer_blocks").alias("x"), upto("blocks").alias("y"), "outer", "doc", "component")
    units = inner.unionAll(outer).withColumn("unit", F.xxhash64("centre", "x", "y"))
    held = units.select("unit", "outer", "doc", "component").join(texts.select(F.col("doc_id").alias("doc"), "text"), "doc")
    dealt = held.select("unit", "outer", "doc", "component", "text").repartition("unit").sortWithinPartitions("unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else [[]] * 2)], names=["a", "b"])

        working_for(__name__)
        unit, rows = None, []
        for batch in batches:
            for row in zip(*batch.to_pydict().values(), strict=True):
                if row[0] != unit:
                    yield answer(compared(rows, words, percent))
                    unit, rows = row[0], []
                rows.append(row)
        yield answer(compared(rows, words, percent))

    return dealt.mapInArrow(run, "a long, b long")


def links(reps: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Components (node, component) of the representatives (doc, n, collections)."""
    rows = buckets(reps)
    shared = rows.groupBy("key").agg(F.min("doc").alias("centre"), F.max("doc").alias("last")).where("last > centre").drop("last")
    pairs = rows.join(shared, "key").where("doc <> centre").select("doc", "centre").distinct().checkpoint()
    sizes = reps.select("doc", "n")
    close = (
        pairs.join(sizes, "doc").join(sizes.select(F.col("doc").alias("centre"), F.col("n").alias("m")), "centre")
        .where(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).select("doc", "centre")
    )
    groups = connected_components(with_centres(close, docs, words, percent).checkpoint())
    more = outside_centres(pairs, groups, docs, words, percent).checkpoint()
    if more.isEmpty():
        return groups
    # Between components only: contract, then give every text its component's component.
    ends = labelled(labelled(more.select(F.col("a").alias("doc"), "b"), groups).select(F.col("b").alias("doc"), F.col("component").alias("a")), groups)
    above = connected_components(ends.select("a", F.col("component").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("top"))
    known = groups.select(F.col("node").alias("doc"), "component").unionAll(
        more.select(F.explode(F.array("a", "b")).alias("doc")).distinct().join(groups.select(F.col("node").alias("doc")), "doc", "left_anti").withColumn("component", F.col("doc"))
    )
    return known.join(above, "component", "left").select(F.col("doc").alias("node"), F.coalesce("top", "component").alias("component")).checkpoint()


def labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the component of each ``doc`` (itself if it has no link yet)."""
    of = groups.select(F.col("node").alias("doc"), F.col("component").alias("_of"))
    return rows.join(of, "doc", "left").withColumn("component", F.coalesce("_of", "doc")).drop("_of")


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Texts with 100 * intersection >= percent * union are linked; component_id
    is the smallest id reachable, kept says that it is the row's own.  A text
    with fewer words than a shingle is one shingle.  Null, empty and blank
    texts have no shingle and no link.  Rows of one id count as one document
    each with the id's smallest component; rows with a null id take no part:
    component_id null, kept false.
    """
    ensure_checkpoint_dir(df.sparkSession)
    docs = picked(df, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = sketches(docs, words).checkpoint()
    usable = rows.where(F.col("set_a").isNotNull() & F.col("doc_id").isNotNull())
    classes = usable.groupBy("set_a", "set_b", F.col("n_shingles").alias("n")).agg(F.min_by(F.struct("doc_id", "collections"), "doc_id").alias("r"))
    reps = classes.select(F.col("r.doc_id").alias("doc"), "n", F.col("r.collections").alias("collections"), "set_a", "set_b").checkpoint()
    groups = links(reps, docs.where(F.col("doc_id").isNotNull()), words, percent)
    component = labelled(reps.select("doc", "set_a", "set_b"), groups).select("set_a", "set_b", "component")
    own = rows.select("doc_id", "n_shingles", "set_a", "set_b").join(component, ["set_a", "set_b"], "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    out = own.select("doc_id", "n_shingles", found)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with only the smallest id of each component, and one row of a repeated id.

    Rows with a null id can't be told apart and stay.
    """
    found = near_duplicates(docs, words, percent).checkpoint()
    dropped = found.where(F.col("component_id").isNotNull() & ~F.col("kept")).select("doc_id").distinct()
    left = docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    repeated = found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    single = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(single)
