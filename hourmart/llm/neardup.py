"""Near-duplicate documents: dart signatures, banded buckets, exact check, components.

Documents whose sets of word shingles are alike by ``likeness`` or more (Jaccard) are in
one class, and so are all that such links join. Equal texts are one node from the start.
A bucket is never paired with itself: its members are compared with the member that shares
most buckets, which joins nearly all that belong together. Only where a bucket still holds
several components, its members outside the largest are compared with the others, in blocks
of bounded size that return nothing but links. So every pair that shares a bucket is either
compared or known to be in one class.

Null texts and texts without a word are alone, copies of such texts as well. Shorter texts than
a shingle are alike if they have the same words. Repeated rows are copies. Ids may be null or
repeat; the class is named by its least id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Interner, saved, shingles, slices, texts, words_of
from hourmart.llm.components import components
from hourmart.llm.darts import band_keys, signatures

SHINGLE = 5
LIKENESS = 0.8
# A pair of likeness 0.8 shares no band with a chance of three in a million.
BANDS, ROWS = 24, 4
# Members of a bucket that meet in one task.
OUTER_BLOCK, INNER_BLOCK = 256, 1024


def _sign(shingle: int, bands: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Interner(xxhash.xxh64_intdigest)
        for batch in slices(batches):
            found, starts = shingles(*words_of(batch.column("text"), hashed)[1:], shingle)
            keys = band_keys(signatures(found, starts, bands * rows), bands).view(np.int64)
            some = np.diff(starts) > 0
            ends = np.zeros(len(some) + 1, np.int32)
            np.cumsum(np.where(some, bands, 0), out=ends[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([md5(t).digest() for t in texts(batch.column("text"))], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].ravel())),
                ],
                names=["doc_id", "node", "bands"],
            )

    return run


def _alike(shingle: int, likeness: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Interner(xxhash.xxh64_intdigest)
        for batch in slices(slices(batches, "text_a"), "text_b"):
            sets: dict[bytes, np.ndarray] = {}
            for side in "ab":
                nodes = batch.column(side).to_pylist()
                new = [i for i, node in enumerate(nodes) if sets.setdefault(node, None) is None]
                _, words, starts = words_of(batch.column(f"text_{side}").take(pa.array(new, pa.int64())), hashed)
                found, at = shingles(words, starts, shingle)
                for i, low, high in zip(new, at, at[1:]):
                    sets[nodes[i]] = np.unique(found[low:high])
            kept = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                one, other = sets[a], sets[b]
                both = len(one) + len(other) - len(np.union1d(one, other))
                kept.append(both >= likeness * (len(one) + len(other) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(kept)) for c in "ab"], names=["a", "b"]
            )

    return run


def _verified(pairs: DataFrame, content: DataFrame, shingle: int, likeness: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are alike."""
    first = content.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = content.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_alike(shingle, likeness), "a binary, b binary")


def _shared(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many elements each left set shares with each right one."""
    all_ = np.concatenate([*left, *right])
    kinds, number = np.unique(all_, return_inverse=True)
    sizes = np.array([*map(len, left), *map(len, right)])
    row = np.repeat(np.arange(len(sizes)), sizes)
    on_left = row < len(left)
    useful = np.zeros((2, len(kinds)), bool)
    useful[0, number[on_left]] = useful[1, number[~on_left]] = True
    place = np.cumsum(useful.all(axis=0)) - 1
    kept = useful.all(axis=0)[number]
    row, column = row[kept], place[number[kept]]
    total = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        here = (column >= low) & (column < low + columns)
        matrix = np.zeros((len(sizes), columns), np.float32)
        matrix[row[here], column[here] - low] = 1
        total += matrix[: len(left)] @ matrix[len(left) :].T
    return total


def _links_of_block(shingle: int, likeness: float):
    def run(block: pa.Table) -> pa.Table:
        hashed = Interner(xxhash.xxh64_intdigest)
        _, words, starts = words_of(block.column("text"), hashed)
        found, at = shingles(words, starts, shingle)
        sets = [np.unique(found[low:high]) for low, high in zip(at, at[1:])]
        outer = np.array(block.column("outer").to_pylist(), bool)
        root = np.unique(block.column("root").to_pylist(), return_inverse=True)[1]
        ys, xs = np.flatnonzero(outer), np.flatnonzero(~outer)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(ys) and len(xs):
            size = np.array([len(s) for s in sets], np.float64)
            both = _shared([sets[i] for i in ys], [sets[i] for i in xs])
            all_ = size[ys][:, None] + size[xs][None, :] - both
            alike = (both >= likeness * all_ - 1e-9) & (root[ys][:, None] != root[xs][None, :])
            y, x = np.nonzero(alike)
            a, b = ys[y], xs[x]
        node = block.column("node").combine_chunks()
        return pa.table({"a": node.take(pa.array(a)), "b": node.take(pa.array(b))})

    return run


def _rest(split: DataFrame, content: DataFrame, shingle: int, likeness: float) -> DataFrame:
    """Links between members of different components of a bucket (bucket, node, root, main)."""
    outer = F.col("root") != F.col("main")
    sizes = split.groupBy("bucket").agg(
        F.ceil(F.count("*") / INNER_BLOCK).cast("int").alias("inner_blocks"),
        F.ceil(F.sum(outer.cast("int")) / OUTER_BLOCK).cast("int").alias("outer_blocks"),
    )
    rows = split.join(sizes, "bucket")
    spread = F.xxhash64("node")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(spread, F.col(n)).cast("int")
    keep = ["bucket", "node", "root"]
    ys = rows.filter(outer).select(
        *keep,
        F.lit(True).alias("outer"),
        own("outer_blocks").alias("y"),
        every("inner_blocks").alias("x"),
    )
    xs = rows.select(
        *keep,
        F.lit(False).alias("outer"),
        every("outer_blocks").alias("y"),
        own("inner_blocks").alias("x"),
    )
    return (
        ys.union(xs)
        .join(content, "node")
        .groupBy("bucket", "y", "x")
        .applyInArrow(_links_of_block(shingle, likeness), "a binary, b binary")
    )


def _classes(
    docs: DataFrame,
    likeness: float = LIKENESS,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, class_id, node (digest of the text), root of the class, whether it has no words."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = saved(
        docs.mapInArrow(
            _sign(shingle, bands, rows), "doc_id long, node binary, bands array<long>"
        )
    )
    nodes = saved(
        signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    )
    dealt = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = saved(dealt.join(shared, "bucket"))
    degree = saved(members.groupBy("node").agg(F.sum("n").alias("degree")))
    members = saved(members.join(degree, "node").select("bucket", "node", "degree"))

    content = docs.withColumn("node", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    content = saved(
        content.select("node", "text").join(degree.select("node"), "node", "left_semi")
        .dropDuplicates(["node"])
    )
    hubs = members.groupBy("bucket").agg(F.max(F.struct("degree", "node"))["node"].alias("hub"))
    pairs = members.join(hubs, "bucket").filter("node != hub")
    pairs = pairs.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = saved(_verified(pairs, content, shingle, likeness))
    labels = saved(components(links))
    rooted = members.join(labels, "node", "left").select(
        "bucket", "degree", "node", F.coalesce("root", "node").alias("root")
    )
    # The component of the hub is the main one of a bucket.
    mixed = (
        rooted.groupBy("bucket")
        .agg(
            F.max(F.struct("degree", "node", "root"))["root"].alias("main"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .filter("low != high")
    )
    split = saved(rooted.join(mixed.select("bucket", "main"), "bucket"))
    more = saved(_rest(split, content, shingle, likeness).distinct())
    roots = saved(components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)))

    known = nodes.select("node", "doc_id").join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "doc_id"
    )
    named = known.join(
        known.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root"
    ).select("node", "root", "class_id")
    # Texts without words are alone.
    alone = F.size("bands") == 0
    return (
        signed.withColumn("alone", alone)
        .drop("bands")
        .join(saved(named), "node")
        .select(
            "doc_id",
            F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            "node",
            "root",
            "alone",
        )
    )


def classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id of every row: the least id of the row's class (null if all are null)."""
    return _classes(docs, **options).select("doc_id", "class_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of every class, all columns as they are: a row of the least id.

    Rows without words all stay, repeated ones as well.
    """
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node"))
    first = (
        _classes(docs, **options)
        .filter("NOT alone")
        .groupBy("root")
        .agg(least.alias("least"))
        .select("least.node", F.col("least.doc_id").alias("kept"))
        .alias("r")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = text.rlike(r"^[\x20\x09-\x0D]*$")
    # The row goes along as one value, so that none of its columns can clash with ours.
    left = docs.filter(~blank).select(
        F.struct("*").alias("row"),
        F.unhex(F.md5(text)).alias("node"),
        F.col("doc_id").cast("long").alias("own"),
    ).alias("l")
    same = (F.col("l.node") == F.col("r.node")) & F.col("l.own").eqNullSafe(F.col("r.kept"))
    one = left.join(first, same).select("l.row", "l.node").dropDuplicates(["node"])
    return one.select("row.*").unionByName(docs.filter(blank))
