"""Nearest vectors of a stated query set: a block matrix join over int8 tiles.

Every vector is held as int8 codes with one scale, and with the length of what the codes leave
out. A tile of codes times codes then gives every distance up to a known error. Pairs whose least
possible distance lies beyond the best so far cannot enter a list; all others are computed again
from the original components in double precision. So the lists are exact.

Vectors that are null, zero (those of no components too) or hold null or non-finite components
take no part, nor do rows without an id. Vectors of different lengths are not compared. Equal rows
count each: a query row has its own list, from which only itself is left out, not its copies.
An empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.heaps import Heaps
from hourmart.llm.tiles import Grid, blocks, counted_rows, finite_vectors, numbers, streamed

# Sums of so many products of two codes are exact in single precision.
EXACT_TERMS = 1024
# Rounding of the bound's own arithmetic, and of a square root squared again.
SLACK = 1e-12
_FOUND = "query_id LONG, query_digest LONG, query_copies LONG, vec_id LONG, copies LONG, score DOUBLE"


def quantised(vectors: np.ndarray) -> SimpleNamespace:
    """Codes with scales, the length of each vector and of what its codes leave out."""
    exact = vectors.astype(np.float64)
    scale = np.abs(exact).max(axis=1) / 127
    scale[scale == 0] = 1
    codes = np.rint(exact / scale[:, None]).astype(np.int8)
    rest = exact - codes * scale[:, None]
    with np.errstate(over="ignore"):
        norm, error = (np.sqrt((x**2).sum(axis=1)) for x in (exact, rest))
    return SimpleNamespace(exact=exact, codes=codes, scale=scale, norm=norm, error=error)


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """int8 codes times int8 codes: whole numbers, through single-precision products."""
    total = np.zeros((len(left), len(right)))
    for part in blocks(left.shape[1], EXACT_TERMS):
        total += left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return total


def bounds(q: SimpleNamespace, c: SimpleNamespace) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of a tile from the codes, and how far they may be off."""
    squares = (q.norm**2)[:, None] + (c.norm**2)[None, :]
    middle = product(q.codes, c.codes)
    middle *= q.scale[:, None]
    middle *= -2 * c.scale[None, :]
    middle += squares
    # x.y - x'.y' = x'.(y - y') + (x - x').y, where |x'| is at most |x| + |x - x'|.
    off = (q.norm + q.error)[:, None] * (2 * c.error)[None, :]
    off += (2 * q.error)[:, None] * c.norm[None, :]
    off += SLACK * squares
    return middle, off


def distances(q: np.ndarray, c: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances of pairs of columns, components added in their order."""
    total = np.zeros(len(left))
    for i in range(len(q)):
        step = q[i, left] - c[i, right]
        total += step * step
    return np.sqrt(total)


def _part(vectors: SimpleNamespace, rows: slice) -> SimpleNamespace:
    return SimpleNamespace(**{name: value[rows] for name, value in vars(vectors).items()})


def _smallest_of_equals(vectors: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Rows without those that ``most`` equal vectors of smaller ids always precede."""
    order = np.lexsort((ids, *vectors.T))
    ordered = vectors[order]
    begins = np.flatnonzero(np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1)))
    place = np.arange(len(ids)) - np.repeat(begins, np.diff(np.append(begins, len(ids))))
    return np.sort(order[place < most])


def searched(k: int):
    """The mapping of tiles to the best ``k`` of each query in them."""

    def hold(batches: list[pa.RecordBatch], vectors: np.ndarray) -> SimpleNamespace:
        names = ("vec_id", "digest", "copies")
        own = {n: np.concatenate([numbers(b, n) for b in batches]) for n in names}
        # One more than asked for: a query may meet itself.
        heaps = Heaps(len(vectors), k + 1, -np.inf)
        return SimpleNamespace(**own, vectors=quantised(vectors), heaps=heaps)

    def meet(held: SimpleNamespace, rows: pa.RecordBatch, vectors: np.ndarray) -> None:
        ids, digest, copies = (numbers(rows, n) for n in ("vec_id", "digest", "copies"))
        for some in blocks(len(vectors)):
            # Equal vectors are equally near: only the smallest ids can enter a list.
            used = some.start + _smallest_of_equals(vectors[some], ids[some], k + 1)
            block = quantised(vectors[used])
            for asked in blocks(len(held.vec_id)):
                part = _part(held.vectors, asked)
                _meet(held, asked, part, block, ids[used], digest[used], copies[used], k)

    def report(held: SimpleNamespace) -> pa.RecordBatch:
        owner, score, ids, copies = held.heaps.entries()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(held.vec_id[owner]),
                pa.array(held.digest[owner]),
                pa.array(held.copies[owner]),
                pa.array(ids),
                pa.array(copies),
                pa.array(-score),
            ],
            names=["query_id", "query_digest", "query_copies", "vec_id", "copies", "score"],
        )

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return streamed(batches, hold, meet, report)

    return tiles


def _meet(held, asked, part, block, ids, digest, copies, k) -> None:
    with np.errstate(over="ignore", invalid="ignore"):
        middle, off = bounds(part, block)
        worst = held.heaps.floor()[asked] ** 2
        if len(ids) > k and np.isinf(worst).any():
            likely = np.partition(middle + off, k, axis=1)[:, k]
            worst = np.fmin(worst, likely)
        # Written so that what overflowed is computed again, too.
        near = ~(middle - off > (worst * (1 + SLACK))[:, None])
    left, right = np.nonzero(near)
    for some in blocks(len(left), 1 << 19):
        q, c = left[some], right[some]
        with np.errstate(over="ignore"):
            away = distances(part.exact.T, block.exact.T, q, c)
        owner = q + asked.start
        same = (digest[c] == held.digest[owner]) & (ids[c] == held.vec_id[owner])
        others = copies[c] - same
        there = others > 0
        held.heaps.add(owner[there], -away[there], ids[c][there], others[there])


def nearest(
    rows: DataFrame,
    asked: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest other rows of every row whose id meets ``asked`` (over ``vec_id``)."""
    found = finite_vectors(rows, vector, F.col(vec_id).cast("long").alias("vec_id"))
    found = found.filter(F.col("vec_id").isNotNull() & F.exists("vec", lambda x: x != 0))
    size = found.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(asked).alias("queries"),
        F.coalesce(F.max(F.size("vec")), F.lit(1)).alias("components"),
    ).first()
    grid = Grid.over(size["rows"], size["queries"], size["components"])
    vectors = counted_rows(found)
    lists = grid.deal(vectors, vectors.filter(asked)).mapInArrow(searched(k), _FOUND)
    # Lists of strips merge into that of the query; copies of a row count each.
    query = ["query_id", "query_digest"]
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k))))
    best = Window.partitionBy(*query).orderBy("score", "vec_id")
    merged = lists.withColumn("copy", each).withColumn("rank", F.row_number().over(best))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("query_copies")))
    return merged.filter(F.col("rank") <= k).withColumn("turn", again).select(
        "query_id", "rank", "vec_id", "score"
    )
