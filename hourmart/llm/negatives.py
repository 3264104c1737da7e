"""Hard negatives: rows of another label almost as alike to an anchor as one of its own.

Vectors become whole numbers and a score is their exact inner product, a tile of anchors times a
tile of rows by Strassen's recursive product. A first pass keeps each anchor's best rows of its
own label; their scores set the windows of a second pass, which keeps the best rows of other
labels in each window. Both kinds of lists merge over the tiles.

Rows with a null id, label or vector, or with a null or non-finite component take no part; vectors
of different lengths are not compared, those of no components have a score of 0. Equal rows count
each: an anchor's own row is left out, its copies are not, and a positive that stands twice has two
equal lists. A table whose components could give scores beyond 64 bits stops with an error. An
empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import stored
from hourmart.llm.heaps import Heaps
from hourmart.llm.strassen import multiply
from hourmart.llm.tiles import Grid, blocks, counted_rows, finite_vectors, numbers, streamed

SCALE = 256
LABELS = 10
# A window: from so many to so many hundredths of the positive's score.
LOW, HIGH = 50, 95
LOWEST = np.iinfo(np.int64).min
_ANCHOR = ["anchor_id", "anchor_digest"]
_POSITIVES = (
    "anchor_id LONG, anchor_digest LONG, anchor_copies LONG, "
    "positive_id LONG, copies LONG, positive_score LONG"
)
_NEGATIVES = (
    "anchor_id LONG, anchor_digest LONG, anchor_copies LONG, slot LONG, positive_id LONG, "
    "positive_score LONG, negative_id LONG, copies LONG, negative_score LONG"
)


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of every component, x as a double."""
    return np.floor(vectors.astype(np.float64) * SCALE)


def _integers(vectors: np.ndarray) -> np.ndarray:
    """As 64-bit integers, if no score, nor a hundred times it, can need more."""
    large = whole(vectors)
    most = float(np.abs(large).max(initial=0))
    if max(1, vectors.shape[1]) * most * most * 100 >= 2.0**63:
        raise OverflowError("components are too large for scores of 64 bits")
    return large.astype(np.int64)


def _hold(batches: list[pa.RecordBatch], vectors: np.ndarray, names, owners: int, k: int):
    own = {n: np.concatenate([numbers(b, n) for b in batches]) for n in names}
    heaps = Heaps(len(vectors) * owners, k, LOWEST)
    return SimpleNamespace(**own, vectors=_integers(vectors), heaps=heaps)


def _products(held: SimpleNamespace, rows: pa.RecordBatch, vectors: np.ndarray):
    """Blocks of scores, with the anchors and the rows they belong to."""
    names = ("vec_id", "digest", "copies", "label")
    for some in blocks(len(vectors)):
        block = np.ascontiguousarray(_integers(vectors[some]).T)
        own = SimpleNamespace(**{n: numbers(rows, n)[some] for n in names})
        for asked in blocks(len(held.vec_id)):
            yield asked, own, multiply(held.vectors[asked], block)


def _positives(k: int):
    names = ("vec_id", "digest", "copies", "label")

    def meet(held: SimpleNamespace, rows: pa.RecordBatch, vectors: np.ndarray) -> None:
        for asked, own, scores in _products(held, rows, vectors):
            alike = held.label[asked][:, None] == own.label[None, :]
            alike &= scores >= held.heaps.floor()[asked][:, None]
            left, right = np.nonzero(alike)
            owner = left + asked.start
            same = own.digest[right] == held.digest[owner]
            same &= own.vec_id[right] == held.vec_id[owner]
            others = own.copies[right] - same
            there = others > 0
            left, right, owner = left[there], right[there], owner[there]
            held.heaps.add(owner, scores[left, right], own.vec_id[right], others[there])

    def report(held: SimpleNamespace) -> pa.RecordBatch:
        owner, score, ids, copies = held.heaps.entries()
        columns = [held.vec_id[owner], held.digest[owner], held.copies[owner], ids, copies, score]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns],
            names=[*_ANCHOR, "anchor_copies", "positive_id", "copies", "positive_score"],
        )

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold = lambda found, vectors: _hold(found, vectors, names, 1, k)
        return streamed(batches, hold, meet, report)

    return tiles


def _negatives(k: int, positives: int):
    names = ("vec_id", "digest", "copies", "label")

    def hold(found: list[pa.RecordBatch], vectors: np.ndarray) -> SimpleNamespace:
        held = _hold(found, vectors, names, positives, k)
        lists = [row for b in found for row in b.column("positives").to_pylist()]
        held.ids = np.zeros((len(lists), positives), np.int64)
        held.scores = np.zeros((len(lists), positives), np.int64)
        held.number = np.array([len(row) for row in lists])
        for i, row in enumerate(lists):
            for j, positive in enumerate(row):
                held.ids[i, j], held.scores[i, j] = positive["positive_id"], positive["positive_score"]
        # LOW * p <= 100 * n <= HIGH * p in whole numbers.
        held.low = -(-LOW * held.scores // 100)
        held.high = HIGH * held.scores // 100
        return held

    def meet(held: SimpleNamespace, rows: pa.RecordBatch, vectors: np.ndarray) -> None:
        for asked, own, scores in _products(held, rows, vectors):
            other = held.label[asked][:, None] != own.label[None, :]
            for slot in range(positives):
                owners = np.arange(asked.start, asked.stop) * positives + slot
                floor = np.maximum(held.heaps.floor()[owners], held.low[asked, slot])
                inside = (scores >= floor[:, None]) & (scores <= held.high[asked, slot][:, None])
                inside &= other & (held.number[asked] > slot)[:, None]
                left, right = np.nonzero(inside)
                held.heaps.add(
                    owners[left], scores[left, right], own.vec_id[right], own.copies[right]
                )

    def report(held: SimpleNamespace) -> pa.RecordBatch:
        owner, score, ids, copies = held.heaps.entries()
        anchor, slot = owner // positives, owner % positives
        columns = {
            "anchor_id": held.vec_id[anchor],
            "anchor_digest": held.digest[anchor],
            "anchor_copies": held.copies[anchor],
            "slot": slot,
            "positive_id": held.ids[anchor, slot],
            "positive_score": held.scores[anchor, slot],
            "negative_id": ids,
            "copies": copies,
            "negative_score": score,
        }
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns.values()], names=list(columns)
        )

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return streamed(batches, hold, meet, report)

    return tiles


def _merged(lists: DataFrame, owner: list[str], score: str, row_id: str, k: int) -> DataFrame:
    """The best ``k`` of each owner's lists, copies of a row counted each."""
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k))))
    best = Window.partitionBy(*owner).orderBy(F.col(score).desc(), F.col(row_id))
    ranked = lists.withColumn("copy", each).withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    moved: Column,
    positives: int = 5,
    negatives: int = 3,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """For every anchor (a row whose ``vec_id`` meets ``anchors``) and each of its positives, the
    hardest negatives in the window of the positive's score. Where ``moved`` holds, the label
    first becomes the next one, after the last the first."""
    kept = F.col(label).cast("long")
    found = finite_vectors(
        rows, vector, F.col(vec_id).cast("long").alias("vec_id"), kept.alias("label")
    ).dropna(subset=["vec_id", "label"])
    relabelled = F.when(moved, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    vectors = stored(counted_rows(found.withColumn("label", relabelled)))
    size = vectors.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(anchors).alias("queries"),
        F.coalesce(F.max(F.size("vec")), F.lit(1)).alias("components"),
    ).first()
    grid = Grid.over(size["rows"], size["queries"], max(1, size["components"]))
    asked = vectors.filter(anchors)
    near = grid.deal(vectors, asked).mapInArrow(_positives(positives), _POSITIVES)
    best = _merged(near, _ANCHOR, "positive_score", "positive_id", positives)
    listed = best.groupBy(*_ANCHOR).agg(
        F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias(
            "positives"
        )
    )
    own = (listed["anchor_id"] == asked["vec_id"]) & (listed["anchor_digest"] == asked["digest"])
    windows = asked.join(listed, own).select(*asked.columns, "positives")
    far = grid.deal(vectors, windows).mapInArrow(_negatives(negatives, positives), _NEGATIVES)
    hardest = _merged(far, [*_ANCHOR, "slot"], "negative_score", "negative_id", negatives)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("anchor_copies")))
    return hardest.withColumn("turn", again).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
