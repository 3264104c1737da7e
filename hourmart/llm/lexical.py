"""Ranked lexical search the other way round: the items are indexed, the documents stream by.

The items' terms make a small inverted index, sent to all tasks. A first pass over the documents
counts how many there are, how long they are and how many hold each of the items' terms; a second
one runs each document's term counts through the index and keeps the best documents of every
item. The lists of tasks merge, first in sets of tasks, then all. Items whose text is too much for
one index are dealt into several, each with its own passes.

A null text has no terms; a document without terms is not counted. Whole texts are read, long ones
in steps. Null document ids come last among equal scores; equal rows of documents are ranked each.
Equal rows of items, a null id too, have a list each; an item without terms, or whose terms no
document holds, has none. Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import slices, texts
from hourmart.llm.heaps import Heaps

# Bytes of item text to an index, about; a longer item is an index of its own.
INDEX_BYTES = 16 << 20
# Document and item pairs scored at once, and bytes of text split at once.
CELLS = 2 << 20
STEP_BYTES = 4 << 20
# Tasks whose lists meet in the first merge.
TASK_SET = 64
MILLE = 1000
_COUNTED = "term BINARY, documents LONG, terms LONG"
_LISTED = "item INT, doc_id LONG, absent BOOLEAN, score LONG, task INT"


def _lowered() -> bytes:
    """Every byte to itself, A-Z to a-z, all other ASCII but letters and digits to a space."""
    return bytes(
        b if b >= 0x80 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32
        for b in range(256)
    )


_TABLE = _lowered()


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size (one term at least)."""
    plain = text.translate(_TABLE)
    low = 0
    while low < len(plain):
        high = low + STEP_BYTES
        if high < len(plain):
            found = plain.find(b" ", high)
            high = len(plain) if found < 0 else found
        yield plain[low:high].split()
        low = high


def weight(documents: int, holding: int) -> int:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))"""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _counted(vocabulary):
    """Documents and terms of a task's texts, and how many of the documents hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, documents, total, holding = vocabulary.value, 0, 0, Counter()
        for batch in slices(batches):
            for text in texts(batch.column("text")):
                length, own = 0, set()
                for some in terms(text):
                    length += len(some)
                    own |= known.intersection(some)
                documents += length > 0
                total += length
                holding.update(own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *holding], pa.binary()),
                pa.array([documents, *holding.values()], pa.int64()),
                pa.array([total, *[0] * len(holding)], pa.int64()),
            ],
            names=["term", "documents", "terms"],
        )

    return count


class Index:
    """Postings of the items' terms: for each term its number, weight and items."""

    def __init__(self, items: list[set[bytes]], documents: int, total: int, holding: dict) -> None:
        self.items, self.documents, self.total = len(items), documents, total
        found: dict[bytes, list[int]] = {}
        for number, own in enumerate(items):
            for term in own:
                if term in holding:
                    found.setdefault(term, []).append(number)
        self.numbers = {term: i for i, term in enumerate(found)}
        self.postings = [np.array(places) for places in found.values()]
        self.weights = [weight(documents, holding[term]) for term in found]

    def hits(self, text: bytes) -> tuple[int, Counter]:
        """Terms of a text, and how often it holds each of the index's."""
        length, own = 0, Counter()
        for some in terms(text):
            length += len(some)
            own.update(filter(self.numbers.__contains__, some))
        return length, own

    def scores(self, counted: list[tuple[int, Counter]]) -> np.ndarray:
        """Scores of documents (rows) for items (columns)."""
        out = np.zeros((len(counted), self.items), np.int64)
        places: dict[int, tuple[list[int], list[int]]] = {}
        for row, (length, own) in enumerate(counted):
            if not own:
                continue
            m = 100 - 90 + 90 * length * self.documents // self.total
            for term, times in own.items():
                rows, parts = places.setdefault(self.numbers[term], ([], []))
                rows.append(row)
                parts.append(1_000_000_000 * times // (MILLE * times + 8 * m))
        for number, (rows, parts) in places.items():
            value = np.array(parts, np.int64) * self.weights[number]
            out[np.ix_(rows, self.postings[number])] += value[:, None]
        return out


def _streamed(index, k: int):
    """The best ``k`` documents of every item among a task's."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = index.value
        heaps = Heaps(found.items, k, LOWEST)
        step = max(1, CELLS // max(1, found.items))
        for batch in slices(batches):
            ids = batch.column("doc_id")
            absent = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(LAST_ID).to_numpy(zero_copy_only=False)
            for low in range(0, batch.num_rows, step):
                part = slice(low, low + step)
                counted = [found.hits(t) for t in texts(batch.column("text")[part])]
                scores = found.scores(counted)
                row, item = np.nonzero(scores >= np.maximum(heaps.floor(), 1))
                heaps.add(item, scores[row, item], ids[part][row], absent[part][row])
        item, score, ids, absent = heaps.entries()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item.astype(np.int32)),
                pa.array(ids, mask=absent.astype(bool)),
                pa.array(absent.astype(bool)),
                pa.array(score),
                pa.array(np.full(len(item), TaskContext.get().partitionId(), np.int32)),
            ],
            names=["item", "doc_id", "absent", "score", "task"],
        )

    return search


LOWEST = np.iinfo(np.int64).min
LAST_ID = np.iinfo(np.int64).max


def _best(lists: DataFrame, k: int, *owner) -> DataFrame:
    order = [F.col("score").desc(), F.col("absent"), F.col("doc_id")]
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy(*owner).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def _ranked(docs: DataFrame, items: list, k: int) -> DataFrame:
    """The best documents of some items, given as rows (item_id, text, copies)."""
    context = docs.sparkSession.sparkContext
    own = [{t for some in terms((row["text"] or "").encode()) for t in some} for row in items]
    vocabulary = context.broadcast(frozenset().union(*own))
    found = docs.select("text").mapInArrow(_counted(vocabulary), _COUNTED)
    totals = found.groupBy("term").agg(
        F.sum("documents").alias("documents"), F.sum("terms").alias("terms")
    )
    # One row a term of the index, which is bounded.
    sums = {row["term"]: row for row in totals.collect()}
    holding = {bytes(t): row["documents"] for t, row in sums.items() if t is not None}
    every = sums.get(None)
    counts = (every["documents"], every["terms"]) if every else (0, 0)
    index = context.broadcast(Index(own, *counts, holding))
    lists = docs.select("doc_id", "text").mapInArrow(_streamed(index, k), _LISTED)
    some = _best(lists, k, "item", F.floor(F.col("task") / TASK_SET))
    names = docs.sparkSession.createDataFrame(
        [(i, row["item_id"], row["copies"]) for i, row in enumerate(items)],
        "item INT, item_id LONG, copies LONG",
    )
    # As many names as the index has items.
    named = _best(some, k, "item").join(F.broadcast(names), "item")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return named.withColumn("turn", again).select("item_id", "rank", "doc_id", "score")


def ranked_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """The ``k`` best documents (``doc_id``, ``text``) of every item (``item_id``, ``text``)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = (
        items.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .groupBy("item_id", "text")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    size = counted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    indexes = math.ceil(size / index_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(indexes))
    found = None
    for number in range(indexes):
        some = counted.filter(part == number).sort("item_id", "text").collect()
        if some or (found is None and number == indexes - 1):
            best = _ranked(docs, some, k)
            found = best if found is None else found.unionByName(best)
    return found
