"""Toxicity by a bidirectional recurrent network over all overlapping windows of a text.

The network is fitted on the driver on a bounded sample of labelled documents, chosen by digest
and read whole; every text is scored whole, by its most toxic window. Null and empty texts get the score of an
empty window. Without labelled rows of both kinds every score is 0. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm import gru
from hourmart.llm.common import slices, texts

# Labelled documents of label 1 and of label 0 in the sample.
FIT_TOXIC, FIT_CLEAN = 400, 800
# Characters of either label after which no further document is taken; the last one is whole, too.
FIT_TOTAL = 16 << 20


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    toxic: int = FIT_TOXIC,
    clean: int = FIT_CLEAN,
    total: int = FIT_TOTAL,
) -> gru.Network | None:
    """A network from the labelled rows where ``learn`` holds."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    known = known.filter(learn & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    spread = F.xxhash64("doc_id")
    chosen = [known.filter(F.col("toxic") == k).orderBy(spread).limit(n) for k, n in ((1, toxic), (0, clean))]
    # Broadcast: at most as many rows as the sample has.
    sample = F.broadcast(chosen[0].union(chosen[1]))
    texts_ = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(
        "text IS NOT NULL"
    )
    rows = texts_.join(sample, "doc_id").orderBy(spread, "text").limit(toxic + clean)
    before = F.sum(F.length("text").cast("long")).over(
        Window.partitionBy("toxic").orderBy(spread, "text").rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < total)
    rows = rows.orderBy(spread, "text").collect()
    marks = np.array([r["toxic"] for r in rows])
    if len(np.unique(marks)) < 2:
        return None
    split = [[gru.plain(w) for w in r["text"].encode().split()] for r in rows]
    network = gru.Network(gru.Lookup.of(split))
    network.train(split, marks)
    return network


def _score(network: gru.Network | None, most: int = 300_000):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        # Rows of known words; the array is larger than they need.
        gates = np.zeros((1024, 2, 3 * gru.HIDDEN), np.float32)
        for batch in slices(batches):
            split = [t.split() for t in texts(batch.column("text"))]
            scores = np.zeros(len(split))
            if network is not None:
                if len(number) > most:
                    number = {}
                flat = [w for ws in split for w in ws]
                new = list(set(flat).difference(number))
                if new:
                    rows, low = network.lookup.rows([gru.plain(w) for w in new]), len(number)
                    number.update(zip(new, range(low, low + len(new))))
                    if len(number) > len(gates):
                        grown = np.zeros((2 * len(number), *gates.shape[1:]), np.float32)
                        grown[:low], gates = gates[:low], grown
                    gates[low : low + len(new)] = network.gates(network.embed(*rows))
                words = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
                sizes = np.array([len(ws) for ws in split])
                text, _, logit = network.logits(gates, words, sizes)
                top = np.full(len(split), -np.inf)
                np.maximum.at(top, text, logit)
                scores = gru.sigmoid(top)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def score(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; labels are used where ``learn`` holds."""
    network = fit(docs, labels, learn)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), (~learn).alias("held_out")
    )
    return rows.mapInArrow(
        _score(network), "doc_id long, held_out boolean, score double, predicted int"
    )
