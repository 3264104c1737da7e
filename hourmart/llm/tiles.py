"""A stated set of query vectors against all vectors, in tiles of bounded size.

Queries are dealt into groups that one task can hold, all rows into strips that a task streams
through; a task gets one group and one strip. Equal rows are counted before, so that rows are
dealt by a hash of what tells them apart and no key is hot. Shuffled are each row once for every
group and each query once for every strip.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Vector components of the queries that a task holds.
GROUP_CELLS = 4 << 20
# Rows of a strip, as long as there are no more than so many strips; then strips get longer.
STRIP_ROWS = 4096
STRIPS = 512
# Queries, and rows, of one matrix product.
BLOCK = 2048
_KINDS = {"float", "double"}


def finite_vectors(rows: DataFrame, vector: str, *columns: Column) -> DataFrame:
    """``columns`` and ``vec`` of the rows whose vector has neither null nor non-finite parts."""
    kind = rows.schema[vector].dataType
    own = isinstance(kind, T.ArrayType) and kind.elementType.typeName() in _KINDS
    vec = F.col(vector) if own else F.col(vector).cast("array<double>")
    inf = F.lit(float("inf"))
    found = rows.select(*columns, vec.alias("vec")).filter(F.col("vec").isNotNull())
    return found.filter(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != inf))
    )


def counted_rows(rows: DataFrame) -> DataFrame:
    """One row for equal rows, with their number ``copies`` and a hash ``digest`` of the row."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    return counted.withColumn("digest", F.xxhash64(*rows.columns))


@dataclass(frozen=True)
class Grid:
    """How many groups of queries and strips of rows there are."""

    groups: int
    strips: int

    @classmethod
    def over(cls, rows: int, queries: int, components: int) -> Grid:
        strips = min(STRIPS, math.ceil(rows / STRIP_ROWS))
        return cls(max(1, math.ceil(queries * components / GROUP_CELLS)), max(1, strips))

    def deal(self, rows: DataFrame, queries: DataFrame) -> DataFrame:
        """Every tile in a partition of its own: its queries first (``kind`` 0), then its rows.

        Both have a column ``digest`` of their own rows; columns that one side lacks are null.
        """
        strips, groups = F.lit(self.strips), F.lit(self.groups)
        group, strip = F.pmod("digest", groups), F.pmod(F.shiftright("digest", 32), strips)

        def every(number: int, tile) -> Column:
            return F.explode(F.transform(F.sequence(F.lit(0), F.lit(number - 1)), tile))

        asked = queries.withColumn("kind", F.lit(0)).withColumn(
            "tile", every(self.strips, lambda s: (group * strips + s).cast("int"))
        )
        streamed = rows.withColumn("kind", F.lit(1)).withColumn(
            "tile", every(self.groups, lambda g: (g * strips + strip).cast("int"))
        )
        both = asked.unionByName(streamed, allowMissingColumns=True)
        return both.repartitionById(self.groups * self.strips, F.col("tile")).sortWithinPartitions(
            "tile", "kind"
        )


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of one kind, tile and vector length, with their vectors as a matrix."""
    vectors = batch.column("vec")
    lengths = pc.list_value_length(vectors)
    keys = np.stack(
        [batch.column(n).to_numpy(zero_copy_only=False) for n in ("tile", "kind")]
        + [lengths.to_numpy(zero_copy_only=False)],
        axis=1,
    )
    for key in np.unique(keys, axis=0):
        own = (keys == key).all(axis=1)
        rows = batch if own.all() else batch.filter(pa.array(own))
        flat = rows.column("vec").flatten().to_numpy(zero_copy_only=False)
        yield rows, flat.reshape(rows.num_rows, int(key[2]))


def numbers(rows: pa.RecordBatch, column: str) -> np.ndarray:
    return rows.column(column).to_numpy(zero_copy_only=False)


def blocks(count: int, size: int = BLOCK) -> Iterator[slice]:
    for low in range(0, count, size):
        yield slice(low, min(low + size, count))


def streamed(batches: Iterator[pa.RecordBatch], hold, meet, report) -> Iterator[pa.RecordBatch]:
    """A task's tiles: ``hold(batches, vectors)`` the queries of each vector length, then
    ``meet(held, batch, vectors)`` the rows of that length, and ``report(held)`` at the end."""
    tile, waiting, held = None, {}, {}

    def ready() -> None:
        for length, parts in waiting.items():
            held[length] = hold([p[0] for p in parts], np.concatenate([p[1] for p in parts]))
        waiting.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        for rows, vectors in by_length(batch):
            number, kind = rows.column("tile")[0].as_py(), rows.column("kind")[0].as_py()
            if number != tile:
                ready()
                for queries in held.values():
                    yield report(queries)
                tile, held = number, {}
            if kind == 0:
                waiting.setdefault(vectors.shape[1], []).append((rows, vectors))
                continue
            ready()
            if (queries := held.get(vectors.shape[1])) is not None:
                meet(queries, rows, vectors)
    ready()
    for queries in held.values():
        yield report(queries)
