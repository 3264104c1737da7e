"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every document is queued in its source in a shuffled but fixed order, as often as it
may be taken. Its virtual finish time is the words of its source up to and with it,
divided by the target of the source, so that all sources reach their targets at time
one. The queue of all sources, sorted by that time, is cut where the budget is spent.

Neither a source nor the whole queue is ever in one task. A source is shuffled by a
digest, whose first digits make ``BUCKETS`` equal parts; the queue has a nearly equal
number of words in each slice of time. Sums over parts, then over the rows of a part,
give the same running sums as one sort would.

Null and empty texts have size 0, are never taken and count nothing. A null source is
a source of its own. Repeated rows are documents of their own: equal rows are
numbered, so each of them is queued, and reruns agree. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.llm.common import WORD, saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
# Parts of a source and slices of time; a part holds its rows in one task.
BUCKETS = 4096
# Numbers of equal rows are made in blocks of so many.
BLOCK = 1 << 16


def _digest() -> Column:
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the digest that shuffles; the text goes no further."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        _digest().alias("digest"),
    )


def targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """source, source_size, target of one row per source (source, source_size).

    The excess of full sources goes to the others by weight until none is over its
    limit. Sorted by limit per weight, the full ones come first, so the level of the
    rest is what is left of the budget by what is left of the weights, at the first
    source that this level does not fill. This sorts one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    limited = sources.withColumn("weight", F.get(cycle, rank)).withColumn(
        "most", F.lit(float(repeats)) * F.col("source_size")
    )
    by_level = Window.orderBy(
        F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = limited.withColumn(
        "level", F.when(F.col("most") > F.col("weight") * level, level)
    )
    # The first one that its level does not fill sets the level for it and all after it.
    return levelled.withColumn(
        "reached", F.first("level", ignorenulls=True).over(everything)
    ).select(
        "source",
        "source_size",
        F.least(
            F.col("most"), F.coalesce(F.col("weight") * F.col("reached"), F.col("most"))
        ).alias("target"),
    )


def running(rows: DataFrame, keys: list[str], part: Column, order: list[Column]) -> DataFrame:
    """``rows`` with ``upto``: the sum of ``size`` of a key up to and with the row.

    ``part`` orders like ``order``; one task holds the rows of a key and part only.
    """
    rows = rows.withColumn("part", part)
    sums = rows.groupBy(*keys, "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("earlier", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
    within = (
        Window.partitionBy(*keys, "part").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    left, right = rows.alias("l"), sums.alias("r")
    same = F.col("l.part") == F.col("r.part")
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return (
        left.join(right, same)
        .select("l.*", "earlier")
        .withColumn("upto", F.col("earlier") + F.sum("size").over(within))
        .drop("part", "earlier")
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = MOST_REPEATS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, digest: one row per row of ``docs``."""
    sized = saved(sizes(docs))
    # Equal rows are told apart by number, so that each is queued and none is doubled.
    rows = sized.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("copies"))
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / BLOCK)))
    copy = F.explode(
        F.sequence(
            F.col("block") * BLOCK + 1, F.least((F.col("block") + 1) * BLOCK, F.col("copies"))
        )
    )
    rows = rows.withColumn("block", block).withColumn("copy", copy).drop("copies", "block")

    of_source = targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats
    )
    of_source = saved(of_source)
    order = [F.col("digest"), F.col("doc_id"), F.col("copy")]
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    queued = running(rows, ["source"], F.floor(place * buckets / F.lit(1 << 32)), order).alias("q")
    queued = queued.join(
        of_source.alias("s"), F.col("q.source").eqNullSafe(F.col("s.source"))
    ).select("q.*", "source_size", "target")

    turns = queued.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = F.when(
        F.col("target") > 0,
        (F.col("turn") * F.col("source_size") + F.col("upto")) / F.col("target"),
    ).otherwise(0.0)
    turns = turns.withColumn("finish", finish)
    budget = F.lit(of_source.agg(F.sum("target")).first()[0]).cast("double")
    # Slices of time up to one, and as many of all time after it.
    slice_ = F.when(F.col("finish") <= 1, F.col("finish")).otherwise(2 - 1 / F.col("finish"))
    by_time = running(
        turns.withColumn("all", F.lit(0)),
        ["all"],
        F.floor(slice_ * buckets),
        [F.col("finish"), F.col("source").asc_nulls_last(), *order, F.col("turn")],
    )
    taken = by_time.withColumn(
        "taken", F.when(F.col("upto") <= budget, F.col("size")).otherwise(F.lit(0))
    )
    return taken.groupBy("doc_id", "source", "size", "digest", "copy").agg(
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum("taken").cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows as often as the mix takes them, all columns as they are.

    Rows of one id, source and text are alike to the mix and share its turns one by one.
    """
    mixed = mix(docs, **options).filter("taken > 0").select(
        "digest", "doc_id", "source", "copy", (F.col("taken") / F.col("size")).cast("int").alias("times")
    )
    # The row goes along as one value, so that none of its columns can clash with ours.
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", _digest().alias("digest"))
    nth = F.row_number().over(
        Window.partitionBy("digest", "doc_id", "source").orderBy(F.lit(1))
    ).cast("long")
    left, right = rows.withColumn("nth", nth).alias("l"), mixed.alias("r")
    met = left.join(
        right,
        (F.col("l.digest") == F.col("r.digest"))
        & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
        & F.col("l.source").eqNullSafe(F.col("r.source"))
        & (F.col("l.nth") == F.col("r.copy")),
    )
    turns = F.explode(F.sequence(F.lit(1), F.col("r.times")))
    return met.select("l.row", turns.alias("turn")).select("row.*")
