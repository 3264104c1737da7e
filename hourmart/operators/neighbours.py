"""Next and previous row inside a group, also when one group is very large.

A window sorts each group in one task. That is fine until one group (the events
without a user, a crawler's click) holds a large share of the rows. Such hot
groups are found by a count of the rows the window would see (of those groups only
that could be that large), taken out of the plain plan, and cut into slots: consecutive ranges of the group's own order, many
per group, each a separate window. A slot's edge then gets its neighbour from a
summary with one row per slot. Both ways give the same rows, and nothing limits
how many groups are hot or how many slots they need.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A group with at least this many rows is hot; also the aim for rows per slot.
SPLIT_ROWS = 1_000_000
# Up to so many hot keys are broadcast: with keys of at most 90 bytes, some 10 MB.
LISTED_GROUPS = 100_000
# Beyond, the rows of a hot group meet its key in so many tasks.
SALTS = 64
SLOT = "_slot"


@dataclass(frozen=True)
class HotGroups:
    """The hot keys (no frame if there are none), how many they are, and their rows."""

    keys: DataFrame | None = None
    number: int = 0
    rows: int = 0


def find_hot_groups(
    counts: DataFrame, keys: list[str], split_rows: int = SPLIT_ROWS
) -> HotGroups:
    """Hot groups from per-group counts (``keys`` plus ``n``).

    The keys stay a distributed frame, checkpointed if there are any; only their number
    and the sum of their rows come to the driver.
    """
    hot = counts.filter(F.col("n") >= split_rows).select(*keys, "n")
    found = hot.agg(F.count(F.lit(1)).alias("number"), F.sum("n").alias("rows")).first()
    if not found["number"]:
        return HotGroups()
    use_checkpoint_folder(counts.sparkSession)
    return HotGroups(hot.select(*keys).checkpoint(), found["number"], found["rows"])


def find_hot_groups_of_join(
    counts: DataFrame,
    weights: DataFrame,
    exact: Callable[[HotGroups], DataFrame],
    keys: list[str],
    split_rows: int = SPLIT_ROWS,
) -> HotGroups:
    """Hot groups of rows that a join multiplies, mostly without joining them.

    ``counts`` has the rows ``n`` of each group before the join, ``weights`` how many rows
    ``w`` each of them can become at most. One job takes the largest of both: if their product is
    below ``split_rows`` nothing can be hot. Else the groups that could be are candidates,
    and ``exact`` counts these, and only these, as the window will see them.
    """
    largest = counts.agg(F.lit("n").alias("of"), F.max("n").alias("most"))
    widest = weights.agg(F.lit("w").alias("of"), F.max("w").alias("most"))
    most = {row["of"]: row["most"] or 0 for row in largest.unionByName(widest).collect()}
    rows, factor = most["n"], max(1, most["w"])
    if rows * factor < split_rows:
        return HotGroups()
    candidates = find_hot_groups(counts, keys, math.ceil(split_rows / factor))
    if factor == 1 or candidates.keys is None:
        return candidates
    return find_hot_groups(exact(candidates), keys, split_rows)


def _renamed(groups: DataFrame, keys: list[str]) -> DataFrame:
    return groups.withColumnsRenamed({key: f"_g_{key}" for key in keys})


def _same_group(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])


def _against(rows: DataFrame, groups: HotGroups, keys: list[str], how: str) -> DataFrame:
    listed = _renamed(groups.keys, keys)
    if groups.number <= LISTED_GROUPS:
        return rows.join(F.broadcast(listed), _same_group(keys), how)
    # Too many for a broadcast: the hot side is salted, its few columns are repeated.
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    salted = rows.withColumn("_salt", salt)
    repeated = listed.withColumn("_g_salt", salts)
    same = _same_group(keys) & (F.col("_salt") == F.col("_g_salt"))
    return salted.join(repeated, same, how).drop("_salt")


def without_groups(rows: DataFrame, groups: HotGroups, keys: list[str]) -> DataFrame:
    """Rows outside the given groups."""
    return _against(rows, groups, keys, "left_anti")


def within_groups(rows: DataFrame, groups: HotGroups, keys: list[str]) -> DataFrame:
    """Rows of the given groups."""
    return _against(rows, groups, keys, "left_semi")


def use_checkpoint_folder(spark: SparkSession) -> None:
    """Checkpoints go where the cluster says; local sessions may use a temp folder."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="hourmart-checkpoint-")
    context.setCheckpointDir(folder)


def place_in_slots(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    hot_rows: int,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Hot rows with a slot number that rises with the order inside each group.

    A range partitioning on group and order cuts by row count, whatever the
    values are. Its borders come from a sample, so the placed rows are
    checkpointed: every later step, and every retry, sees the same slots.
    """
    use_checkpoint_folder(rows.sparkSession)
    slots = max(2, math.ceil(hot_rows / split_rows) * 2)
    placed = rows.repartitionByRange(slots, *keys, *order).withColumn(
        SLOT, F.spark_partition_id()
    )
    return placed.checkpoint()


class Neighbours:
    """Values of the rows before or after each row, by group and order.

    ``order`` must tell any two rows of a group apart.
    """

    def __init__(self, keys: list[str], order: list[str]):
        self.keys = keys
        self.order = order

    def shift(self, rows: DataFrame, value: str, step: int, name: str) -> DataFrame:
        """Adds ``name``: ``value`` of the row ``step`` places on (or back, if
        negative); NULL where there is none."""
        if step == 0:
            raise ValueError("step must not be 0")
        if SLOT not in rows.columns:
            window = Window.partitionBy(*self.keys).orderBy(*self.order)
            moved = F.lead(value, step) if step > 0 else F.lag(value, -step)
            return rows.withColumn(name, moved.over(window))
        forward = step > 0
        shifted = rows.withColumn("_moved", F.col(value))
        for _ in range(abs(step)):
            shifted = self._shift_across_slots(shifted, "_moved", forward)
        return shifted.withColumn(name, F.col("_moved")).drop("_moved")

    def _shift_across_slots(self, rows: DataFrame, value: str, forward: bool) -> DataFrame:
        move = F.lead if forward else F.lag
        groups = [*self.keys, SLOT]
        in_slot = Window.partitionBy(*groups).orderBy(*self.order)
        # A struct tells "no neighbour in this slot" from "neighbour holds NULL".
        boxed = rows.withColumn("_box", F.struct(F.col(value).alias("v")))
        position = F.struct(*self.order)
        edge = F.min_by("_box", position) if forward else F.max_by("_box", position)
        edges = boxed.groupBy(*groups).agg(edge.alias("_edge"))
        across = Window.partitionBy(*self.keys).orderBy(SLOT)
        carried = edges.withColumn("_carried", move("_edge").over(across)).drop("_edge")
        inside = boxed.withColumn("_inside", move("_box").over(in_slot))
        joined = inside.join(_renamed(carried, groups), _same_group(groups), "left")
        return joined.select(
            *[c for c in rows.columns if c != value],
            F.coalesce("_inside", "_carried")["v"].alias(value),
        )
