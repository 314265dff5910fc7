"""Cycles and ancestor counts in a parent/child table (each id has one parent)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setforge.session import cut_lineage


def _cycle_nodes(edges: DataFrame) -> DataFrame:
    """(id, parent) of the rows that lie on a cycle.

    Every round keeps only ids that are still reached (they have a descendant 1, 2, 4, ...
    steps below), drops those whose way leaves the set, and doubles the step. Trees hanging on
    a cycle or a root fall off in log2(depth) rounds. When nothing falls off any more, the
    step is a one-to-one map of the rest onto itself, so all of it lies on cycles.
    """
    live = cut_lineage(edges.filter(F.col("parent").isNotNull()).select("id", "parent", F.col("parent").alias("jump")))
    left = live.count()
    while True:
        reached = live.select(F.col("jump").alias("id")).distinct()
        kept = live.join(reached, "id", "left_semi")
        ahead = live.select(F.col("id").alias("__id"), F.col("jump").alias("__jump"))
        live = cut_lineage(
            kept.join(ahead, kept["jump"] == ahead["__id"]).select("id", "parent", F.col("__jump").alias("jump"))
        )
        before, left = left, live.count()
        if left == before:
            return live.select("id", "parent")


def cycle_members(edges: DataFrame, id: str = "id", parent: str = "parent_id") -> DataFrame:
    """(cycle_id, pos, id): each cycle named by its smallest id; ``pos`` counts parent steps to it."""
    nodes = _cycle_nodes(edges.select(F.col(id).alias("id"), F.col(parent).alias("parent")))
    state = cut_lineage(
        nodes.select("id", F.col("parent").alias("jump"), F.col("id").alias("low"), F.lit(0).cast("bigint").alias("at"))
    )
    span = 1
    while True:
        ahead = state.select(
            F.col("id").alias("__id"), F.col("jump").alias("__jump"), F.col("low").alias("__low"), F.col("at").alias("__at")
        )
        better = F.col("__low") < F.col("low")
        state = cut_lineage(
            state.join(ahead, state["jump"] == ahead["__id"]).select(
                "id",
                F.col("__jump").alias("jump"),
                F.when(better, F.col("__low")).otherwise(F.col("low")).alias("low"),
                F.when(better, F.col("__at") + F.lit(span)).otherwise(F.col("at")).alias("at"),
                better.alias("moved"),
            )
        )
        span *= 2
        if state.filter("moved").isEmpty():
            return state.select(F.col("low").alias("cycle_id"), F.col("at").alias("pos"), "id")
        state = state.drop("moved")


def find_cycles(
    edges: DataFrame, id: str = "id", parent: str = "parent_id", limit: int | None = None
) -> DataFrame:
    """(start_id, path): per start the walk down its cycle, ``a -> b -> ... -> start``.

    All starts, or the ``limit`` highest ids, highest first. One path text names a whole
    cycle, so a row is as long as its cycle; ``cycle_members`` is the form for huge cycles.
    """
    members = cycle_members(edges, id, parent)
    starts = members.orderBy(F.col("id").desc())
    starts = starts.limit(limit) if limit is not None else members
    rings = (
        members.join(starts.select("cycle_id").distinct(), "cycle_id", "left_semi")
        .groupBy("cycle_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.col("id").cast("string").alias("id")))).alias("ring"))
        .select("cycle_id", F.transform("ring", lambda r: r["id"]).alias("ring"))
    )
    turn = (F.col("pos") + 1).cast("int")
    rest = F.slice("ring", turn + 1, F.greatest(F.size("ring") - turn, F.lit(0)))
    path = F.array_join(F.concat(rest, F.slice("ring", F.lit(1), turn)), " -> ")
    found = starts.join(rings, "cycle_id").select(F.col("id").alias("start_id"), path.alias("path"))
    return found.orderBy(F.col("start_id").desc())


def ancestor_counts(edges: DataFrame, id: str = "id", parent: str = "parent_id") -> DataFrame:
    """(id, parent, depth): how many rows lie on the way up, the row itself included.

    Step doubling again: log2(depth) joins. Raises on a cycle.
    """
    rows = edges.select(F.col(id).alias("id"), F.col(parent).alias("parent"))
    known = rows.select(F.col("id").alias("__known"))
    state = cut_lineage(
        rows.join(known, rows["parent"] == known["__known"], "left").select(
            "id", "parent", F.col("__known").alias("jump"), F.lit(1).cast("bigint").alias("depth")
        )
    )
    total, span = state.count(), 1
    while not state.filter(F.col("jump").isNotNull()).isEmpty():
        if span > total:
            raise ValueError("the parent links contain a cycle")
        climbing, done = state.filter(F.col("jump").isNotNull()), state.filter(F.col("jump").isNull())
        ahead = state.select(F.col("id").alias("__id"), F.col("jump").alias("__jump"), F.col("depth").alias("__depth"))
        moved = climbing.join(ahead, climbing["jump"] == ahead["__id"]).select(
            "id", "parent", F.col("__jump").alias("jump"), (F.col("depth") + F.col("__depth")).alias("depth")
        )
        state = cut_lineage(done.unionByName(moved))
        span *= 2
    return state.select("id", "parent", "depth")


def closure(edges: DataFrame, id: str = "id", parent: str = "parent_id") -> DataFrame:
    """Every row once per ancestor-or-self, as the recursive union of rows with their children gives."""
    counted = ancestor_counts(edges, id, parent)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("depth")))
    return counted.select(F.col("id").alias(id), F.col("parent").alias(parent), copies.alias("__n")).drop("__n")


def closure_bounded(edges: DataFrame, id: str = "id", parent: str = "parent_id", max_depth: int = 100) -> DataFrame:
    """(id, parent, level): every row once per way up of ``level`` steps, for 0 to ``max_depth`` steps.

    The recursive union with a bound: on cyclic data it ends at the bound in place of running on. Only the
    rows that the last step reached go on, as one row per id with the number of its copies, so ids that occur more than
    once keep all their ways. Each step is written out, and the loop ends as soon as a step reaches nothing.
    """
    rows = edges.select(F.col(id).alias(id), F.col(parent).alias(parent))
    here = rows.withColumn("__n", F.lit(1).cast("bigint"))
    levels = []
    for level in range(max_depth + 1):
        here = cut_lineage(here)
        if level and here.isEmpty():
            break
        levels.append(here.withColumn("level", F.lit(level)))
        reached = here.groupBy(F.col(id).alias("__up")).agg(F.sum("__n").alias("__n"))
        here = rows.join(reached, F.col(parent) == F.col("__up")).select(id, parent, "__n")
    found = reduce(DataFrame.unionByName, levels)
    return found.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n")))).select(id, parent, "level")
