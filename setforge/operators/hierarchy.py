"""Fixed-depth hierarchies flattened to (leaf, ancestor) pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_levels(
    df: DataFrame, id: str, parent: str, level: str, levels: Sequence[int], active: Column, out: tuple[str, str]
) -> DataFrame:
    """One branch per starting level, walked down to the leaves through active rows only.

    ``levels`` lists the levels from the top one to the leaf level. Only the starting row's
    level is checked; below it the parent links decide.
    """
    leaf, ancestor = out
    live = df.filter(active)
    step = live.select(F.col(id).alias("__child"), F.col(parent).alias("__parent"))
    branches = []
    for i, start in enumerate(levels):
        walk = live.filter(F.col(level) == start).select(F.col(id).alias(ancestor), F.col(id).alias(leaf))
        for _ in range(len(levels) - 1 - i):
            walk = walk.join(step, walk[leaf] == step["__parent"]).select(ancestor, F.col("__child").alias(leaf))
        branches.append(walk.select(leaf, ancestor))
    return reduce(DataFrame.unionByName, branches).distinct()
