"""Keep a stored snapshot in step with a newly computed one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE, KEEP = "INSERT", "UPDATE", "DELETE", "KEEP"
#: A key that the source holds more than once, with and without a target row; nothing happens to it.
REFUSE_UPDATE, REFUSE_INSERT = "REFUSE_UPDATE", "REFUSE_INSERT"


def merge_snapshot(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    delete_when: Column | None = None,
    action: str = "action",
    settle: Sequence[Column] | None = None,
) -> DataFrame:
    """One full outer join that says what happens to every row.

    Target and source must already be narrowed to the same scope. Matched rows take the source
    values when a compared column differs (a NULL on either side is no difference). Target rows
    without a source row are deleted where ``delete_when`` (over target columns) holds. The
    result carries the values after the merge; deleted rows show their old values.

    The source is brought to one row per key before the join, so that no target row is doubled. Of rows
    that share a key the first by ``settle`` counts, ties by their values in column order. Without ``settle`` such a
    key is refused: its target row stays, and a key that the target lacks shows NULL values. A key that the target
    holds twice is no offence; all its rows get the same treatment.
    """
    rest = [c for c in target.columns if c not in keys]
    flag = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(True)
    t = target.withColumn("__gone", flag).select(
        *keys, F.struct(*rest).alias("__t"), F.col("__gone"), F.lit(True).alias("__in_t")
    )
    row = F.struct(*rest)
    first = F.min_by(row, F.struct(*(settle or []), row))
    s = source.groupBy(*keys).agg(first.alias("__s"), F.count(F.lit(1)).alias("__rows"), F.lit(True).alias("__in_s"))
    repeated = F.lit(False) if settle is not None else F.coalesce(F.col("__rows") > 1, F.lit(False))
    differs = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(f"__t.{c}") != F.col(f"__s.{c}"), F.lit(False)) for c in compare],
        F.lit(False),
    )
    what = (
        F.when(repeated, F.when(F.col("__in_t").isNull(), REFUSE_INSERT).otherwise(REFUSE_UPDATE))
        .when(F.col("__in_t").isNull(), INSERT)
        .when(F.col("__in_s").isNull(), F.when(F.col("__gone"), DELETE).otherwise(KEEP))
        .when(differs, UPDATE)
        .otherwise(KEEP)
    )
    joined = t.join(s, list(keys), "full_outer").withColumn(action, what)
    new = F.col(action).isin(INSERT, UPDATE)
    return joined.select(
        *keys, *[F.when(new, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")).alias(c) for c in rest], action
    ).select(*target.columns, action)


def merged_rows(merged: DataFrame, action: str = "action") -> DataFrame:
    """The snapshot after the merge; refused keys are as they were."""
    return merged.filter(~F.col(action).isin(DELETE, REFUSE_INSERT)).drop(action)


def refused_rows(merged: DataFrame, action: str = "action") -> DataFrame:
    """The keys that the source held more than once."""
    return merged.filter(F.col(action).isin(REFUSE_INSERT, REFUSE_UPDATE))


class RepeatedKeys(ValueError):
    """Raised where a merge that refused keys would be written; ``rows`` lists them all."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        super().__init__("the source of the merge holds keys more than once; see .rows")


def change_summary(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def delete_where(
    target: DataFrame, source: DataFrame, on: Sequence[str], scope: Column, also: Column | None = None
) -> DataFrame:
    """What is left of ``target`` after deleting scoped rows found in ``source`` or meeting ``also``."""
    marks = source.select(*on).distinct().withColumn("__hit", F.lit(True))
    hit = F.col("__hit").isNotNull()
    if also is not None:
        hit = hit | also
    gone = F.coalesce(scope & hit, F.lit(False))
    return target.join(marks, list(on), "left").filter(~gone).select(*target.columns)
