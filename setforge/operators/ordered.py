"""Running totals, ranks and row ids over one global order, without a one-task window.

A window without PARTITION BY runs in a single task. Here the rows are dealt by ranges of the order
key and written once; the window runs inside each range, and a table with one total per range
supplies the offsets. Only that small table is ever handled in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setforge.session import cut_lineage
from setforge.sources.inline import values

RANGE = "__range"


@dataclass(frozen=True)
class Order:
    """One column of an order key."""

    column: str
    descending: bool = False

    @property
    def sort(self) -> Column:
        # NULL sorts lowest, as in the reference SQL dialect.
        c = F.col(self.column)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()


def as_order(order_by: str | Order | Sequence[str | Order]) -> list[Order]:
    items = [order_by] if isinstance(order_by, (str, Order)) else list(order_by)
    return [i if isinstance(i, Order) else Order(i) for i in items]


def cut_table(cuts: Sequence, kind: str = "bigint") -> Column:
    """Ascending cut points as one constant: a text the optimizer folds, however many there are."""
    if not cuts:
        return F.array().cast(f"array<{kind}>")
    return F.sort_array(F.split(F.lit(",".join(str(c) for c in cuts)), ",").cast(f"array<{kind}>"))


def count_cuts(value: Column, cuts: Sequence, inclusive: bool, kind: str = "bigint") -> Column:
    """How many of the ascending ``cuts`` lie below ``value`` (``inclusive``: at or below).

    A binary search in one native expression: log2(len(cuts)) steps per row, compared in the
    type of the column, so long and decimal positions stay exact.
    """
    n = len(cuts)
    if n == 0:
        return F.lit(0)
    table = cut_table(cuts, kind)
    steps = [1 << k for k in reversed(range(n.bit_length()))]

    def advance(found: Column, step: Column) -> Column:
        probe = F.get(table, found + step - F.lit(1))
        below = (probe <= value) if inclusive else (probe < value)
        return F.when((found + step <= F.lit(n)) & below, found + step).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def default_ranges(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_range(df: DataFrame, order: list[Order], ranges: int | None = None) -> DataFrame:
    """``df`` written with a range number that follows the order key.

    All order columns, of any type that sorts, take part in the cut, so a hot leading value is split by the
    columns after it. ``df`` itself is computed once: the sample for the cut points and the rows come
    from its written copy, and so does every later reader of the ranges.
    """
    sorts = [o.sort for o in order]
    ranged = cut_lineage(df).repartitionByRange(ranges or default_ranges(df), *sorts)
    return cut_lineage(ranged.withColumn(RANGE, F.spark_partition_id()))


@dataclass(frozen=True)
class RunningTotals:
    """``rows`` carry the running totals; the rest describes the ranges they were built in."""

    rows: DataFrame
    range_ends: list  # running total at the end of each range, ascending
    minimum: object  # smallest value seen, None for an empty input
    has_zero: bool
    kind: str  # type of the totals


def running_totals(
    df: DataFrame,
    value: str | Column,
    order_by: str | Order | Sequence[str | Order],
    before: str = "before",
    after: str = "after",
    ranges: int | None = None,
) -> RunningTotals:
    """Exclusive and inclusive running sums. The order key must be unique; NULL counts as 0."""
    order = as_order(order_by)
    amount = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))
    if isinstance(value, str) and dict(df.dtypes)[value] in ("tinyint", "smallint", "int"):
        amount = amount.cast("bigint")
    ranged = with_range(df, order, ranges)
    totals = (
        ranged.groupBy(RANGE)
        .agg(F.sum(amount).alias("total"), F.min(amount).alias("low"), F.max((amount == 0).cast("int")).alias("zero"))
        .orderBy(RANGE)
        .collect()  # one row per range, not per input row
    )
    ends = list(accumulate(r.total for r in totals))
    kind = ranged.select(F.sum(amount).alias("total")).schema["total"].dataType.simpleString()
    offsets = values(
        df.sparkSession,
        [(r[RANGE], end - r.total) for r, end in zip(totals, ends)],
        {RANGE: "int", "__offset": kind},
    )
    inside = (
        Window.partitionBy(RANGE)
        .orderBy(*[o.sort for o in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = (
        ranged.withColumn(after, F.sum(amount).over(inside))
        .join(F.broadcast(offsets), RANGE)  # bounded by the number of ranges
        .withColumn(after, F.col(after) + F.col("__offset"))
        .withColumn(before, F.col(after) - amount)
        .drop(RANGE, "__offset")
    )
    lows = [r.low for r in totals]
    return RunningTotals(rows, ends, min(lows) if lows else None, any(r.zero for r in totals), kind)


def prefix_sum(
    df: DataFrame,
    value: str,
    order_by: str | Order | Sequence[str | Order],
    inclusive: bool = True,
    out: str = "prefix",
    ranges: int | None = None,
) -> DataFrame:
    """Running sum up to the current row, or up to the row before it (0 for the first row)."""
    kept, dropped = (out, "__other") if inclusive else ("__other", out)
    result = running_totals(df, value, order_by, before=dropped, after=kept, ranges=ranges)
    return result.rows.drop("__other")


def rank_global(
    df: DataFrame, order_by: str | Order | Sequence[str | Order], out: str = "row_id", ranges: int | None = None
) -> DataFrame:
    """ROW_NUMBER over the whole input; add a unique last order column for a stable result."""
    result = running_totals(df, F.lit(1).cast("bigint"), order_by, before="__other", after=out, ranges=ranges)
    return result.rows.drop("__other")


def with_row_id(df: DataFrame, order_by: str | Order | Sequence[str | Order], out: str = "row_id") -> DataFrame:
    """Surrogate numbers 1..n in the stated order (identity columns in the reference)."""
    return rank_global(df, order_by, out)
