"""Overlap join of spans that may overlap each other on either side, as equi joins on dyadic nodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

#: A node with this share of all points or more is dealt to as many tasks as it holds shares; there are no more such nodes.
HOT_NODES = 1_000


def _position(df: DataFrame, column: str) -> Column:
    """Days of a date, whole numbers as they are."""
    return F.unix_date(column).cast("long") if isinstance(df.schema[column].dataType, DateType) else F.col(column).cast("long")


def _levels(length: int) -> list[int]:
    return list(range(max(1, length).bit_length()))


def cover(start: Column, end: Column, levels: Sequence[int]) -> Column:
    """The nodes (level, node) of the whole numbers from ``start`` to ``end``, at most two of each level.

    Node n of level l stands for the numbers from n * 2^l up to the next node. The nodes are disjoint, so every
    number of the span lies in exactly one of them.
    """
    nodes = []
    for level in levels:
        low, high = -F.shiftright(-start, level), F.shiftright(end + 1, level)
        inside = low < high
        for taken, node in ((low.bitwiseAND(F.lit(1).cast("long")) == 1, low), (high.bitwiseAND(F.lit(1).cast("long")) == 1, high - 1)):
            nodes.append(F.when(inside & taken, F.struct(F.lit(level).alias("level"), node.alias("node"))))
    return F.filter(F.array(*nodes), lambda n: n.isNotNull())


def _points_in_spans(points: DataFrame, spans: DataFrame, keys: Sequence[str], levels: Sequence[int]) -> DataFrame:
    """(p, s) for every point (keys, at, p) in a span (keys, start, end, s) of its keys.

    A point lies in one node of each level and meets a span in the one node of its cover that holds it, so each
    pair comes out once and nothing but pairs. Hot nodes are split: their points are dealt over shares,
    their spans go to all shares.
    """
    names = [*keys, "level", "node"]
    up = F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright("at", level).alias("node")) for level in levels])
    p = points.select(*keys, "p", F.explode(up).alias("n")).select(*keys, "n.*", "p")
    s = spans.select(*keys, "s", F.explode(cover(F.col("start"), F.col("end"), levels)).alias("n")).select(*keys, "n.*", "s")
    total = points.count() * len(levels)
    hot = p.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") * HOT_NODES >= max(total, HOT_NODES))
    shares = F.broadcast(hot.select(*names, F.ceil(F.col("__rows") * HOT_NODES / max(total, 1)).cast("int").alias("__shares")))
    dealt = F.coalesce("__shares", F.lit(1))
    p = p.join(shares, names, "left").withColumn("__share", F.pmod(F.xxhash64("p"), dealt).cast("int")).drop("__shares")
    s = s.join(shares, names, "left").withColumn("__share", F.explode(F.sequence(F.lit(0), dealt - 1))).drop("__shares")
    return p.join(s, [*names, "__share"]).select("p", "s")


def interval_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str], a_span: tuple[str, str], b_span: tuple[str, str]) -> DataFrame:
    """(a, b) structs of all rows of equal keys whose spans share a day or a whole number, ends included.

    Spans of one side may overlap each other and repeat. Of two that overlap, one starts inside the other: either a
    starts in b, or b starts in a later than a does, so each pair is found once. A span without a start, an end
    or a length overlaps nothing, nor does a NULL key.
    """

    def ready(df: DataFrame, span: tuple[str, str]) -> DataFrame:
        rows = df.select(*keys, _position(df, span[0]).alias("start"), _position(df, span[1]).alias("end"), F.struct(*df.columns).alias("row"))
        return rows.where("start <= end")

    ours, theirs = ready(a, a_span), ready(b, b_span)
    length = (F.col("end") - F.col("start") + 1).alias("n")
    longest = ours.select(length).union(theirs.select(length)).agg(F.max("n")).first()[0]
    levels = _levels(longest or 1)

    def points(df: DataFrame) -> DataFrame:
        return df.select(*keys, F.col("start").alias("at"), F.col("row").alias("p"))

    first = _points_in_spans(points(ours), theirs.withColumnRenamed("row", "s"), keys, levels)
    later = ours.withColumn("start", F.col("start") + 1).withColumnRenamed("row", "s")
    second = _points_in_spans(points(theirs), later, keys, levels)
    return first.select(F.col("p").alias("a"), F.col("s").alias("b")).unionByName(second.select(F.col("s").alias("a"), F.col("p").alias("b")))
