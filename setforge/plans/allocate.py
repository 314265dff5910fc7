"""Ordered consumers drain ordered containers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setforge.operators.ordered import count_cuts, cut_table, running_totals
from setforge.session import cut_lineage

PART, POS = "__part", "__pos"


@dataclass(frozen=True)
class Line:
    """The line of running totals, cut into parts (cut[k-1], cut[k]]."""

    cuts: list
    kind: str

    def part_of(self, position: Column) -> Column:
        return count_cuts(position, self.cuts, False, self.kind)

    def parts(self, start: Column, end: Column) -> Column:
        """Every part a span (start, end] touches."""
        return F.sequence(count_cuts(start, self.cuts, True, self.kind), self.part_of(end))

    def end_in(self, part: Column, end: Column) -> Column:
        """Where a span stops inside a part: at its own end or at the part's."""
        return F.least(end, F.get(cut_table(self.cuts, self.kind), part))


def overlaps(left: DataFrame, right: DataFrame, left_span: tuple, right_span: tuple, line: Line) -> DataFrame:
    """Join two sets of spans (start, end] by overlap; spans on one side must not overlap each other.

    Instead of a theta join, both sides are laid on one line that is cut into parts. A span
    crossing a cut is copied into each part it touches (at most one span per side crosses a
    cut). Inside a part one sorted pass pairs every span end with the span of the other side
    that covers it, so the work is the sort, never the product of the two sides.
    """
    (ls, le), (rs, re) = left_span, right_span

    def events(df: DataFrame, start: str, end: str, own: str) -> DataFrame:
        row = F.struct(*[F.col(c) for c in df.columns])
        laid = df.select(F.explode(line.parts(F.col(start), F.col(end))).alias(PART), F.col(end).alias("__end"), row.alias(own))
        return laid.select(PART, line.end_in(F.col(PART), F.col("__end")).alias(POS), own)

    both = events(left, ls, le, "__l").unionByName(events(right, rs, re, "__r"), allowMissingColumns=True)
    # walking from high to low, the last span seen is the one that covers the position
    seen = Window.partitionBy(PART).orderBy(F.col(POS).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    covered = both.select(
        PART,
        POS,
        F.col("__l").isNotNull().alias("__from_left"),
        F.last("__l", ignorenulls=True).over(seen).alias("__l"),
        F.last("__r", ignorenulls=True).over(seen).alias("__r"),
    )
    # only a real span end makes a row, not a copy that stops at a cut; a shared end counts once
    left_end, right_end = F.col(f"__l.{le}") == F.col(POS), F.col(f"__r.{re}") == F.col(POS)
    meets = (F.col("__from_left") & left_end) | (~F.col("__from_left") & right_end & ~left_end)
    return covered.filter(F.col("__l").isNotNull() & F.col("__r").isNotNull() & meets).select("__l.*", "__r.*")


def stab(points: DataFrame, spans: DataFrame, point: str, span: tuple, line: Line) -> DataFrame:
    """Attach to each point the span (start, end] holding it. Many rows may share one point."""
    start, end = span
    places = points.select(F.col(point).alias(POS)).distinct()
    mark = places.select(line.part_of(F.col(POS)).alias(PART), POS, F.lit(True).alias("__mark"))
    row = F.struct(*[F.col(c) for c in spans.columns]).alias("__s")
    laid = spans.select(F.explode(line.parts(F.col(start), F.col(end))).alias(PART), F.col(end).alias("__end"), row)
    laid = laid.select(PART, line.end_in(F.col(PART), F.col("__end")).alias(POS), "__s")
    seen = Window.partitionBy(PART).orderBy(F.col(POS).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        mark.unionByName(laid, allowMissingColumns=True)
        .select(POS, "__mark", F.last("__s", ignorenulls=True).over(seen).alias("__s"))
        .filter(F.col("__mark") & F.col("__s").isNotNull() & (F.col(f"__s.{start}") < F.col(POS)))
        .select(POS, "__s.*")
    )
    return points.join(found, points[point] == found[POS]).drop(POS)


def allocate(
    supply: DataFrame,
    demand: DataFrame,
    supply_key: str = "boxid",
    demand_key: str = "pid",
    qty: str = "qty",
    ranges: int | None = None,
) -> DataFrame:
    """Who takes how much from which container: one row per meeting, in no particular order.

    Columns: supply key, demand key, ``b_bef b_aft p_bef p_aft get pqty bqty``. A row with
    quantity 0 shows up with ``get`` 0 where it falls inside the other side's span. Demand
    beyond the total supply gives no row. Keys must be unique, quantities not negative.
    """
    s = running_totals(
        supply.select(supply_key, F.col(qty).alias("bqty")), "bqty", supply_key, "b_bef", "b_aft", ranges
    )
    d = running_totals(
        demand.select(demand_key, F.col(qty).alias("pqty")), "pqty", demand_key, "p_bef", "p_aft", ranges
    )
    for side in (s, d):
        if side.minimum is not None and side.minimum < 0:
            raise ValueError(f"negative quantity: {side.minimum}")
    # range ends of both sides: no part holds more rows of a side than one range of that side
    line = Line(sorted(set(s.range_ends) | set(d.range_ends)), s.kind if s.kind == d.kind else "decimal(38,6)")
    b, p = ("b_bef", "b_aft"), ("p_bef", "p_aft")

    def filled(rows: DataFrame, span: tuple) -> DataFrame:
        return rows.filter(F.col(span[0]) < F.col(span[1]))

    def empty(rows: DataFrame, span: tuple) -> DataFrame:
        return rows.filter((F.col(span[0]) == F.col(span[1])) & (F.col(span[1]) > 0))

    supplied, asked = s.rows, d.rows
    if s.has_zero or d.has_zero:
        # both sides are read several times below: sort and sum them once
        supplied, asked = cut_lineage(supplied), cut_lineage(asked)
    met = overlaps(filled(supplied, b), filled(asked, p), b, p, line)
    if s.has_zero:
        met = met.unionByName(stab(empty(supplied, b), filled(asked, p), "b_aft", p, line))
    if d.has_zero:
        met = met.unionByName(stab(empty(asked, p), filled(supplied, b), "p_aft", b, line))
    taken = F.least("p_aft", "b_aft") - F.greatest("p_bef", "b_bef")
    return met.select(
        supply_key, demand_key, "b_bef", "b_aft", "p_bef", "p_aft", taken.alias("get"), "pqty", "bqty"
    )
