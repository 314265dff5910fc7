"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

A document of a source expects ``target / source_size`` copies. Within its source the expected copies are
summed up in a fixed order, a drawn offset is added, and a copy goes out for every whole number that a
document's stretch crosses. As the order is by size, what a source takes differs from its target by about
the largest document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, small, stage, table, word_count


def sources_with_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size, target) from per-source sizes.

    Sources ascend by code point, null last, and take the weights in turn. A target is weight times one
    common level, but ``most`` times the source's size at most; the level makes the targets share all
    sizes. Sources that stop at their cap are those of the smallest cap per weight, so running sums over that
    order give the level at once. One row per source is all that these windows see.
    """
    place = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    named = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    named = named.withColumn("level", left / F.sum("weight").over(after))
    # the first source whose cap is not reached sets the level of all that follow
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    named = named.withColumn("level", F.first(free, ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.coalesce(F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return named.select("source", "source_size", target.alias("target"))


def offset(seed: int) -> Column:
    """A number in [0, 1) drawn for a source by a hash."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))))
    return F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_copies(docs: DataFrame, size: Column, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 0) -> DataFrame:
    """Rows of ``docs`` (doc_id, source) with source_size, target, copies; ``size`` gives a row's size (long, 0 or more).

    Null sources are one source, the last. Rows of size 0 take copies like others, which weigh nothing. In an
    empty table, and where all sizes are 0, nothing is taken. Rows that share a doc_id are documents of their
    own. Columns of ``docs`` named like a new one (size, source_size, target, copies, and the helpers range, row, tie, part, named, base, offset) are dropped.

    A hot source is split: rows are dealt by ranges of (source, size, doc_id, row hash), numbered as they are written,
    and ranges add the rows of their source in the ranges before. Rows are moved once.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "range", "row", "tie", "part", "named", "base", "offset")]
    # rows that agree in source, size and doc_id are alike to the mix, so their order does not matter
    order = [F.asc_nulls_last("source"), F.col("size"), F.asc_nulls_first("doc_id"), F.col("tie")]
    rows = docs.select(*own).withColumn("size", size.cast("long")).withColumn("tie", F.xxhash64(*[c for c in own if c in ("doc_id", "text", "source")]))
    ranged = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    # ids count the rows of a range in their order, in which a source's rows are next to each other
    ranged = stage(ranged.withColumn("range", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()).drop("tie"))
    per_range = stage(ranged.groupBy("range", "source").agg(F.count("*").alias("rows"), F.sum("size").alias("sizes"), F.min("row").alias("first")))
    totals = per_range.groupBy("source").agg(F.sum("sizes").alias("source_size"))
    targets = sources_with_targets(totals, weights, most).withColumn("offset", offset(seed)).withColumnRenamed("source", "named")
    # one row per range and source: a source's ranges are few
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_range.select("range", "source", (F.coalesce(F.sum("rows").over(before), F.lit(0)) + 1 - F.col("first")).alias("base"))
    rates = bases.join(targets, F.col("source").eqNullSafe(F.col("named"))).drop("source").withColumnRenamed("range", "part")
    joined = ranged.join(small(stage(rates)), (F.col("range") == F.col("part")) & F.col("source").eqNullSafe(F.col("named")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("base") + F.col("row")
    crossed = F.floor(F.col("offset") + at * rate) - F.floor(F.col("offset") + (at - 1) * rate)
    return joined.withColumn("copies", crossed.cast("long")).select(*own, "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every document as often as the mix takes it, by words; all columns kept."""
    rows = docs.select("doc_id", "source", F.expr(word_count("text")).alias("words"), F.xxhash64("text").alias("text"), F.struct(*docs.columns).alias("document"))
    rows = with_copies(rows, F.col("words"), **settings)
    return rows.withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("document.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by their words, weights 1, 2, 3 in turn, three copies at most."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.expr(word_count("text")).cast("long").alias("words"))
    return with_copies(docs, F.col("words")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM d GROUP BY source
), c AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c
), f AS (
  SELECT min(k) AS first_free FROM l WHERE level * weight <= cap
), t AS (
  SELECT source, source_size,
    CASE WHEN k >= first_free THEN least((SELECT level FROM l x WHERE x.k = first_free) * weight, CAST(cap AS DOUBLE)) ELSE CAST(cap AS DOUBLE) END AS target,
    CAST(('0x' || substr(md5('0:' || coalesce('s' || source, 'n')), 1, 8)) AS BIGINT) / 4294967296.0 AS u
  FROM l, f
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * CAST(floor(u + pos * rate) - floor(u + (pos - 1) * rate) AS BIGINT) AS taken FROM r
"""
