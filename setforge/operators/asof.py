"""As-of join with a date in every row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setforge.session import cut_lineage


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str, values: Sequence[str]) -> DataFrame:
    """Every row of ``left`` with ``values`` of the latest row of ``right`` of its keys at or before its date.

    Of right rows with the same keys and date the one with the greatest values, in their order, counts. Left rows
    before the first date, and those with a NULL key or date, get NULLs; repeated left rows stay.

    Both tables lie in one order of (keys, date), cut into ranges and written once, so a hot key is spread
    over many tasks. The last right row is carried along inside a range; into a range only its first
    key can come from before, so one row per range carries over.
    """
    spark = left.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, right_date]])
    ours = left.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], F.col(left_date).alias("__at"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__left"))
    theirs = right.where(known).select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], F.col(right_date).alias("__at"), F.lit(0).alias("__side"), F.struct(*values).alias("__right"))
    names = [f"__k{i}" for i in range(len(keys))]
    both = ours.unionByName(theirs, allowMissingColumns=True)
    # equal dates of one key may be cut too: right rows by their values, left rows by a hash
    order = [*names, "__at", "__side", "__right", F.xxhash64("__left")]
    ranged = cut_lineage(both.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()))
    key = F.struct(*names)
    inside = Window.partitionBy("__range", *names).orderBy("__at", "__side", "__right").rowsBetween(Window.unboundedPreceding, 0)

    bounds = cut_lineage(ranged.groupBy("__range").agg(F.min(key).alias("__first"), F.max(key).alias("__last")))
    ends = ranged.where("__side = 0").join(F.broadcast(bounds), "__range").where(key.eqNullSafe(F.col("__last")))
    ends = ends.groupBy("__range").agg(F.max_by("__right", F.struct("__at", "__right")).alias("__end"))
    # what a range asks for comes before what it hands on
    asked = bounds.select("__range", F.col("__first").alias("__key"), F.lit(0).alias("__turn"))
    handed = bounds.join(ends, "__range").select("__range", F.col("__last").alias("__key"), F.lit(1).alias("__turn"), "__end")
    along = Window.partitionBy("__key").orderBy("__range", "__turn").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.unionByName(handed, allowMissingColumns=True).withColumn("__carried", F.last("__end", ignorenulls=True).over(along))
    carried = carried.where("__turn = 0").select("__range", F.col("__key").alias("__first"), "__carried")

    found = ranged.withColumn("__found", F.last("__right", ignorenulls=True).over(inside)).where("__side = 1")
    joined = found.join(F.broadcast(carried), "__range")  # one row per range
    here = F.coalesce("__found", F.when(key.eqNullSafe(F.col("__first")), F.col("__carried")))
    return joined.withColumn("__found", here).select("__left.*", *[F.col(f"__found.{c}").alias(c) for c in values])
