"""Compare pairs of XML documents by element and attribute."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setforge.session import cut_lineage
from setforge.sources.xml_nodes import xml_nodes

DOC, SIDE = "doc_id", "side"


def _classes(nodes: DataFrame) -> DataFrame:
    """Give every node a class: same name, attributes, child count and set of child classes.

    Built from the deepest level up. The set of child classes enters as two xor sums over the
    distinct classes, so children combine map-side and no child list is collected.
    """
    deepest = nodes.agg(F.max("depth")).first()[0]
    signature = F.md5(F.to_json(F.struct("name", "attrs", "kids")))
    signed = nodes.select(DOC, SIDE, "node", "parent", "depth", "kids", signature.alias("sig"))
    levels: list[DataFrame] = []
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        level = signed.filter(F.col("depth") == depth)
        if not levels:
            levels.append(cut_lineage(level.withColumn("class", F.col("sig")).withColumn("loose", F.lit(False))))
            continue
        below = levels[-1].groupBy(DOC, SIDE, F.col("parent").alias("node"), "class").agg(F.max("loose").alias("loose"))
        sets = below.groupBy(DOC, SIDE, "node").agg(
            F.bit_xor(F.xxhash64("class")).alias("x1"),
            F.bit_xor(F.xxhash64("class", F.lit(1))).alias("x2"),
            F.count(F.lit(1)).alias("kinds"),
            F.max("loose").alias("loose_below"),
        )
        joined = level.join(sets, [DOC, SIDE, "node"], "left")
        loose = F.coalesce(F.col("loose_below") | (F.col("kinds") < F.col("kids")), F.lit(False))
        name = F.when(F.col("kinds").isNull(), F.col("sig")).otherwise(F.md5(F.concat_ws("|", "sig", "x1", "x2", "kinds")))
        named = joined.withColumn("class", name).withColumn("loose", loose)
        levels.append(cut_lineage(named.select(*levels[0].columns)))
    return reduce(DataFrame.unionByName, levels)


def _unequal_matches(classed: DataFrame) -> DataFrame:
    """(doc, depth 0 left class, right class) that match though their classes differ.

    A node matches when name, attributes and child count agree and each left child has some
    matching right child. Unless the left node repeats a child class somewhere below, that
    forces equal classes, so only such "loose" nodes are searched. Candidates come from the
    left child with the fewest right parents; the other children are then checked.
    """
    deepest = classed.agg(F.max("depth")).first()[0] or 0
    left, right = classed.filter(F.col(SIDE) == 1), classed.filter(F.col(SIDE) == 2)

    def links(side: DataFrame, depth: int, only_loose: bool) -> DataFrame:
        top = side.filter((F.col("depth") == depth) & (F.col("kids") > 0))
        top = top.filter("loose") if only_loose else top
        child = side.filter(F.col("depth") == depth + 1).select(DOC, F.col("parent").alias("node"), F.col("class").alias("child"))
        return top.join(child, [DOC, "node"]).select(DOC, "class", "sig", "child").distinct()

    searched = {r.depth for r in left.filter("loose").select("depth").distinct().collect()}  # levels, not nodes
    nothing = classed.limit(0).select(DOC, F.col("class").alias("a"), F.col("class").alias("b"))
    matched = nothing
    for depth in range(deepest - 1, -1, -1):
        if depth not in searched:
            matched = nothing
            continue
        ours, theirs = links(left, depth, True), links(right, depth, False)
        same = ours.select(DOC, F.col("child").alias("a"), F.col("child").alias("b")).unionByName(matched).distinct()
        fits = same.withColumnRenamed("a", "child").withColumnRenamed("b", "other")
        parents = theirs.groupBy(DOC, "sig", F.col("child").alias("other")).agg(F.count(F.lit(1)).alias("n"))
        reach = (
            ours.join(fits, [DOC, "child"])
            .join(parents, [DOC, "sig", "other"], "left")
            .groupBy(DOC, "class", "sig", "child")
            .agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
        )
        anchor = reach.groupBy(DOC, "class", "sig").agg(F.min_by("child", "n").alias("child"), F.count(F.lit(1)).alias("kinds"))
        b_side = theirs.select(DOC, "sig", F.col("class").alias("b"), F.col("child").alias("other"))
        candidates = (
            anchor.join(fits, [DOC, "child"])
            .join(b_side, [DOC, "sig", "other"])
            .filter(F.col("class") != F.col("b"))
            .select(DOC, "class", "sig", "b", "kinds")
            .distinct()
        )
        held = (
            candidates.join(ours, [DOC, "class", "sig"])
            .join(fits, [DOC, "child"])
            .join(b_side, [DOC, "sig", "b", "other"], "left_semi")
            .groupBy(DOC, "class", "b", "kinds")
            .agg(F.count_distinct("child").alias("held"))
            .filter(F.col("held") == F.col("kinds"))
        )
        matched = cut_lineage(held.select(DOC, F.col("class").alias("a"), "b"))
    return matched


def _changed_names(nodes: DataFrame, mode: str) -> DataFrame:
    """(doc_id, changed): attribute names whose values differ at a path both documents have.

    Paths below an element whose child count differs are left out, and in simple mode paths
    whose attribute count differs.
    """
    sums = nodes.groupBy(DOC, "path").agg(
        *[F.sum(F.when(F.col(SIDE) == s, F.col("kids"))).alias(f"k{s}") for s in (1, 2)],
        *[F.sum(F.when(F.col(SIDE) == s, F.size("attrs"))).alias(f"a{s}") for s in (1, 2)],
    )
    shared = sums.filter(F.col("k1").isNotNull() & F.col("k2").isNotNull())
    if mode == "simple":
        shared = shared.filter(F.col("a1") == F.col("a2"))
    uneven = sums.filter(~F.col("k1").eqNullSafe(F.col("k2"))).select(DOC, F.col("path").alias("above"))
    parts = F.split("path", "/")
    prefixes = F.transform(
        F.sequence(F.lit(2), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    above = F.when(F.size(parts) > 2, prefixes).otherwise(F.array().cast("array<string>"))
    cut = shared.select(DOC, "path", F.explode(above).alias("above")).join(uneven, [DOC, "above"], "left_semi")
    open_paths = shared.select(DOC, "path").join(cut.select(DOC, "path"), [DOC, "path"], "left_anti")
    values = nodes.select(DOC, SIDE, "path", F.explode("attrs").alias("t")).join(open_paths, [DOC, "path"], "left_semi")
    counts = values.groupBy(DOC, "path", F.col("t.name").alias("name"), F.col("t.value").alias("value")).agg(
        F.count_if(F.col(SIDE) == 1).alias("n1"), F.count_if(F.col(SIDE) == 2).alias("n2")
    )
    names = counts.filter(F.col("n1") != F.col("n2")).select(DOC, "name").distinct()
    return names.groupBy(DOC).agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("changed"))


def diff_attributes(pairs: DataFrame, mode: str = "simple") -> DataFrame:
    """``(pair_id, xml, xml2)`` → ``(pair_id, result, changed, error)``; result 0 means equal.

    Equal: same element name, same attributes, same number of children, and every child of the
    first document equals some child of the second; text is not compared. A missing document
    differs from everything, and so does one that does not parse; ``error`` then says why.
    ``changed`` lists differing attribute names in order.
    """
    if mode not in ("simple", "full"):
        raise ValueError(f"mode: {mode}")
    sides = [
        pairs.select(F.col("pair_id").cast("bigint").alias(DOC), F.lit(n).alias(SIDE), F.col(c).alias("xml"))
        for n, c in ((1, "xml"), (2, "xml2"))
    ]
    # every level is read by itself below
    shredded = cut_lineage(xml_nodes(sides[0].unionByName(sides[1])), "depth")
    errors = shredded.filter("depth IS NULL").groupBy(DOC).agg(F.min("name").alias("error"))
    nodes = shredded.filter("depth IS NOT NULL")
    if nodes.isEmpty():
        told = pairs.withColumn(DOC, F.col("pair_id").cast("bigint")).join(errors, DOC, "left")
        return told.select("pair_id", F.lit(1).alias("result"), F.lit("").alias("changed"), "error")
    classed = _classes(nodes)
    roots = classed.filter(F.col("depth") == 0)
    ends = (
        roots.filter(F.col(SIDE) == 1).select(DOC, F.col("class").alias("a"))
        .join(roots.filter(F.col(SIDE) == 2).select(DOC, F.col("class").alias("b")), DOC)
    )
    alike = ends.filter(F.col("a") == F.col("b")).select(DOC)
    # pairs already found equal need no further search
    open_pairs = classed.join(alike, DOC, "left_anti")
    loosely = ends.join(_unequal_matches(open_pairs), [DOC, "a", "b"], "left_semi").select(DOC)
    equal = alike.unionByName(loosely).withColumn("equal", F.lit(True))
    changed = _changed_names(nodes.join(alike, DOC, "left_anti"), mode)
    return (
        pairs.withColumn(DOC, F.col("pair_id").cast("bigint"))
        .join(equal, DOC, "left")
        .join(changed, DOC, "left")
        .join(errors, DOC, "left")
        .select(
            "pair_id",
            F.when(F.col("equal"), 0).otherwise(1).alias("result"),
            F.coalesce("changed", F.lit("")).alias("changed"),
            "error",
        )
    )
