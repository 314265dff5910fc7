"""Rule rows with empty key columns, rule levels, priorities, include and exclude rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setforge.session import cut_lineage


def has_flag(column: str | Column, mask: int) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.bitwiseAND(F.lit(mask)) == F.lit(mask)


def lacks_flag(column: str | Column, mask: int) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.bitwiseAND(F.lit(mask)) == F.lit(0)


def rule_level(
    product: str = "ProductID", brand: str = "BrandID", category: str = "CategoryID", group: str = "MGID"
) -> Column:
    """Which analytics a rule row names. NULL for combinations the price run has no branch for."""
    p, b, c, g = (F.col(x).isNotNull() for x in (product, brand, category, group))
    return (
        F.when(p, "product")
        .when(c & ~b & ~g, "category")
        .when(c & b & ~g, "brand_category")
        .when(b & ~c & ~g, "brand")
        .when(g & ~b & ~c, "group")
    )


def rule_mask(soft: Sequence[str]) -> Column:
    """Which soft columns a rule fills, one bit each."""
    return sum((F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(soft)), F.lit(0))


def _per_mask(items: DataFrame, masks: DataFrame, keys: Sequence[str], soft: Sequence[str]) -> DataFrame:
    """``items`` once per mask that the rules of their keys use, ``soft`` blanked where the mask has no bit.

    ``masks``: keys and __mask of all rules. An item without a value that a mask asks for has no row for it.
    """
    if keys:
        used = masks.groupBy(*keys).agg(F.collect_set("__mask").alias("__masks"))  # 2^k small numbers at most
        rows = items.join(used, list(keys)).withColumn("__mask", F.explode("__masks")).drop("__masks")
    else:
        rows = items.withColumn("__mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(soft)) - 1))))
    for i, c in enumerate(soft):
        asked = F.col("__mask").bitwiseAND(F.lit(1 << i)) != 0
        rows = rows.filter(~asked | F.col(c).isNotNull()).withColumn(c, F.when(asked, F.col(c)))
    return rows


def _same(keys: Sequence[str], soft: Sequence[str]) -> Column:
    """Equal keys and masks, soft values equal or blank on both sides; ``i`` are items, ``r`` rules."""
    tests = [F.col(f"i.{c}") == F.col(f"r.{c}") for c in [*keys, "__mask"]]
    return reduce(lambda a, b: a & b, tests + [F.col(f"i.{c}").eqNullSafe(F.col(f"r.{c}")) for c in soft])


#: Rules of a mask that are broadcast at most; rules of more rows meet the rows by key.
FEW_RULES = 200_000


def _named_by(rows: DataFrame, rules: DataFrame, masks: Sequence[int], hard: Sequence[str], soft: Sequence[str]) -> DataFrame:
    """``rows`` with __hit: whether a rule of one of ``masks`` names them; the rules are broadcast, the rows stay where they are."""
    hits = F.lit(False)
    for m in masks:
        keys = [*hard, *[c for i, c in enumerate(soft) if m >> i & 1]]
        if not keys:  # a rule without any key names every row
            return rows.withColumn("__hit", F.lit(True))
        theirs = rules.where(F.col("__mask") == m).select(*[F.col(c).alias(f"__r_{c}") for c in keys], F.lit(True).alias(f"__hit{m}"))
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__r_{c}") for c in keys])
        rows = rows.join(F.broadcast(theirs), same, "left").drop(*[f"__r_{c}" for c in keys])
        hits = hits | F.coalesce(f"__hit{m}", F.lit(False))
    return rows.withColumn("__hit", hits).drop(*[f"__hit{m}" for m in masks])


def wildcard_semi(rows: DataFrame, rules: DataFrame, hard: Sequence[str], soft: Sequence[str]) -> DataFrame:
    """Rows that at least one rule names, where a NULL soft column of a rule names every value.

    Rules are distinct per mask of their filled columns, and those of masks with few rules, as the wider ones mostly are,
    are broadcast: a row, or a narrower rule, that they name needs no other rule. What is left of the rows is repeated
    for the masks that the rules left of their hard key use, and meets these rules in one equi semi join on key, mask and
    masked values, so no rule matches by a residual test over a whole hard-key group. A row that rules of several masks
    name may come out once per mask; follow with an aggregate or distinct.
    """
    named = cut_lineage(rules.select(*hard, *soft).withColumn("__mask", rule_mask(soft)).distinct())
    counts = {r["__mask"]: r["count"] for r in named.groupBy("__mask").count().collect()}  # 2^k rows at most
    few = sorted(m for m, n in counts.items() if n <= FEW_RULES)
    flagged = _named_by(rows, named, few, hard, soft)
    if len(few) == len(counts):
        return flagged.where("__hit").drop("__hit")
    left = _named_by(named.where(~F.col("__mask").isin(few)), named, few, hard, soft).where("NOT __hit").drop("__hit")
    left = cut_lineage(left) if few else left
    if few and left.isEmpty():
        return flagged.where("__hit").drop("__hit")
    flagged = cut_lineage(flagged) if few else flagged
    own = F.struct(*rows.columns).alias("__row")
    asking = flagged.where("NOT __hit").select(*dict.fromkeys([*hard, *soft]), own)
    asking = _per_mask(asking, left.select(*hard, "__mask"), hard, soft)
    met = asking.alias("i").join(left.alias("r"), _same(hard, soft), "left_semi").select("__row.*")
    return flagged.where("__hit").drop("__hit").unionByName(met) if few else met


def pick_by_priority(
    df: DataFrame, keys: Sequence[str], priority: str, keep: Column | None = None
) -> DataFrame:
    """The row with the highest priority per key, kept only if ``keep`` holds for it.

    The test comes after the choice: a later row that fails it hides the earlier ones.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(priority)).alias("__row"))
    best = best.select(*keys, "__row.*").select(*df.columns)
    return best if keep is None else best.filter(keep)


def join_any(
    left: DataFrame,
    right: DataFrame,
    arms: Sequence[tuple[Sequence[str], Column | None]],
    left_out: Sequence[str],
    right_out: Sequence[str],
) -> DataFrame:
    """Distinct (left_out, right_out) of rows that agree on any of several key lists.

    Each arm is (key columns of both sides, test of right rows or None). The OR becomes a union of equi
    joins of distinct rows, each of which carries its own arm's columns only.
    """
    parts = []
    for keys, test in arms:
        ours = left.select(*dict.fromkeys([*left_out, *keys])).distinct()
        theirs = (right if test is None else right.filter(test)).select(*dict.fromkeys([*right_out, *keys])).distinct()
        parts.append(ours.join(theirs, list(keys)).select(*left_out, *right_out))
    return reduce(DataFrame.unionByName, parts).distinct()


def null_or_equal(rule: str, value: str) -> Column:
    return F.col(rule).isNull() | (F.col(rule) == F.col(value))


def match_rules(
    items: DataFrame, rules: DataFrame, keys: Sequence[str], soft: Sequence[str], rule_out: Sequence[str], item_out: Sequence[str]
) -> DataFrame:
    """(rule_out, item_out) of every rule with every item it names, where a NULL soft column names every value.

    The same as an equi join on ``keys`` with ``null_or_equal`` on every soft column. Items are repeated for the
    masks of filled columns that the rules of their key use and joined once, on key, mask and masked values: an item meets
    only rules that name it, and neither side is planned more than once.
    """
    extra = [c for c in item_out if c not in rule_out]
    named = rules.select(*dict.fromkeys([*rule_out, *keys, *soft])).withColumn("__mask", rule_mask(soft))
    ours = items.select(*dict.fromkeys([*keys, *soft]), F.struct(*extra, F.lit(0)).alias("__item"))
    asking = _per_mask(ours, named.select(*keys, "__mask"), keys, soft)
    joined = asking.alias("i").join(named.alias("r"), _same(keys, soft))
    return joined.select(*[F.col(f"r.{c}").alias(c) for c in rule_out], *[F.col(f"i.__item.{c}").alias(c) for c in extra])


def apply_rules(
    items: DataFrame,
    include: DataFrame,
    exclude: DataFrame,
    keys: Sequence[str],
    owner: Sequence[str],
    item: str,
    soft: Sequence[str],
    mode: str = "any",
) -> DataFrame:
    """Items that an include rule names and the exclude rules of the same owner do not.

    ``items`` hold ``keys``, ``item`` and the ``soft`` attributes; both rule tables hold
    ``owner``, ``keys`` and the ``soft`` columns, where NULL names every value. Mode "any"
    drops an item as soon as one exclude rule names it. Mode "reference" drops it only when
    every exclude rule of the owner and key names it, as the join form with IS NULL does.
    """
    if mode not in ("any", "reference"):
        raise ValueError(f"mode: {mode}")

    scope = [*owner, *keys]
    both = reduce(DataFrame.union, [rules.select(*scope, *soft).distinct().withColumn("__out", F.lit(out)) for rules, out in ((include, False), (exclude, True))])
    named = match_rules(items, both, keys, soft, [*scope, "__out"], [item])
    met = named.groupBy(*scope, item).agg(F.bool_or(~F.col("__out")).alias("__in"), F.count_if("__out").alias("__hits")).filter("__in")
    if mode == "any":
        return met.filter("__hits = 0").select(*scope, item)
    rules = exclude.select(*scope, *soft).distinct().groupBy(*scope).agg(F.count(F.lit(1)).alias("__rules"))
    return met.join(rules, scope, "left").filter((F.col("__hits") == 0) | (F.col("__hits") != F.col("__rules"))).select(*scope, item)
