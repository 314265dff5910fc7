"""Which price lists, products and discount settings take part on a date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setforge.functions.scalars import end_to_zero
from setforge.operators.hierarchy import flatten_levels
from setforge.operators.rules import apply_rules, join_any, lacks_flag, rule_level
from setforge.operators.temporal import active_on, latest_as_of, opt_eq, started

PAIR = ["PricePolID", "ProductID"]


def actual_bindings(bindings: DataFrame, date: Column, price_list: int | None = None) -> DataFrame:
    """Latest formula per (product, price list); ``IsNow`` marks one that starts on the date."""
    ordinary = opt_eq(bindings.filter(F.col("FormulaType") == 0), "PolType", price_list)
    latest = latest_as_of(ordinary, ["ProductID", "PolType"], "Data", date)
    return latest.select("ProductID", "PolType", "PLFormula", (F.col("Data") == date).cast("int").alias("IsNow"))


def active_settings(
    settings: DataFrame, price_lists: DataFrame, date: Column, price_list: int | None = None
) -> DataFrame:
    """Settings in force on the date, or that ended the day before (``IsDiscountEnd`` = 1)."""
    live = active_on(opt_eq(settings, "PricePolID", price_list), date, "DateBegin", "DateEnd", grace_days=1)
    lists = started(price_lists, "NTLStartDate", date).select("PricePolID")
    ended = (F.date_add("DateEnd", 1) == date).cast("int")
    return live.join(lists, "PricePolID").select(
        "DSettingID", "PricePolID", "ProductID", "BrandID", "CategoryID", "MGID", ended.alias("IsDiscountEnd")
    )


def leveled_settings(active: DataFrame) -> DataFrame:
    """Settings with their rule level; an ended setting goes on under id 0."""
    effective = end_to_zero(F.col("DSettingID"), F.col("IsDiscountEnd") == 1)
    return active.withColumn("DSettingID", effective).withColumn("level", rule_level())


def category_leaves(categories: DataFrame, used: DataFrame) -> DataFrame:
    """(CategoryID, ParentCategoryID) from levels 2, 3 and 4 to level 4, for categories in use."""
    flat = flatten_levels(
        categories, "CategoryID", "ParentID", "Level", [2, 3, 4], F.col("State") == 1, ("CategoryID", "ParentCategoryID")
    )
    wanted = used.filter(F.col("CategoryID").isNotNull()).select(F.col("CategoryID").alias("ParentCategoryID"))
    return flat.join(wanted, "ParentCategoryID", "left_semi").select("CategoryID", "ParentCategoryID")


def brand_leaves(brands: DataFrame, used: DataFrame) -> DataFrame:
    """(BrandID, ParentBrandID) from levels 1 and 2 to level 2, for brands in use."""
    flat = flatten_levels(
        brands, "BrandID", "ParentID", "Level", [1, 2], F.col("State") == 1, ("BrandID", "ParentBrandID")
    )
    wanted = used.filter(F.col("BrandID").isNotNull()).select(F.col("BrandID").alias("ParentBrandID"))
    return flat.join(wanted, "ParentBrandID", "left_semi").select("BrandID", "ParentBrandID")


def market_group_rules(group_settings: DataFrame, active: DataFrame, date: Column) -> DataFrame:
    used = active.filter(F.col("MGID").isNotNull()).select("MGID")
    live = active_on(group_settings, date, "DateStart", "DateEnd", null_end="open")
    return live.join(used, "MGID", "left_semi").select("MGID", "MGPID", "BrandID", "CategoryID", "RowType")


def group_products(
    rules: DataFrame, groups: DataFrame, brands: DataFrame, categories: DataFrame, unsecured: DataFrame, products: DataFrame
) -> DataFrame:
    """(MGPID, ProductID): by the product's own group, else by brand, else by category.

    The category way counts only for groups that no brand belongs to.
    """
    live = (
        groups.filter(F.col("Status") == 1).join(rules.select("MGPID"), "MGPID", "left_semi").select("MGPID").distinct()
    )
    by_brand = live.join(brands.select("MGPID", "BrandID"), "MGPID")
    branded = by_brand.select("MGPID").distinct()
    by_category = (
        live.join(branded, "MGPID", "left_anti")
        .join(categories.select("MGPID", "CategoryID"), "MGPID")
        .join(unsecured.select("CategoryID", "UnsecuredProductID"), "CategoryID")
    )
    ways = (
        live.withColumn("own", F.col("MGPID"))
        .unionByName(by_brand.select("MGPID", "BrandID"), allowMissingColumns=True)
        .unionByName(by_category.select("MGPID", "UnsecuredProductID"), allowMissingColumns=True)
    )
    items = products.select("ProductID", F.col("ExceptionMGPID").alias("own"), "BrandID", "UnsecuredProductID")
    free = F.col("own").isNull()
    arms = [(["own"], None), (["BrandID"], free), (["UnsecuredProductID"], free)]
    return join_any(ways, items, arms, ["MGPID"], ["ProductID"])


def market_group_products(
    rules: DataFrame, members: DataFrame, products: DataFrame, unsecured: DataFrame, mode: str = "any"
) -> DataFrame:
    """(MGID, ProductID) after include (RowType 1) and exclude (RowType 2) rules."""
    items = (
        members.join(products.select("ProductID", "BrandID", "UnsecuredProductID"), "ProductID")
        .join(unsecured.select("UnsecuredProductID", "CategoryID"), "UnsecuredProductID")
        .select("MGPID", "ProductID", "BrandID", "CategoryID")
    )
    include, exclude = rules.filter(F.col("RowType") == 1), rules.filter(F.col("RowType") == 2)
    found = apply_rules(
        items, include, exclude, ["MGPID"], ["MGID"], "ProductID", ["BrandID", "CategoryID"], mode
    )
    return found.select("MGID", "ProductID").distinct()


def resolve_settings(active: DataFrame, t: dict[str, DataFrame], date: Column, mode: str = "any") -> DataFrame:
    """(PricePolID, ProductID, DSettingID) for every product an active setting reaches."""
    leveled = leveled_settings(active)
    out = ["PricePolID", "ProductID", "DSettingID"]

    def at(level: str) -> DataFrame:
        return leveled.filter(F.col("level") == level)

    categories, brands = category_leaves(t["categories"], active), brand_leaves(t["brands"], active)
    products = t["c_products"].select("ProductID", "BrandID", "UnsecuredProductID", "Tara", "State")
    placed = products.join(t["unsecured"].select("UnsecuredProductID", "CategoryID"), "UnsecuredProductID")
    sold = (F.col("Tara") == 0) & (F.col("State") == 1)  # asked for in the category and brand branches only

    def rule(level: str, *columns: str) -> DataFrame:
        return at(level).select("DSettingID", "PricePolID", *[F.col(c).alias(f"Parent{c}") for c in columns])

    by_category = (
        rule("category", "CategoryID").join(categories, "ParentCategoryID").join(placed.filter(sold), "CategoryID")
    )
    by_brand = rule("brand", "BrandID").join(brands, "ParentBrandID").join(products.filter(sold), "BrandID")
    by_both = (
        rule("brand_category", "BrandID", "CategoryID")
        .join(categories, "ParentCategoryID")
        .join(brands, "ParentBrandID")
        .join(placed, ["CategoryID", "BrandID"])
    )
    rules = market_group_rules(t["group_settings"], active, date)
    members = group_products(rules, t["market_groups"], t["brands"], t["categories"], t["unsecured"], t["c_products"])
    grouped = market_group_products(rules, members, t["c_products"], t["unsecured"], mode)
    by_group = at("group").select("DSettingID", "PricePolID", "MGID").join(grouped, "MGID")
    branches = [by_category, by_brand, at("product"), by_both, by_group]
    result = branches[0].select(*out)
    for b in branches[1:]:
        result = result.unionByName(b.select(*out))
    return result


def blocked_products(actual: DataFrame, block_formula: int) -> DataFrame:
    return actual.filter(F.col("PLFormula") == block_formula).select(
        F.col("PolType").alias("PricePolID"), "ProductID", F.col("IsNow").alias("BlockNow")
    )


def candidate_products(
    resolved: DataFrame,
    blocked: DataFrame,
    t: dict[str, DataFrame],
    date: Column,
    price_list: int | None = None,
    product: int | None = None,
    reuse: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """(PricePolID, ProductID, DSettingID, BlockNow): settings spread over analogs, newly blocked
    products, and archived products that no setting reaches (setting 0)."""
    lists = started(t["price_lists"], "NTLStartDate", date).select("PricePolID")
    analogs = t["analogs"].filter(F.col("Discont") == 0).select("ProductID", "AnalogID", "IsAnalog")
    items = t["products"].filter(
        lacks_flag("Status", 512) & (F.col("ID") == F.col("ProdID")) & (F.col("Tara") == 0)
    ).select(F.col("ID").alias("AnalogID"))
    spread = (
        resolved.distinct()
        .join(analogs, "ProductID")
        .select("PricePolID", "DSettingID", "AnalogID", "IsAnalog")
        .join(items, "AnalogID", "left_semi")
        .withColumnRenamed("AnalogID", "ProductID")
        .join(blocked, PAIR, "left")
        .filter(F.col("BlockNow").isNull() | ((F.col("BlockNow") == 1) & (F.col("IsAnalog") == 0)))
        .select(*PAIR, "DSettingID", F.coalesce("BlockNow", F.lit(0)).alias("BlockNow"))
    )
    now = blocked.filter(F.col("BlockNow") == 1).join(lists, "PricePolID", "left_semi")
    now = now.select(*PAIR, F.lit(0).cast("bigint").alias("DSettingID"), F.lit(1).alias("BlockNow"))
    # one row per key even where both branches name it
    known = reuse(spread.unionByName(now).groupBy(*PAIR, "DSettingID").agg(F.max("BlockNow").alias("BlockNow")))
    past = opt_eq(opt_eq(t["archive"].filter(F.col("Data") <= date), "PolType", price_list), "ProductID", product)
    # any archived row on or before the date will do: the latest one exists then as well
    rest = (
        past.filter(F.col("PriceType").isNotNull())
        .select(F.col("PolType").alias("PricePolID"), "ProductID")
        .distinct()
        .join(lists, "PricePolID", "left_semi")
        .join(known, PAIR, "left_anti")
        .join(blocked, PAIR, "left_anti")
        .select(*PAIR, F.lit(0).cast("bigint").alias("DSettingID"), F.lit(0).alias("BlockNow"))
    )
    return known.unionByName(rest)


def product_list(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy(*PAIR).agg(F.max("BlockNow").alias("BlockNow"))
