"""Tax, base price and the price itself."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setforge.operators.rules import has_flag, lacks_flag
from setforge.operators.temporal import active_on, latest_as_of
from setforge.plans.pricing.scope import PAIR

# Statuses of calculated prices and the tax rates by product flag.
FORMULA_STATUS, BLOCK_STATUS, FIX_STATUS = 16, 20, 32
HIGH_TAX_FLAG, HIGH_TAX, LOW_TAX = 4, 18, 10
FINE_ROUNDING_FLAG = 256
NOT_OURS_FLAG = 512
BRANCH_PRICE_TYPE = 1

MONEY, ROUNDED, EXACT = "decimal(19,4)", "decimal(20,4)", "decimal(20,8)"


def tax_as_of(work: DataFrame, price_lists: DataFrame, statuses: DataFrame, date: Column) -> DataFrame:
    """(PricePolID, ProductID, NDS, NDSID): the list's tax, else by the product's latest status."""
    latest = latest_as_of(statuses, ["ProdID"], "Data", date).select(F.col("ProdID").alias("ProductID"), "Status")
    by_flag = F.when(has_flag("Status", HIGH_TAX_FLAG), HIGH_TAX).otherwise(LOW_TAX)
    lists = price_lists.select("PricePolID", "NDS", "NDSID")
    return (
        work.select(*PAIR)
        .join(lists, "PricePolID")
        .join(latest, "ProductID", "left")
        .select(*PAIR, F.coalesce("NDS", by_flag).alias("NDS"), F.coalesce("NDSID", by_flag).alias("NDSID"))
        .distinct()
    )


def exception_prices(work: DataFrame, products: DataFrame, exceptions: DataFrame, date: Column) -> DataFrame:
    """(PricePolID, ProductID, ExBasePrice): one active exception price for a pair.

    The product's own exception comes first, then those of its analog group; of several the lowest counts, so that a
    pair has one price whatever the settings say. Exceptions are lifted to (price list, group) first, so
    group members are never paired up.
    """
    live = active_on(exceptions.filter(F.col("RowState") == 1), date, "DateBegin", "DateEnd", null_end="sentinel")
    groups = products.select(F.col("ID").alias("ProductID"), "AGID", "Status")
    offered = live.join(groups.filter(lacks_flag("Status", NOT_OURS_FLAG) & F.col("AGID").isNotNull()), "ProductID")
    own = offered.groupBy(*PAIR).agg(F.min("BasePrice").alias("__own"))
    of_group = offered.groupBy("PricePolID", "AGID").agg(F.min("BasePrice").alias("__lowest"))
    asked = work.select(*PAIR).join(groups.select("ProductID", "AGID"), "ProductID")
    found = asked.join(of_group, ["PricePolID", "AGID"]).join(own, PAIR, "left")
    return found.select(*PAIR, F.coalesce("__own", "__lowest").alias("ExBasePrice")).distinct()


def base_price(
    work: DataFrame,
    price_lists: DataFrame,
    base_prices: DataFrame,
    chosen_layers: DataFrame,
    exceptions: DataFrame,
    date: Column,
    legal_entity: int,
    base_layer: int,
    reuse: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """(PricePolID, ProductID, BasePrice, FilialBasePrice, DiscountPercent).

    Branch price less the percent of the base layer if one is set, else the exception price,
    else the price of the list's own type. A product without a branch price drops out.
    """
    own = base_prices.filter(F.col("LegalEntityID") == legal_entity)
    latest = latest_as_of(own, ["ProductID", "BasePriceTypeID"], "DatePrice", date)
    latest = reuse(latest.select("ProductID", "BasePriceTypeID", "BasePrice"))
    branch = latest.filter(F.col("BasePriceTypeID") == BRANCH_PRICE_TYPE)
    branch = branch.select("ProductID", F.col("BasePrice").alias("FilialBasePrice"))
    typed = latest.withColumnRenamed("BasePrice", "ListBasePrice")
    base_discount = chosen_layers.filter(
        (F.col("DLayerID") == base_layer) & (F.col("DiscountPercent") != 0)
    ).select(*PAIR, "DiscountPercent")
    reduced = F.col("FilialBasePrice") * (F.lit(100) - F.col("DiscountPercent")) * F.expr("0.01BD")
    price = F.when(F.col("DiscountPercent").isNotNull(), reduced).otherwise(
        F.coalesce("ExBasePrice", "ListBasePrice")
    )
    return (
        work.select(*PAIR)
        .join(price_lists.select("PricePolID", "BasePriceTypeID"), "PricePolID")
        .join(branch, "ProductID")
        .join(typed, ["ProductID", "BasePriceTypeID"], "left")
        .join(base_discount, PAIR, "left")
        .join(exceptions, PAIR, "left")
        .select(*PAIR, price.alias("BasePrice"), "FilialBasePrice", "DiscountPercent")
        .distinct()
    )


def ready_rows(
    work: DataFrame, price_lists: DataFrame, tax: DataFrame, base: DataFrame, fixed: DataFrame, layers: DataFrame
) -> DataFrame:
    """All inputs of the price side by side; rows without tax or base price stay only when blocked."""
    tokens = [c for c in layers.columns if c not in PAIR]
    lists = price_lists.select("PricePolID", "CurrID", "BasePriceTypeID", F.col("Status").alias("PricePolStatus"))
    has_base = base.select(*PAIR, "BasePrice")
    fix = fixed.select(*PAIR, "FixPrice")
    wide = layers.withColumn("__layered", F.lit(True))
    blocked = F.col("IsBlock") == 1
    ended = F.when(F.col("FixPrice").isNotNull(), 0).when(F.col("__layered").isNull(), 1).otherwise(0)
    return (
        work.join(lists, "PricePolID")
        .join(tax, PAIR, "left")
        .join(has_base, PAIR, "left")
        .join(fix, PAIR, "left")
        .join(wide, PAIR, "left")
        .filter((F.col("NDS").isNotNull() | blocked) & (F.col("BasePrice").isNotNull() | blocked))
        .select(
            *PAIR, "NDS", "NDSID", "BasePrice", "CurrID", "BasePriceTypeID", "PricePolStatus", "FixPrice",
            ended.alias("IsDiscountEnd"), "IsBlock", *tokens,
        )
    )


@dataclass(frozen=True)
class FormulaPart:
    """One piece of the price formula: its own text and the factor of its layer group."""

    num: int
    part: str
    group: str


def check_formula(text: str, allowed: Iterable[str]) -> None:
    """Only arithmetic over known columns may reach the expression parser."""
    unknown = sorted(set(re.findall(r"[A-Za-z_]\w*", text)) - set(allowed))
    if unknown:
        raise ValueError(f"formula names unknown columns: {', '.join(unknown)}")
    if re.search(r"[^\w\s.()+\-*/]", text):
        raise ValueError("formula may hold only names, numbers, brackets and + - * /")


def fine_rounding(precision: int) -> Column:
    """Whether a price keeps 4 digits (foreign currency or list flag) instead of 2."""
    fine = F.lit(precision == 1) & has_flag("PricePolStatus", FINE_ROUNDING_FLAG)
    return F.coalesce((F.col("CurrID") > 0) | fine, F.lit(False))


def round_price(value: Column, precision: int) -> Column:
    return F.when(fine_rounding(precision), F.round(value, 4)).otherwise(F.round(value, 2))


@dataclass(frozen=True)
class Formula:
    price: Column
    after_base: Column
    after_promo: Column


def assemble_formula(parts: Sequence[FormulaPart], columns: Iterable[str], precision: int) -> Formula:
    """The price as an expression: parts 1 and 2, rounding, then the factors of the later parts."""
    ordered = sorted(parts, key=lambda p: p.num)
    by_num = {p.num: p for p in ordered}
    if 1 not in by_num:
        raise ValueError("the formula has no part 1")
    for p in ordered:
        check_formula(f"{p.part} {p.group}", columns)
    head = f"{by_num[1].part}*{by_num[1].group}"
    if 2 in by_num:
        head += f"*{by_num[2].group}"
    # a stated type after each rounding keeps decimal products clear of the 38-digit limit
    price = round_price(F.expr(head), precision).cast(ROUNDED)
    for p in ordered:
        if p.num > 2:
            price = price * F.expr(f"({p.group})")

    def own(num: int) -> Column:
        return F.expr(by_num[num].part) if num in by_num else F.lit(None)

    return Formula(price, own(2), own(3))


def formula_price(ready: DataFrame, parts: Sequence[FormulaPart], date: Column, precision: int) -> DataFrame:
    """New price rows: blocked 0, no setting left: base price, fixed price, else the formula."""
    known = [c for c in ready.columns if c not in PAIR]
    formula = assemble_formula(parts, known, precision)
    special = F.col("FixPrice").isNotNull() | (F.col("IsDiscountEnd") == 1) | (F.col("IsBlock") == 1)
    zero = F.lit(0).cast(MONEY)
    price = (
        F.when(F.col("IsBlock") == 1, zero)
        .when(F.col("IsDiscountEnd") == 1, F.col("BasePrice").cast(MONEY))
        .when(F.col("FixPrice").isNotNull(), F.col("FixPrice").cast(MONEY))
        .otherwise(round_price(formula.price, precision).cast(MONEY))
    )
    status = (
        F.when(F.col("IsBlock") == 1, BLOCK_STATUS).when(F.col("FixPrice").isNotNull(), FIX_STATUS).otherwise(FORMULA_STATUS)
    )
    return ready.withColumn("BasePrice", F.col("BasePrice").cast(EXACT)).select(
        "ProductID",
        date.alias("Data"),
        F.col("PricePolID").alias("PolType"),
        price.alias("Price"),
        "NDS",
        "CurrID",
        status.alias("Status"),
        "BasePriceTypeID",
        "NDSID",
        round_price(F.col("BasePrice"), precision).cast(MONEY).alias("BasePrice"),
        F.when(special, zero).otherwise(formula.after_base.cast(MONEY)).alias("Price1"),
        F.when(special, zero).otherwise(round_price(formula.after_promo, precision).cast(MONEY)).alias("Price2"),
    )


def missing_report(rows: DataFrame, column: str, products: DataFrame) -> DataFrame:
    """Names of products whose ``column`` (tax or base price) is missing."""
    names = products.select(F.col("ID").alias("ProductID"), "PrNomer")
    return rows.filter(F.col(column).isNull()).join(names, "ProductID").select("ProductID", "PrNomer").distinct()
