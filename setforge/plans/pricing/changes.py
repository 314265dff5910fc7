"""What changes on the calculation date, and which (price list, product) pairs that touches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setforge.operators.rules import lacks_flag, wildcard_semi
from setforge.operators.temporal import opt_eq
from setforge.plans.pricing.scope import PAIR

# Change labels as the reference prints them.
BASE_PRICE = "Новая БЦ"
FORMULA = "Новая формула"
BLOCK = "Новая блокировка продукта"
BINDING = "Новая привязка продукта"
TAX = "Новый НДС"
SETTING = "Новая скидка"
SETTING_END = "Конец скидки"
EXCEPTION = "Новое исключение БЦ"
EXCEPTION_END = "Закончилось исключение БЦ"

LIST_OFF = 128  # price list flag: not calculated


def gate(df: DataFrame, exists: DataFrame) -> DataFrame:
    """All rows of ``df`` if ``exists`` has a row, else none."""
    return df.filter(exists.exists())


def formula_change(params: DataFrame, param_values: DataFrame, date: Column, system: int) -> DataFrame:
    named = params.filter(F.col("ParamName") == "FormulaNTL").select("ParamID")
    on_date = param_values.filter((F.col("DateFrom") == date) & (F.col("SystemID") == system))
    return on_date.join(named, "ParamID", "left_semi")


def change_feed(
    pairs: DataFrame,
    actual: DataFrame,
    blocked: DataFrame,
    t: dict[str, DataFrame],
    date: Column,
    block_formula: int,
    legal_entity: int,
    system: int,
    price_list: int | None = None,
) -> DataFrame:
    """(PricePolID, ProductID, ChangeBy, DSettingID); NULL product = every product of the list."""

    def product_rows(df: DataFrame, label: str) -> DataFrame:
        return df.select(*PAIR, F.lit(label).alias("ChangeBy"), F.lit(None).cast("bigint").alias("DSettingID"))

    def setting_rows(df: DataFrame, label: str) -> DataFrame:
        nobody = F.lit(None).cast("bigint").alias("ProductID")
        return df.select("PricePolID", nobody, F.lit(label).alias("ChangeBy"), "DSettingID")

    lists = t["price_lists"]
    open_lists = lists.filter(lacks_flag("Status", LIST_OFF))
    yesterday = F.date_sub(date, 1)
    prices = t["base_prices"].filter((F.col("DatePrice") == date) & (F.col("LegalEntityID") == legal_entity))
    # the type must be the branch type or the type of some open list; the product counts in all lists
    typed = prices.filter(F.col("BasePriceTypeID") == 1).unionByName(
        prices.filter(F.col("BasePriceTypeID") != 1).join(open_lists.select("BasePriceTypeID"), "BasePriceTypeID", "left_semi").select(*prices.columns)
    )
    new_tax = t["statuses"].filter(F.col("Data") == date).select(F.col("ProdID").alias("ProductID"))
    tax_lists = opt_eq(open_lists.filter(F.col("NDS").isNull()), "PricePolID", price_list).select("PricePolID")
    bound = actual.filter((F.col("PLFormula") != block_formula) & (F.col("IsNow") == 1))
    bound = bound.select(F.col("PolType").alias("PricePolID"), "ProductID")
    settings = opt_eq(t["settings"], "PricePolID", price_list)
    exceptions = opt_eq(t["exceptions"].filter(F.col("RowState") == 1), "PricePolID", price_list)
    branches = [
        product_rows(pairs.join(typed.select("ProductID"), "ProductID", "left_semi"), BASE_PRICE),
        product_rows(gate(pairs, formula_change(t["params"], t["param_values"], date, system)), FORMULA),
        product_rows(pairs.join(blocked.filter(F.col("BlockNow") == 1), PAIR, "left_semi"), BLOCK),
        product_rows(pairs.join(bound, PAIR, "left_semi"), BINDING),
        product_rows(
            pairs.join(tax_lists, "PricePolID", "left_semi").join(new_tax, "ProductID", "left_semi"), TAX
        ),
        setting_rows(settings.filter(F.col("DateBegin") == date), SETTING),
        setting_rows(settings.filter(F.col("DateEnd") == yesterday), SETTING_END),
        product_rows(exceptions.filter(F.col("DateBegin") == date), EXCEPTION),
        product_rows(exceptions.filter(F.col("DateEnd") == yesterday), EXCEPTION_END),
    ]
    return reduce(DataFrame.unionByName, branches).distinct()


def work_list(candidates: DataFrame, feed: DataFrame, price_lists: DataFrame) -> DataFrame:
    """(PricePolID, ProductID, IsBlock): candidates that some change names, open lists only.

    A change names a candidate when its product (or none) and its setting (or none) fit;
    candidates under setting 0 accept any setting.
    """
    free = candidates.filter(F.col("DSettingID") == 0)
    bound = candidates.filter(F.col("DSettingID") != 0)
    touched = wildcard_semi(bound, feed, ["PricePolID"], ["ProductID", "DSettingID"]).unionByName(
        wildcard_semi(free, feed, ["PricePolID"], ["ProductID"])
    )
    open_lists = price_lists.filter(lacks_flag("Status", LIST_OFF)).select("PricePolID")
    return (
        touched.join(open_lists, "PricePolID", "left_semi").groupBy(*PAIR).agg(F.max("BlockNow").alias("IsBlock"))
    )
