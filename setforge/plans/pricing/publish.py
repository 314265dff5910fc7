"""Checks on the new prices and their way into the archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setforge.operators.merge import delete_where, merge_snapshot, merged_rows
from setforge.operators.rules import has_flag
from setforge.operators.temporal import opt_eq

ARCHIVE_COLUMNS = [
    "ProductID", "Data", "PolType", "Price", "NDS", "CurrID", "Status",
    "BasePriceTypeID", "NDSID", "BasePrice", "Price1", "Price2",
]


def calculated(status: str = "Status") -> Column:
    """Statuses this run writes (a blocked price, 20, carries bit 16 too)."""
    return has_flag(status, 16) | has_flag(status, 32)


def purge_stale(new_prices: DataFrame, ready: DataFrame, date: Column, price_list: int | None = None) -> DataFrame:
    """Rows of the new price table that stay: other dates, and foreign rows of products not priced now."""
    scope = F.col("Data") == date
    if price_list is not None:
        scope = scope & (F.col("PolType") == price_list)
    priced = ready.select(F.col("PricePolID").alias("PolType"), "ProductID")
    return delete_where(new_prices, priced, ["PolType", "ProductID"], scope, calculated())


def negative_prices(prices: DataFrame, products: DataFrame) -> DataFrame:
    names = products.select(F.col("ID").alias("ProductID"), "PrNomer")
    return prices.filter(F.col("Price") < 0).join(names, "ProductID").select("ProductID", "PrNomer", "PolType", "Price")


class NegativePrices(ValueError):
    """Raised with the number of rows below zero; ``rows`` lists them all."""

    def __init__(self, column: str, count: int, rows: DataFrame):
        self.count, self.rows = count, rows
        super().__init__(f"{count} rows with negative {column}; see .rows")


def assert_non_negative(prices: DataFrame, column: str = "Price") -> None:
    bad = prices.filter(F.col(column) < 0)
    count = bad.count()
    if count:
        raise NegativePrices(column, count, bad)


def publish_prices(
    archive: DataFrame, prices: DataFrame, date: Column, price_list: int | None = None
) -> DataFrame:
    """The archive's rows of the date after the merge, each with its action."""

    def scope(df: DataFrame) -> DataFrame:
        return opt_eq(df.filter(F.col("Data") == date), "PolType", price_list).select(*ARCHIVE_COLUMNS)

    return merge_snapshot(
        scope(archive),
        scope(prices).filter(calculated()),
        ["PolType", "ProductID", "Data"],
        ["Price", "NDSID", "Status"],
        delete_when=calculated(),
    )


def new_prices_after(kept: DataFrame, prices: DataFrame, date: Column) -> DataFrame:
    """All rows of the date in the new price table after a run: what stays and what was calculated."""
    stays = kept.filter(F.col("Data") == date)
    return stays.unionByName(prices.select(*[c for c in stays.columns if c in prices.columns]), allowMissingColumns=True).select(*stays.columns)


def archive_after(archive: DataFrame, merged: DataFrame, date: Column, price_list: int | None = None) -> DataFrame:
    """All rows of the date in the archive after a run: the merge, and other price lists as they were."""
    fresh = merged_rows(merged)
    of_date = archive.filter(F.col("Data") == date).select(*ARCHIVE_COLUMNS)
    if price_list is None:
        return fresh
    return fresh.unionByName(of_date.filter(~F.col("PolType").eqNullSafe(F.lit(price_list))))
