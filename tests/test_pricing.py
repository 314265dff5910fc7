from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from conftest import SF
from pyspark.sql import functions as F

from setforge.operators.merge import RepeatedKeys
from setforge.plans.pricing.discounts import forbidden_tokens, layer_tokens, pivot_layers
from setforge.plans.pricing.prices import FormulaPart, assemble_formula, check_formula, exception_prices, formula_price
from setforge.plans.pricing.publish import assert_non_negative, publish_prices
from setforge.plans.pricing.run import PriceConfig, check_params, write_run

PARTS = [FormulaPart(2, "BasePrice", "(100-L22)/100"), FormulaPart(1, "BasePrice", "(100-L11)/100"), FormulaPart(3, "BasePrice", "(100-L33)/100")]
READY = (
    "PricePolID int, ProductID int, NDS int, NDSID int, BasePrice decimal(12,2), CurrID int, BasePriceTypeID int, PricePolStatus int,"
    " FixPrice decimal(12,2), IsDiscountEnd int, IsBlock int, L11 decimal(8,4), L22 decimal(8,4), L33 decimal(8,4)"
)


def ready(spark, **over):
    row = dict(
        PricePolID=1, ProductID=1, NDS=10, NDSID=10, BasePrice=Decimal("99.99"), CurrID=0, BasePriceTypeID=1, PricePolStatus=0,
        FixPrice=None, IsDiscountEnd=0, IsBlock=0, L11=Decimal(10), L22=Decimal("3.5"), L33=Decimal(5),
    )
    row.update(over)
    return spark.createDataFrame([tuple(row.values())], READY)


def price(spark, precision=1, **over):
    return formula_price(ready(spark, **over), PARTS, F.lit(date(2017, 6, 15)), precision).first()


def test_price_order_and_status(spark):
    # 99.99*0.9*0.965 = 86.841315 -> 86.84 after the second group, *0.95 = 82.498 -> 82.50
    assert (price(spark).Price, price(spark).Status) == (Decimal("82.5000"), 16)
    assert (price(spark, FixPrice=Decimal(7)).Price, price(spark, FixPrice=Decimal(7)).Status) == (Decimal("7.0000"), 32)
    ended = price(spark, IsDiscountEnd=1)
    assert (ended.Price, ended.Status, ended.Price1) == (Decimal("99.9900"), 16, Decimal("0.0000"))
    assert (price(spark, IsBlock=1).Price, price(spark, IsBlock=1).Status) == (Decimal("0.0000"), 20)


def test_fine_rounding(spark):
    # 86.8413 * 0.95 = 82.499235 -> 82.4992
    assert price(spark, CurrID=1).Price == Decimal("82.4992")
    assert price(spark, PricePolStatus=256).Price == Decimal("82.4992")
    assert price(spark, precision=0, PricePolStatus=256).Price == Decimal("82.5000")


def test_formula_is_checked():
    with pytest.raises(ValueError):
        check_formula("BasePrice*Secret", ["BasePrice"])
    with pytest.raises(ValueError):
        check_formula("BasePrice; 1", ["BasePrice"])
    with pytest.raises(ValueError):
        assemble_formula([FormulaPart(2, "BasePrice", "1")], ["BasePrice"], 1)


def test_tokens_and_pivot(spark):
    layers = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (20, 1, 1), (3, 2, 0)], "DLayerID int, DLayerGroupID int, RowState int")
    groups = spark.createDataFrame([(1, 1), (2, 1)], "DLayerGroupID int, RowState int")
    tokens = layer_tokens(layers, groups)
    assert sorted(r.token for r in tokens.collect()) == ["L11", "L12", "L120"]
    assert [r.token for r in forbidden_tokens(tokens, [2], "BasePrice*L120").collect()] == ["L12"]
    assert forbidden_tokens(tokens, [2], "BasePrice*L120", "token").count() == 0
    chosen = spark.createDataFrame([(1, 1, 1, Decimal(5)), (1, 1, 20, Decimal(6)), (2, 1, 0, None)], "PricePolID int, ProductID int, DLayerID int, DiscountPercent decimal(8,4)")
    wide = {r.PricePolID: (r.L11, r.L12, r.L120) for r in pivot_layers(chosen, tokens, ["L11", "L12", "L120"]).collect()}
    assert wide == {1: (5, 0, 6), 2: (0, 0, 0)}


def test_guards(spark):
    config = PriceConfig(1, 3, PARTS, ["L11"], 1, 1, 4, 5)
    with pytest.raises(ValueError):
        check_params(config, None, False, date(2017, 1, 1))
    with pytest.raises(ValueError):
        check_params(config, date(2017, 1, 1), True, date(2017, 1, 1))
    with pytest.raises(ValueError):
        check_params(PriceConfig(None, 3, PARTS, [], 1, 1, 4, 5), date(2017, 1, 1), False, date(2017, 1, 1))
    check_params(config, date(2017, 1, 1), False, date(2017, 1, 1))
    with pytest.raises(ValueError):
        assert_non_negative(spark.createDataFrame([(-1,)], "Price int"))


def test_own_exception_price_comes_first(spark):
    products = spark.createDataFrame([(1, 7, 0), (2, 7, 0), (3, 7, 512), (4, None, 0), (5, 7, 0)], "ID int, AGID int, Status int")
    work = spark.createDataFrame([(1, p) for p in (1, 2, 3, 4, 5)], "PricePolID int, ProductID int")
    day = date(2017, 1, 1)
    rows = [(1, 1, day, None, 30, 1), (1, 2, day, None, 20, 1), (1, 2, day, None, 25, 1), (1, 3, day, None, 5, 1), (1, 4, day, None, 6, 1), (1, 5, day, None, 1, 0)]
    exceptions = spark.createDataFrame(rows, "PricePolID int, ProductID int, DateBegin date, DateEnd date, BasePrice int, RowState int")
    found = exception_prices(work, products, exceptions, F.lit(date(2017, 6, 15)))
    assert sorted((r.ProductID, r.ExBasePrice) for r in found.collect()) == [(1, 30), (2, 20), (3, 20), (5, 20)]


def test_run_on_its_own_result(spark):
    from setforge.plans.pricing.run import price_run
    from setforge.queries import pricing

    targets = pricing._tables_after(spark, SF)
    t = pricing._tables(spark, SF)
    t = {**t, "archive": spark.read.parquet(targets.archive), "new_prices": spark.read.parquet(targets.new_prices)}
    again = price_run(t, pricing.CONFIG, pricing.CALC_DATE, make_change=True, today=date(1998, 6, 14))
    assert t["archive"].groupBy("PolType", "ProductID", "Data").count().where("count > 1").isEmpty()
    # nothing is new to a second run; rows whose change it has already dealt with are no longer its own
    actions = again.merged.groupBy("PolType", "ProductID").agg(F.count("*").alias("n"), F.first("action").alias("action")).collect()
    assert {r.n for r in actions} == {1} and "KEEP" in {r.action for r in actions} <= {"KEEP", "DELETE"}
    # a price of its own for every pair of the date, and a doubled one is refused before anything is written
    twice = replace(again, merged=merge_again(again, t), log=again.log.union(spark.createDataFrame([("archive", "REFUSE_UPDATE", 1)], "a string, b string, c long")))
    with pytest.raises(RepeatedKeys) as refused:
        write_run(t, twice, again.prices, pricing.CALC_DATE, None, targets)
    assert refused.value.rows.count() == 1


def merge_again(run, t):
    from setforge.queries import pricing

    one = run.prices.limit(1)
    return publish_prices(t["archive"], run.prices.union(one), F.lit(pricing.CALC_DATE))


def test_stages_read_twice_are_written_once(spark):
    from conftest import SF
    from setforge.plans.pricing.run import PriceStages
    from setforge.queries import price_tables as pt
    from setforge.queries.pricing import CALC_DATE, CONFIG
    from setforge.session import cut_lineage

    written = []
    s = PriceStages(pt.price_tables(spark, SF), CONFIG, CALC_DATE, reuse=lambda df: (written.append(tuple(df.columns)), cut_lineage(df))[1])
    assert s.merged.count() > 0 and s.tax.count() > 0 and s.base.count() > 0
    priced = ("PricePolID", "ProductID", "DSettingID", "FixPrice")
    once = [("ProductID", "BasePriceTypeID", "BasePrice"), tuple(s.tax.columns), tuple(s.base.columns), tuple(s.merged.columns)]
    assert written.count(priced) == 2 and all(written.count(c) == 1 for c in once)
