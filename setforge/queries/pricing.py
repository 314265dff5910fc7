"""Registered queries over the stages of the price run."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setforge.operators.merge import change_summary
from setforge.plans.pricing import changes, discounts, prices, run, scope
from setforge.plans.pricing.prices import FormulaPart
from setforge.plans.pricing.publish import ARCHIVE_COLUMNS
from setforge.plans.pricing.run import PriceConfig
from setforge.queries import price_tables as pt
from setforge.queries.price_oracle import FORMULA_SYSTEM, RUN_SYSTEM, stage_sql
from setforge.queries.registry import Registry
from setforge.session import new_folder, remove_stages

CALC_DATE = date(1998, 6, 15)
PARTS = [
    FormulaPart(1, "BasePrice", "(100-L11)*0.01"),
    FormulaPart(2, "(BasePrice*(100-L11)*0.01)", "(100-L22)*0.01"),
    FormulaPart(3, "(BasePrice*(100-L11)*0.01*(100-L22)*0.01)", "(100-L33)*0.01"),
]
CONFIG = PriceConfig(
    precision=pt.PRECISION,
    block_formula=pt.BLOCK_FORMULA,
    parts=PARTS,
    layer_columns=["L11", "L22", "L33", "L14"],
    legal_entity=pt.LEGAL_ENTITY,
    system=RUN_SYSTEM,
    base_layer=pt.BASE_LAYER,
    fix_layer=pt.FIX_LAYER,
)
registry = Registry()


def _flat(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, the form the oracle comparison uses."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "date":
            c = c.cast("string")
        elif kind == "int":
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


_stages: dict[tuple, run.PriceStages] = {}


def stages_of(spark: SparkSession, sf_dir: str, mode: str = "any", system: int = RUN_SYSTEM) -> run.PriceStages:
    """The stages of one run, shared by the queries of a session: each stage is built once."""
    key = (spark.sparkContext.applicationId, sf_dir, mode, system)
    if key not in _stages:
        config = replace(CONFIG, rule_mode=mode, system=system)
        _stages[key] = run.PriceStages(pt.price_tables(spark, sf_dir), config, CALC_DATE)
    return _stages[key]


def forget_stages() -> None:
    """Make the next query build its stages anew (the benchmark does so before every query)."""
    _stages.clear()
    if spark := SparkSession.getActiveSession():
        remove_stages(spark)


def _stage(name: str, kinds: dict[str, str], key: str, mode: str = "any", system: int = RUN_SYSTEM) -> None:
    """Register stage ``name`` as query ``key``; ``kinds`` gives the columns and their oracle types."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(getattr(stages_of(spark, sf_dir, mode, system), name).select(*kinds))

    columns = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in kinds.items())
    source = {"layers": "wide"}.get(name, name)
    registry.add(key, query, stage_sql(source, f"SELECT {columns} FROM {source}", mode, system))


L, D, V = "BIGINT", "DOUBLE", "VARCHAR"
PAIR = {"PricePolID": L, "ProductID": L}
_stage("actual", {"ProductID": L, "PolType": L, "PLFormula": L, "IsNow": L}, "price_actual_bindings")
_stage(
    "active",
    {"DSettingID": L, **PAIR, "BrandID": L, "CategoryID": L, "MGID": L, "IsDiscountEnd": L},
    "price_active_settings",
)
_stage("resolved", {**PAIR, "DSettingID": L}, "price_resolved_settings")
_stage("resolved", {**PAIR, "DSettingID": L}, "price_resolved_settings_reference_mode", mode="reference")
_stage("blocked", {**PAIR, "BlockNow": L}, "price_blocked_products")
_stage("candidates", {**PAIR, "DSettingID": L, "BlockNow": L}, "price_candidate_products")
_stage("feed", {**PAIR, "ChangeBy": V, "DSettingID": L}, "price_change_feed")
_stage("feed", {**PAIR, "ChangeBy": V, "DSettingID": L}, "price_change_feed_formula", system=FORMULA_SYSTEM)
_stage("work", {**PAIR, "IsBlock": L}, "price_work_list_formula", system=FORMULA_SYSTEM)
_stage("work", {**PAIR, "IsBlock": L}, "price_work_list")
_stage("fixed", {**PAIR, "DSettingID": L, "FixPrice": D}, "price_fixed_by_priority")
_stage("chosen", {**PAIR, "DSettingID": L, "DLayerID": L, "DiscountPercent": D}, "price_layers_by_priority")
_stage("layers", {**PAIR, "L11": D, "L22": D, "L33": D, "L14": D}, "price_layer_pivot")
_stage("tax", {**PAIR, "NDS": L, "NDSID": L}, "price_tax_as_of")
_stage("base", {**PAIR, "BasePrice": D, "FilialBasePrice": D, "DiscountPercent": D}, "price_base_price")
_stage(
    "ready",
    {**PAIR, "NDS": L, "NDSID": L, "BasePrice": D, "CurrID": L, "PricePolStatus": L, "FixPrice": D, "IsDiscountEnd": L,
     "IsBlock": L, "L11": D, "L22": D, "L33": D, "L14": D},
    "price_ready_rows",
)
_stage(
    "prices",
    {"ProductID": L, "Data": V, "PolType": L, "Price": D, "NDS": L, "CurrID": L, "Status": L, "BasePriceTypeID": L,
     "NDSID": L, "BasePrice": D, "Price1": D, "Price2": D},
    "price_formula_prices",
)
_stage("kept", {"ProductID": L, "Data": V, "PolType": L, "Price": D, "Status": L}, "price_purge_stale")
_stage("merged", {"PolType": L, "ProductID": L, "action": V, "Price": D}, "price_publish_merge")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return pt.price_tables(spark, sf_dir)


def category_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    active = scope.active_settings(t["settings"], t["price_lists"], F.lit(CALC_DATE))
    return scope.category_leaves(t["categories"], active).select(
        F.col("CategoryID").cast("bigint").alias("CategoryID"), F.col("ParentCategoryID").alias("anc")
    )


registry.add(
    "price_category_levels",
    category_levels,
    stage_sql("cat_flat", "SELECT CAST(CategoryID AS BIGINT) AS CategoryID, anc FROM cat_flat"),
)


def brand_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    active = scope.active_settings(t["settings"], t["price_lists"], F.lit(CALC_DATE))
    return scope.brand_leaves(t["brands"], active).select(
        F.col("BrandID").cast("bigint").alias("BrandID"), F.col("ParentBrandID").cast("bigint").alias("anc")
    )


registry.add(
    "price_brand_levels",
    brand_levels,
    stage_sql("brand_flat", "SELECT CAST(BrandID AS BIGINT) AS BrandID, CAST(anc AS BIGINT) AS anc FROM brand_flat"),
)


def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    date = F.lit(CALC_DATE)
    active = scope.active_settings(t["settings"], t["price_lists"], date)
    rules = scope.market_group_rules(t["group_settings"], active, date)
    return scope.group_products(
        rules, t["market_groups"], t["brands"], t["categories"], t["unsecured"], t["c_products"]
    )


registry.add("price_group_products", group_members, stage_sql("mg_members", "SELECT MGPID, ProductID FROM mg_members"))


def rule_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    active = scope.active_settings(t["settings"], t["price_lists"], F.lit(CALC_DATE))
    return change_summary(scope.leveled_settings(active), "level")


registry.add(
    "price_rule_levels",
    rule_levels,
    stage_sql(
        "active",
        """SELECT CASE WHEN ProductID IS NOT NULL THEN 'product'
            WHEN CategoryID IS NOT NULL AND BrandID IS NULL AND MGID IS NULL THEN 'category'
            WHEN CategoryID IS NOT NULL AND BrandID IS NOT NULL AND MGID IS NULL THEN 'brand_category'
            WHEN BrandID IS NOT NULL AND CategoryID IS NULL AND MGID IS NULL THEN 'brand'
            WHEN MGID IS NOT NULL AND BrandID IS NULL AND CategoryID IS NULL THEN 'group' END AS level, count(*) AS n
        FROM active GROUP BY 1""",
    ),
)


def formula_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    change = changes.formula_change(t["params"], t["param_values"], F.lit(CALC_DATE), pt.SYSTEM)
    return changes.gate(t["bindings"].select(F.col("PolType").alias("PricePolID"), "ProductID").distinct(), change)


registry.add(
    "price_formula_gate",
    formula_gate,
    stage_sql(
        "actual",
        f"""SELECT DISTINCT PolType AS PricePolID, ProductID FROM bindings
        WHERE EXISTS (SELECT 1 FROM params p JOIN param_values v ON v.ParamID = p.ParamID
                      WHERE p.ParamName = 'FormulaNTL' AND v.DateFrom = {pt.CALC} AND v.SystemID = {pt.SYSTEM})""",
    ),
)


def config_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    latest = run.config_as_of(t["params"], t["param_values"], "FormulaNTL", date(1998, 6, 20))
    return _flat(latest.select("ParamID", "DateFrom", "SystemID"))


registry.add(
    "price_config_as_of",
    config_on_date,
    stage_sql(
        "actual",
        """SELECT CAST(v.ParamID AS BIGINT) AS ParamID, CAST(v.DateFrom AS VARCHAR) AS DateFrom, CAST(v.SystemID AS BIGINT) AS SystemID
        FROM params p JOIN param_values v ON v.ParamID = p.ParamID WHERE p.ParamName = 'FormulaNTL' AND v.DateFrom <= DATE '1998-06-20'
        QUALIFY rank() OVER (PARTITION BY v.ParamID ORDER BY v.DateFrom DESC) = 1""",
    ),
)


def reserved_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    tokens = discounts.layer_tokens(t["layers"], t["layer_groups"])
    text = "BasePrice*(100-(L11+L14))/100*(100-L22)/100"
    return _flat(discounts.forbidden_tokens(tokens, [pt.BASE_LAYER, pt.FIX_LAYER], text).select("DLayerID", "token"))


registry.add(
    "price_forbidden_tokens",
    reserved_tokens,
    stage_sql(
        "actual",
        f"""SELECT CAST(y.DLayerID AS BIGINT) AS DLayerID, 'L' || g.DLayerGroupID || y.DLayerID AS token
        FROM layers y JOIN layer_groups g ON g.DLayerGroupID = y.DLayerGroupID
        WHERE y.RowState = 1 AND g.RowState = 1 AND y.DLayerID IN ({pt.BASE_LAYER}, {pt.FIX_LAYER})
          AND contains('BasePrice*(100-(L11+L14))/100*(100-L22)/100', 'L' || g.DLayerGroupID || y.DLayerID)""",
    ),
)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run.price_run(_tables(spark, sf_dir), CONFIG, CALC_DATE, make_change=True, today=date(1998, 6, 14)).log


registry.add(
    "price_run_log",
    run_log,
    stage_sql(
        "merged",
        """SELECT 'changes' AS step, ChangeBy AS metric, count(*) AS value FROM feed GROUP BY 2
        UNION ALL SELECT 'work', 'products', count(DISTINCT ProductID) FROM work
        UNION ALL SELECT 'quality', 'no_tax', count(*) FROM tax WHERE NDS IS NULL
        UNION ALL SELECT 'quality', 'no_base', count(*) FROM base WHERE BasePrice IS NULL
        UNION ALL SELECT 'quality', 'ready', count(*) FROM ready
        UNION ALL SELECT 'prices', 'rows', count(*) FROM prices
        UNION ALL SELECT 'archive', action, count(*) FROM merged WHERE action <> 'KEEP' GROUP BY 2""",
    ),
)


def _tables_after(spark: SparkSession, sf_dir: str) -> run.PriceTargets:
    """Both stored tables written anew, and changed by a run."""
    folder = new_folder(spark, "prices")
    targets = run.PriceTargets(f"{folder}/new_prices", f"{folder}/archive", f"{folder}/log", f"{folder}/staging")
    t = _tables(spark, sf_dir)
    t["archive"].write.partitionBy("Data").parquet(targets.archive)
    t["new_prices"].write.partitionBy("Data").parquet(targets.new_prices)
    t = {**t, "archive": spark.read.parquet(targets.archive), "new_prices": spark.read.parquet(targets.new_prices)}
    run.price_run(t, CONFIG, CALC_DATE, make_change=True, today=date(1998, 6, 14), targets=targets)
    return targets


def archive_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive read back after the run wrote it."""
    return _flat(spark.read.parquet(_tables_after(spark, sf_dir).archive).select("PolType", "ProductID", "Data", "Price", "Status"))


registry.add(
    "price_archive_after",
    archive_after,
    stage_sql(
        "merged",
        f"""SELECT CAST(PolType AS BIGINT) AS PolType, CAST(ProductID AS BIGINT) AS ProductID, CAST(Data AS VARCHAR) AS Data,
            CAST(Price AS DOUBLE) AS Price, CAST(Status AS BIGINT) AS Status FROM archive WHERE Data <> {pt.CALC}
        UNION ALL SELECT PolType, ProductID, CAST({pt.CALC} AS VARCHAR), CAST(Price AS DOUBLE), Status
        FROM merged WHERE action <> 'DELETE'""",
    ),
)


def new_table_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of new prices read back after the run wrote it."""
    return _flat(spark.read.parquet(_tables_after(spark, sf_dir).new_prices).select("PolType", "ProductID", "Data", "Price", "Status"))


registry.add(
    "price_new_table_after",
    new_table_after,
    stage_sql(
        "kept",
        """SELECT CAST(PolType AS BIGINT) AS PolType, CAST(ProductID AS BIGINT) AS ProductID, CAST(Data AS VARCHAR) AS Data,
            CAST(Price AS DOUBLE) AS Price, CAST(Status AS BIGINT) AS Status FROM kept
        UNION ALL SELECT PolType, ProductID, CAST(Data AS VARCHAR), CAST(Price AS DOUBLE), Status FROM prices""",
    ),
)


def missing_base_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = stages_of(spark, sf_dir)
    return prices.missing_report(stages.base, "BasePrice", stages.t["products"])


registry.add(
    "price_missing_base_price",
    missing_base_price,
    stage_sql(
        "base",
        "SELECT DISTINCT p.ID AS ProductID, p.PrNomer FROM base b JOIN products p ON p.ID = b.ProductID WHERE b.BasePrice IS NULL",
    ),
)


def negative_price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guard's listing, over archive prices less a fixed amount so that some fall below 0."""
    from setforge.plans.pricing.publish import negative_prices

    t = _tables(spark, sf_dir)
    lowered = t["archive"].withColumn("Price", F.col("Price") - F.lit(5000))
    return _flat(negative_prices(lowered, t["products"]))


registry.add(
    "price_negative_rows",
    negative_price_rows,
    stage_sql(
        "actual",
        """SELECT p.ID AS ProductID, p.PrNomer, a.PolType, CAST(a.Price - 5000 AS DOUBLE) AS Price
        FROM archive a JOIN products p ON p.ID = a.ProductID WHERE a.Price - 5000 < 0""",
    ),
)
