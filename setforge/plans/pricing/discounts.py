"""Fixed prices and discount layers by priority, and the layers as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setforge.operators.rules import pick_by_priority
from setforge.plans.pricing.scope import PAIR

PERCENT = "decimal(8,4)"


def offered_settings(candidates: DataFrame, work: DataFrame, settings: DataFrame) -> DataFrame:
    """(PricePolID, ProductID, DSettingID, FixPrice): the settings of the candidates to be priced."""
    working = candidates.join(work, PAIR, "left_semi").select(*PAIR, "DSettingID")
    return working.join(settings.select("DSettingID", "FixPrice"), "DSettingID").select(*PAIR, "DSettingID", "FixPrice")


def fixed_prices(offered: DataFrame) -> DataFrame:
    """(PricePolID, ProductID, DSettingID, FixPrice): the newest setting with a fixed price wins,
    and a newest price of 0 cancels the older ones."""
    return pick_by_priority(
        offered.filter(F.col("FixPrice") >= 0),
        PAIR,
        "DSettingID",
        keep=F.col("FixPrice") > 0,
    )


def layer_choice(offered: DataFrame, layers: DataFrame, fixed: DataFrame) -> DataFrame:
    """(PricePolID, ProductID, DSettingID, DLayerID, DiscountPercent): newest setting per layer.

    A setting without layers stands under layer 0. Products with a fixed price have no layers.
    """
    offers = (
        offered.filter(F.coalesce("FixPrice", F.lit(0)) == 0)
        .join(layers.select("DSettingID", "DLayerID", "DiscountPercent"), "DSettingID", "left")
        .join(fixed, PAIR, "left_anti")
        .select(
            *PAIR,
            "DSettingID",
            F.coalesce("DLayerID", F.lit(0)).alias("DLayerID"),
            F.col("DiscountPercent").cast(PERCENT).alias("DiscountPercent"),
        )
    )
    return pick_by_priority(offers, [*PAIR, "DLayerID"], "DSettingID").select(
        *PAIR, "DSettingID", "DLayerID", "DiscountPercent"
    )


def layer_tokens(layers: DataFrame, groups: DataFrame) -> DataFrame:
    """(DLayerID, token): ``L`` + group id + layer id, live rows only."""
    live = groups.filter(F.col("RowState") == 1).select("DLayerGroupID")
    token = F.concat(F.lit("L"), F.col("DLayerGroupID").cast("string"), F.col("DLayerID").cast("string"))
    return layers.filter(F.col("RowState") == 1).join(live, "DLayerGroupID").select("DLayerID", token.alias("token"))


def pivot_layers(chosen: DataFrame, tokens: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (price list, product) with one percent column per token; missing layers are 0.

    A layer in use whose token has no column would be lost, so it is refused.
    """
    used = chosen.select("DLayerID").distinct().join(tokens, "DLayerID")
    strange = sorted({r.token for r in used.filter(~F.col("token").isin(list(columns))).collect()})  # configured layers only
    if strange:
        raise ValueError(f"layers without a column: {', '.join(strange)}")
    named = chosen.join(tokens, "DLayerID", "left").select(*PAIR, "token", "DiscountPercent")
    wide = named.groupBy(*PAIR).pivot("token", list(columns)).agg(F.max("DiscountPercent"))
    zero = F.lit(0).cast(PERCENT)
    return wide.select(*PAIR, *[F.coalesce(c, zero).alias(c) for c in columns])


def forbidden_tokens(tokens: DataFrame, layer_ids: Sequence[int], formula: str, mode: str = "substring") -> DataFrame:
    """Tokens of reserved layers that the formula mentions.

    Mode "substring" also finds ``L12`` inside ``L120``; mode "token" looks for whole names.
    """
    reserved = tokens.filter(F.col("DLayerID").isin(list(layer_ids)))
    text = F.lit(formula)
    if mode == "substring":
        return reserved.filter(F.contains(text, F.col("token")))
    if mode == "token":
        return reserved.filter(F.array_contains(F.split(text, r"[^A-Za-z0-9_]+"), F.col("token")))
    raise ValueError(f"mode: {mode}")
