"""The whole price run, its parameter checks and its run log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date as Date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setforge.operators.merge import KEEP, RepeatedKeys, change_summary, refused_rows
from setforge.operators.temporal import latest_as_of, opt_eq
from setforge.plans.pricing import changes, discounts, prices, publish, scope
from setforge.plans.pricing.prices import FormulaPart
from setforge.session import cut_lineage
from setforge.sources.tables import append, replace_partitions


@dataclass(frozen=True)
class PriceConfig:
    """Settings the run reads once; the formula parts and layer names are small by nature."""

    precision: int | None
    block_formula: int | None
    parts: Sequence[FormulaPart]
    layer_columns: Sequence[str]
    legal_entity: int
    system: int
    base_layer: int
    fix_layer: int
    rule_mode: str = "any"


def config_as_of(params: DataFrame, param_values: DataFrame, name: str, date: Date) -> DataFrame:
    """The rows of a named parameter in force on a date."""
    ids = params.filter(F.col("ParamName") == name).select("ParamID")
    return latest_as_of(param_values.join(ids, "ParamID", "left_semi"), ["ParamID"], "DateFrom", F.lit(date))


def reserved_layers(layers: DataFrame) -> DataFrame:
    """(DLayerID, DLayerStatus) of the base price layer (1) and the fixed price layer (2)."""
    live = layers.filter((F.col("RowState") == 1) & F.col("DLayerStatus").isin(1, 2))
    return live.select("DLayerID", "DLayerStatus")


def check_params(config: PriceConfig, calc_date: Date | None, make_change: bool, today: Date) -> None:
    if calc_date is None:
        raise ValueError("no calculation date")
    if make_change and calc_date <= today:
        raise ValueError("prices can be published only for a date from tomorrow on")
    for name in ("precision", "block_formula"):
        if getattr(config, name) is None:
            raise ValueError(f"missing setting: {name}")
    if not config.parts:
        raise ValueError("missing setting: formula parts")


def check_layers(config: PriceConfig, t: dict[str, DataFrame]) -> None:
    """The formula must not use the reserved layers (a handful of tokens comes back)."""
    tokens = discounts.layer_tokens(t["layers"], t["layer_groups"])
    text = " ".join(f"{p.part}*{p.group}" for p in config.parts)
    bad = discounts.forbidden_tokens(tokens, [config.base_layer, config.fix_layer], text).collect()
    if bad:
        raise ValueError(f"the formula uses reserved layers: {[r.token for r in bad]}")


def quality_counters(tax: DataFrame, base: DataFrame, ready: DataFrame) -> DataFrame:
    """One row: pairs without tax, pairs without base price, rows ready to be priced."""
    parts = [
        tax.select(F.col("NDS").isNull().alias("no_tax"), F.lit(False).alias("no_base"), F.lit(False).alias("ready")),
        base.select(F.lit(False), F.col("BasePrice").isNull(), F.lit(False)),
        ready.select(F.lit(False), F.lit(False), F.lit(True)),
    ]
    rows = reduce(DataFrame.union, parts)
    return rows.agg(*[F.count_if(c).alias(c) for c in ("no_tax", "no_base", "ready")])


class PriceStages:
    """The stages of one run, each built on first use.

    Stages that several later ones read are written out once (``reuse``, by default the
    reliable checkpoint): otherwise each reader would carry the whole plan again.
    """

    def __init__(
        self,
        tables: dict[str, DataFrame],
        config: PriceConfig,
        calc_date: Date,
        price_list: int | None = None,
        product: int | None = None,
        reuse: Callable[[DataFrame], DataFrame] = cut_lineage,
    ):
        self.t, self.config, self.date = tables, config, F.lit(calc_date)
        self.price_list, self.product, self.reuse = price_list, product, reuse

    @cached_property
    def actual(self) -> DataFrame:
        return scope.actual_bindings(self.t["bindings"], self.date, self.price_list)

    @cached_property
    def active(self) -> DataFrame:
        return scope.active_settings(self.t["settings"], self.t["price_lists"], self.date, self.price_list)

    @cached_property
    def resolved(self) -> DataFrame:
        return scope.resolve_settings(self.active, self.t, self.date, self.config.rule_mode)

    @cached_property
    def blocked(self) -> DataFrame:
        return self.reuse(scope.blocked_products(self.actual, self.config.block_formula))

    @cached_property
    def candidates(self) -> DataFrame:
        found = scope.candidate_products(
            self.reuse(self.resolved.distinct()), self.blocked, self.t, self.date, self.price_list, self.product, self.reuse
        )
        return self.reuse(found)

    @cached_property
    def feed(self) -> DataFrame:
        pairs = scope.product_list(self.candidates)
        c = self.config
        found = changes.change_feed(
            pairs, self.actual, self.blocked, self.t, self.date, c.block_formula, c.legal_entity, c.system, self.price_list
        )
        return self.reuse(found)

    @cached_property
    def work(self) -> DataFrame:
        return self.reuse(changes.work_list(self.candidates, self.feed, self.t["price_lists"]))

    @cached_property
    def offered(self) -> DataFrame:
        return self.reuse(discounts.offered_settings(self.candidates, self.work, self.t["settings"]))

    @cached_property
    def fixed(self) -> DataFrame:
        return self.reuse(discounts.fixed_prices(self.offered))

    @cached_property
    def chosen(self) -> DataFrame:
        return self.reuse(discounts.layer_choice(self.offered, self.t["layer_settings"], self.fixed))

    @cached_property
    def layers(self) -> DataFrame:
        tokens = discounts.layer_tokens(self.t["layers"], self.t["layer_groups"])
        return discounts.pivot_layers(self.chosen, tokens, self.config.layer_columns)

    @cached_property
    def tax(self) -> DataFrame:
        return self.reuse(prices.tax_as_of(self.work, self.t["price_lists"], self.t["statuses"], self.date))

    @cached_property
    def base(self) -> DataFrame:
        t, c = self.t, self.config
        exceptions = prices.exception_prices(self.work, t["products"], t["exceptions"], self.date)
        found = prices.base_price(
            self.work, t["price_lists"], t["base_prices"], self.chosen, exceptions, self.date, c.legal_entity, c.base_layer, self.reuse
        )
        return self.reuse(found)

    @cached_property
    def ready(self) -> DataFrame:
        return self.reuse(
            prices.ready_rows(self.work, self.t["price_lists"], self.tax, self.base, self.fixed, self.layers)
        )

    @cached_property
    def prices(self) -> DataFrame:
        return prices.formula_price(self.ready, self.config.parts, self.date, self.config.precision)

    @cached_property
    def kept(self) -> DataFrame:
        """What stays of the new price table beside ``prices``."""
        return publish.purge_stale(self.t["new_prices"], self.ready, self.date, self.price_list)

    @cached_property
    def merged(self) -> DataFrame:
        return self.reuse(publish.publish_prices(self.t["archive"], self.prices, self.date, self.price_list))


def run_log(s: PriceStages, published: bool) -> DataFrame:
    """(step, metric, value) counters of a run."""

    def lines(df: DataFrame, step: str, metric: Column, value: str) -> DataFrame:
        return df.select(F.lit(step).alias("step"), metric.alias("metric"), F.col(value).cast("bigint").alias("value"))

    counters = quality_counters(s.tax, s.base, s.ready)
    parts = [
        lines(change_summary(s.feed, "ChangeBy"), "changes", F.col("ChangeBy"), "n"),
        lines(s.work.agg(F.count_distinct("ProductID").alias("n")), "work", F.lit("products"), "n"),
        lines(counters.select(F.expr("stack(3, 'no_tax', no_tax, 'no_base', no_base, 'ready', ready) AS (name, n)")), "quality", F.col("name"), "n"),
        lines(s.prices.agg(F.count(F.lit(1)).alias("n")), "prices", F.lit("rows"), "n"),
    ]
    if published:
        moved = s.merged.filter(F.col("action") != KEEP)
        parts.append(lines(change_summary(moved, "action"), "archive", F.col("action"), "n"))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class PriceRun:
    """Results of a run: new prices, what stays beside them, the archive merge, the log."""

    prices: DataFrame
    kept: DataFrame
    merged: DataFrame | None
    log: DataFrame


@dataclass(frozen=True)
class PriceTargets:
    """Folders a run writes to: tables partitioned by Data, the log, and a folder for finished parts."""

    new_prices: str
    archive: str
    log: str
    staging: str


def config_from_tables(config: PriceConfig, t: dict[str, DataFrame]) -> PriceConfig:
    """``config`` with the reserved layers that the layer table marks (two rows come back)."""
    found = {r.DLayerStatus: r.DLayerID for r in reserved_layers(t["layers"]).collect()}
    return replace(config, base_layer=found.get(1, config.base_layer), fix_layer=found.get(2, config.fix_layer))


def price_run(
    t: dict[str, DataFrame],
    config: PriceConfig,
    calc_date: Date,
    make_change: bool = False,
    price_list: int | None = None,
    product: int | None = None,
    today: Date | None = None,
    targets: PriceTargets | None = None,
) -> PriceRun:
    """Check, calculate, guard, and write to ``targets`` if they are given.

    The guard reads all new prices of the date, kept rows included. Without ``make_change`` there is no
    merge and the archive stays, as in a trial run.
    """
    check_params(config, calc_date, make_change, today or Date.today())
    config = config_from_tables(config, t)
    check_layers(config, t)
    s = PriceStages(t, config, calc_date, price_list, product)
    after = publish.new_prices_after(s.kept, s.prices, F.lit(calc_date))
    publish.assert_non_negative(opt_eq(after, "PolType", price_list))
    result = PriceRun(s.prices, s.kept, s.merged if make_change else None, run_log(s, make_change))
    if targets is not None:
        write_run(t, result, after, calc_date, price_list, targets)
    return result


def write_run(t: dict[str, DataFrame], result: PriceRun, new_prices: DataFrame, calc_date: Date, price_list: int | None, targets: PriceTargets) -> None:
    """Replace the date's partition of both tables, also where no row is left, and append to the log.

    Nothing is written if the merge refused a key that the run priced twice.
    """
    touched, date = [{"Data": calc_date}], F.lit(calc_date)
    log = cut_lineage(result.log.withColumn("Data", date))  # counted before the archive changes
    if not refused_rows(log, "metric").isEmpty():
        raise RepeatedKeys(refused_rows(result.merged))
    replace_partitions(new_prices, targets.new_prices, f"{targets.staging}/new_prices", ["Data"], touched)
    if result.merged is not None:
        archive = publish.archive_after(t["archive"], result.merged, date, price_list)
        replace_partitions(archive, targets.archive, f"{targets.staging}/archive", ["Data"], touched)
    append(log, targets.log)
