"""Price formulas that are rows of a table, evaluated side by side in one plan.

A formula's text comes from its parts in order. It is turned into postfix order once per formula, and the postfix is
folded over a stack once per priced row, both in native expressions; no formula text reaches the expression parser.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"[A-Za-z_]\w*|\d+(?:\.\d+)?|[-+*/()]"
NEGATE = "~"
OPERATORS = "+-*/" + NEGATE


def formula_texts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, head, tail) of formula rows (keys, Num, Part, Gr).

    ``head`` is what is rounded first, part 1 with its factor and the factor of part 2; ``tail`` the factors of the
    later parts, in the order of Num, NULL if there are none. A formula without part 1 has no head.
    """
    text = F.when(F.col("Num") == 1, F.concat(F.lit("("), "Part", F.lit(")*("), "Gr", F.lit(")")))
    text = text.when(F.col("Num") == 2, F.concat(F.lit("*("), "Gr", F.lit(")"))).otherwise(F.concat(F.lit("("), "Gr", F.lit(")")))
    rows = parts.select(*keys, "Num", text.alias("__text"))
    head = F.expr("listagg(__text, '') WITHIN GROUP (ORDER BY Num) FILTER (WHERE Num <= 2)")
    tail = F.expr("listagg(__text, '*') WITHIN GROUP (ORDER BY Num) FILTER (WHERE Num > 2)")
    first = F.bool_or(F.col("Num") == 1)
    return rows.groupBy(*keys).agg(F.when(first, head).alias("head"), tail.alias("tail"))


def _tokens(text: Column) -> Column:
    """Names, numbers, brackets and operators, where a minus that no value precedes is a negation."""
    raw = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    before = F.slice(F.concat(F.array(F.lit("(")), raw), F.lit(1), F.size(raw))
    return F.zip_with(before, raw, lambda b, t: F.when((t == "-") & b.isin("(", *OPERATORS), NEGATE).otherwise(t))


def _rank(operator: Column) -> Column:
    return F.when(operator.isin("+", "-"), 1).when(operator.isin("*", "/"), 2).when(operator == NEGATE, 3).otherwise(0)


def postfix(text: Column) -> Column:
    """The tokens of a formula with every operator after its operands; equal operators go from the left."""

    def cut(stack: Column, stays) -> tuple[Column, Column]:
        """The stack up to the last entry that stays, and the entries above it from the top down."""
        kept = F.array_max(F.concat(F.array(F.lit(0)), F.transform(stack, lambda x, i: F.when(stays(x), i + 1).otherwise(0))))
        return F.slice(stack, F.lit(1), kept), F.reverse(F.slice(stack, kept + 1, F.size(stack)))

    def step(state: Column, token: Column) -> Column:
        out, stack = state["out"], state["stack"]
        rest, above = cut(stack, lambda x: (x == "(") | (_rank(x) < _rank(token)))
        opened, inside = cut(stack, lambda x: x == "(")
        one = F.array(token)
        state_of = lambda o, s: F.struct(o.alias("out"), s.alias("stack"))
        return (
            F.when(token.isin("(", NEGATE), state_of(out, F.concat(stack, one)))
            .when(token == ")", F.when(F.size(opened) > 0, state_of(F.concat(out, inside), F.slice(opened, F.lit(1), F.size(opened) - 1)))
                  .otherwise(state_of(F.concat(out, one), stack)))
            .when(token.isin(*OPERATORS), state_of(F.concat(out, above), F.concat(rest, one)))
            .otherwise(state_of(F.concat(out, one), stack))
        )

    nothing = F.array().cast("array<string>")
    start = F.struct(nothing.alias("out"), nothing.alias("stack"))
    return F.aggregate(_tokens(text), start, step, lambda s: F.concat(s["out"], F.reverse(s["stack"])))


def _is_value(token: Column) -> Column:
    return token.rlike(r"^\w")


def formula_fault(text: Column, program: Column, names: Sequence[str]) -> Column:
    """Why a formula has no value, or NULL: foreign characters, brackets, operands, unknown names."""
    plain = F.regexp_replace(text, r"\s+", "")
    foreign = F.array_join(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), "") != plain
    unknown = F.array_except(F.filter(program, lambda t: t.rlike("^[A-Za-z_]")), F.array(*map(F.lit, names)))

    def depth(state: Column, token: Column) -> Column:
        # values left on the stack; below 1, for good, once an operator lacks an operand
        after = state + F.when(_is_value(token), 1).when(token == NEGATE, 0).otherwise(-1)
        return F.when((state < 0) | (after < 1), F.lit(-1)).otherwise(after)

    return (
        F.when(text.isNull(), "formula has no first part")
        .when(foreign, "formula holds other signs than names, numbers, brackets and + - * /")
        .when(F.exists(program, lambda t: t.isin("(", ")")), "brackets do not match")
        .when(F.aggregate(program, F.lit(0), depth) != 1, "operands and operators do not match")
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown names: "), F.array_join(F.array_sort(unknown), ", ")))
    )


def evaluated(program: Column, values: Column) -> Column:
    """The value of a postfix program over a map from names to doubles.

    A division by zero and a NULL name make the value NULL.
    """

    def step(stack: Column, token: Column) -> Column:
        a, b = F.get(stack, F.lit(1)), F.get(stack, F.lit(0))  # the top comes first
        result = F.when(token == "+", a + b).when(token == "-", a - b).when(token == "*", a * b).when(token == "/", F.try_divide(a, b))
        number = F.when(token.rlike(r"^\d"), token.try_cast("double"))
        value = F.coalesce(number, F.try_element_at(values, token))
        return (
            F.when(_is_value(token), F.concat(F.array(value), stack))
            .when(token == NEGATE, F.concat(F.array(-b), F.slice(stack, F.lit(2), F.size(stack))))
            .otherwise(F.concat(F.array(result), F.slice(stack, F.lit(3), F.size(stack))))
        )

    return F.get(F.aggregate(program, F.array().cast("array<double>"), step), F.lit(0))


def formula_programs(parts: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, head, tail, fault) with both texts as postfix programs; what is faulty has no program."""
    rows = formula_texts(parts, keys)
    rows = rows.withColumn("__tail", F.coalesce("tail", F.lit("1"))).withColumn("h", postfix(F.col("head"))).withColumn("t", postfix(F.col("__tail")))
    fault = F.coalesce(formula_fault(F.col("head"), F.col("h"), names), formula_fault(F.col("__tail"), F.col("t"), names))
    rows = rows.withColumn("fault", fault)
    return rows.select(*keys, *[F.when(F.col("fault").isNull(), F.col(c)).alias(n) for c, n in (("h", "head"), ("t", "tail"))], "fault")


def by_formula(rows: DataFrame, parts: DataFrame, keys: Sequence[str], names: Sequence[str], digits: int | None = None) -> DataFrame:
    """``rows`` with formula_price and formula_fault by the formula of their keys.

    ``names`` are the columns that formulas may use, taken as doubles. The head is rounded to ``digits`` before the tail
    applies, and the result again; without ``digits`` nothing is rounded. Rows whose key has no formula say so.
    """
    programs = formula_programs(parts, keys, names)
    values = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))])
    cut = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    joined = rows.join(programs, list(keys), "left").withColumn("__values", values)
    head, tail = (evaluated(F.col(c), F.col("__values")) for c in ("head", "tail"))
    fault = F.when(F.col("fault").isNotNull(), F.col("fault")).when(F.col("head").isNull(), "no formula")
    return joined.select(*rows.columns, cut(cut(head) * tail).alias("formula_price"), fault.alias("formula_fault"))
