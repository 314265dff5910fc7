"""Check imported cells against the declared type of their column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setforge.functions.tsql_types import KNOWN, DeclaredType, converted_text, text_length

# Error codes and texts.
UNKNOWN_TYPE, NO_ERROR, EMPTY, WRONG_TYPE, TOO_LONG = -1, 0, 2, 3, 4
CODE_TEXT = {
    EMPTY: "Пустое значение не допустимо. Ожидается тип - ",
    WRONG_TYPE: "Ошибочный тип данных, ожидается тип - ",
    TOO_LONG: "Превышение размерности ({size} символов), ожидается тип - ",
}
GUID_TEXT = "GUID (00000000-0000-0000-0000-000000000000)"
TYPE_TEXT = {
    "целый тип": ("tinyint", "smallint", "int", "bigint"),
    "вещественное число": ("real", "money", "float", "decimal", "numeric", "smallmoney"),
    "строка\\текст (или символ)": ("varchar", "char", "nvarchar", "text", "ntext", "sysname"),
    GUID_TEXT: ("uniqueidentifier",),
}


@dataclass(frozen=True)
class ColumnRule:
    num: int
    type_name: str
    nullable: bool | None = None


def rules_from(df: DataFrame) -> list[ColumnRule]:
    """Rules as a list: one per column of a sheet."""
    rows = df.select("Num", "TypeFName", "Nullable").collect()
    return sorted((ColumnRule(r.Num, r.TypeFName, r.Nullable) for r in rows), key=lambda r: r.num)


class UnknownTypes(ValueError):
    """Raised with the rules whose type is not known."""

    def __init__(self, rules: Sequence[ColumnRule]):
        self.rules = list(rules)
        super().__init__("unknown types: " + ", ".join(f"column {r.num}: {r.type_name}" for r in self.rules))


def unknown_types(rules: DataFrame) -> DataFrame:
    """(Num, TypeFName, ErrorCode) of the rules whose declared type is not known."""
    name = F.regexp_extract(F.lower(F.trim("TypeFName")), r"^([a-z_0-9]+)\s*(\(\s*\w+\s*(,\s*\d+\s*)?\))?$", 1)
    return rules.where(~F.coalesce(name.isin(*KNOWN), F.lit(False))).select("Num", "TypeFName", F.lit(UNKNOWN_TYPE).alias("ErrorCode"))


def type_text(name: str) -> str:
    if "date" in name:
        return "дата"
    return next((text for text, names in TYPE_TEXT.items() if name in names), name)


def error_code(
    value: Column, rule: ColumnRule, declared: DeclaredType, converted: Column | None = None
) -> Column:
    blank = text_length(value) == 0
    converted = converted_text(value, declared) if converted is None else converted
    longer = text_length(value) > F.length(F.rtrim(converted))
    code = F.when(longer, TOO_LONG).when(converted.isNull(), WRONG_TYPE).otherwise(NO_ERROR)
    if rule.nullable is True:
        return F.when(blank, NO_ERROR).otherwise(code)
    if rule.nullable is False:
        return F.when(blank, EMPTY).otherwise(code)
    return code


def error_text(code: Column, declared: DeclaredType) -> Column:
    tail = f"{type_text(declared.name)} [{declared.full}]"
    text = F.lit(None).cast("string")
    for number, head in CODE_TEXT.items():
        text = F.when(code == number, F.lit(head.format(size=declared.size) + tail)).otherwise(text)
    return text


def pivot_cells(cells: DataFrame, columns: Sequence[int], keys: Sequence[str] = ("RN",)) -> DataFrame:
    """One row per sheet row with the largest value and name of each listed column."""
    picks = []
    for n in columns:
        here = F.col("CN") == n
        picks += [F.max(F.when(here, F.col("CV"))).alias(f"CV_{n}"), F.max(F.when(here, F.col("CNN"))).alias(f"CNN_{n}")]
    return cells.groupBy(*keys).agg(*picks)


def validate_cells(cells: DataFrame, rules: Sequence[ColumnRule], keys: Sequence[str] | None = None) -> DataFrame:
    """Error rows ``(keys, ErrorCode, RowNum, CellNum, CellName, CellValue, ErrorRus, ErrorMessage,
    TypeFName, TypeName, Scale)``.

    A row's missing cell counts as empty, cells of columns without a rule are ignored, and a row
    number met twice (two sheets) is one row with the larger value. ``keys`` tell rows apart: by
    default RN, and the workbook's ``source`` if the cells have one, so workbooks never mix. All columns
    are checked in one pass over one aggregate. UnknownTypes names columns of types not known, if there
    is a cell to check.
    """
    if keys is None:
        keys = [*(c for c in ("source",) if c in cells.columns), "RN"]
    if not rules:
        raise ValueError("no column types given")
    declared = {r.num: DeclaredType.parse(r.type_name) for r in rules}
    unknown = [r for r in rules if not declared[r.num].known]
    if unknown and not cells.isEmpty():
        raise UnknownTypes(unknown)
    wide = pivot_cells(cells, [r.num for r in rules], keys)
    # conversions are the costly part, so each gets a column of its own before it is tested twice
    wide = wide.withColumns({f"to_{r.num}": converted_text(F.col(f"CV_{r.num}"), declared[r.num]) for r in rules})
    wide = wide.withColumns(
        {f"code_{r.num}": error_code(F.col(f"CV_{r.num}"), r, declared[r.num], F.col(f"to_{r.num}")) for r in rules}
    ).filter(F.greatest(F.lit(NO_ERROR), *[F.col(f"code_{r.num}") for r in rules]) != NO_ERROR)
    checks = []
    for r in rules:
        d, value = declared[r.num], F.col(f"CV_{r.num}")
        code = F.col(f"code_{r.num}")
        checks.append(
            F.struct(
                code.alias("ErrorCode"),
                F.lit(r.num).alias("CellNum"),
                F.col(f"CNN_{r.num}").alias("CellName"),
                value.alias("CellValue"),
                error_text(code, d).alias("ErrorRus"),
                F.lit(d.full).alias("TypeFName"),
                F.lit(d.name).alias("TypeName"),
                F.lit(d.size).alias("Scale"),
            )
        )
    found = wide.select(*keys, F.explode(F.array(*checks)).alias("e")).filter(F.col("e.ErrorCode") != NO_ERROR)
    return found.select(
        *keys,
        "e.ErrorCode",
        F.col("RN").alias("RowNum"),
        "e.CellNum",
        "e.CellName",
        "e.CellValue",
        "e.ErrorRus",
        F.lit(None).cast("string").alias("ErrorMessage"),
        "e.TypeFName",
        "e.TypeName",
        "e.Scale",
    )


def error_count(errors: DataFrame) -> DataFrame:
    return errors.agg(F.count(F.lit(1)).alias("errors"))
