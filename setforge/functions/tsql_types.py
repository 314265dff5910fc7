"""Which texts convert to which declared type, and how long the converted text is.

Declared types are the names an import sheet uses (``varchar(16)``, ``money`` ...). Each type
becomes two native expressions: the value's text after conversion (NULL when it does not
convert). Dates are read in ISO forms only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type names the reference's server knows, by how their text is checked.
INTEGERS = {"tinyint": (0, 255), "smallint": (-(2**15), 2**15 - 1), "int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}
DECIMALS = ("decimal", "numeric")
MONEY = {"money": "922337203685477.5807", "smallmoney": "214748.3647"}
FLOATS = ("float", "real")
TEXTS = ("varchar", "char", "nvarchar", "nchar", "text", "ntext", "sysname")
DATES = ("date", "datetime", "smalldatetime", "datetime2", "time")
DEFAULT_TEXT_SIZE, SYSNAME_SIZE = 30, 128
TEXT_LENGTH = {"date": 10, "datetime": 19, "smalldatetime": 19, "datetime2": 27, "time": 16}
DATE_RANGE = {"datetime": ("1753-01-01", "9999-12-31"), "smalldatetime": ("1900-01-01", "2079-06-06")}
KNOWN = (*INTEGERS, *DECIMALS, *MONEY, *FLOATS, *TEXTS, *DATES, "bit", "uniqueidentifier")


@dataclass(frozen=True)
class DeclaredType:
    """A type name with its size, both read from the declaration itself."""

    full: str
    name: str
    size: str  # digits before the comma, "0" when none are given
    digits: str | None  # digits after the comma

    @classmethod
    def parse(cls, text: str) -> DeclaredType:
        full = text.strip().lower()
        m = re.fullmatch(r"([a-z_0-9]+)\s*(?:\(\s*(\w+)\s*(?:,\s*(\d+)\s*)?\))?", full)
        if not m:
            return cls(full, full, "0", None)
        return cls(full, m[1], m[2] or "0", m[3])

    @property
    def known(self) -> bool:
        return self.name in KNOWN


def text_length(value: Column) -> Column:
    """Length without trailing blanks; NULL counts 0."""
    return F.length(F.rtrim(F.coalesce(value, F.lit(""))))


def _decimal(value: Column, precision: int, scale: int) -> Column:
    trimmed = F.trim(value)
    number = F.when(trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), trimmed)
    # the cast reads all digits, rounds half away from zero to the scale and checks for room
    return number.try_cast(f"decimal({precision},{scale})")


def _float_text(value: Column, kind: str) -> Column:
    trimmed = F.trim(value)
    shaped = F.when(trimmed == "", F.lit("0")).when(trimmed.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), trimmed)
    number = shaped.try_cast("float" if kind == "real" else "double")
    number = F.when(~number.isin(float("inf"), float("-inf")), number).cast("double")
    plain = F.format_string("%.6g", number)
    size = F.abs(number)
    exponent = F.regexp_extract(F.format_string("%.5e", number), r"e([+-])(\d+)$", 2)
    sign = F.regexp_extract(F.format_string("%.5e", number), r"e([+-])(\d+)$", 1)
    mantissa = F.regexp_replace(F.regexp_extract(F.format_string("%.5e", number), r"^(.*)e", 1), r"\.?0+$", "")
    science = F.concat(mantissa, F.lit("e"), sign, F.lpad(exponent, 3, "0"))
    fixed = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    fixed = F.when(size == 0, F.lit("0")).otherwise(fixed)
    return F.when(number.isNull(), F.lit(None).cast("string")).otherwise(
        F.when((size != 0) & ((size < 1e-4) | (size >= 1e6)), science).otherwise(fixed)
    )


def _moment(value: Column, kind: str) -> Column:
    trimmed = F.trim(value)
    clock = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,7})?)?"
    day = r"(\d{4}-\d{2}-\d{2}|\d{8})"
    shaped = trimmed.rlike(rf"^({day}([T ]{clock})?|{clock})$")
    dashed = F.regexp_replace(F.substring(trimmed, 1, 10), r"^(\d{4})(\d{2})(\d{2}).*$", "$1-$2-$3")
    date = F.when(trimmed.rlike(rf"^{day}"), dashed.try_cast("date")).otherwise(F.lit("1900-01-01").cast("date"))
    if kind in DATE_RANGE:
        low, high = DATE_RANGE[kind]
        date = F.when(date.between(F.lit(low).cast("date"), F.lit(high).cast("date")), date)
    return F.when(trimmed == "", F.lit("1900-01-01").cast("date")).when(shaped, date)


def converted_text(value: Column, declared: DeclaredType) -> Column:
    """The text of ``value`` after conversion, NULL where it does not convert."""
    name, nothing = declared.name, F.lit(None).cast("string")
    trimmed = F.trim(value)
    if name in INTEGERS:
        low, high = INTEGERS[name]
        whole = F.when(trimmed == "", F.lit("0")).when(trimmed.rlike(r"^[+-]?\d+$"), trimmed)
        number = whole.try_cast("decimal(38,0)")
        return F.when(number.between(F.lit(low).cast("decimal(38,0)"), F.lit(high).cast("decimal(38,0)")), number.cast("string"))
    if name in DECIMALS:
        precision = 18 if declared.size == "0" else int(declared.size)
        return _decimal(value, precision, int(declared.digits or 0)).cast("string")
    if name in MONEY:
        bare = F.regexp_replace(trimmed, r"^([+-]?)\s*[$€£]?", "$1")
        number = _decimal(F.when(bare == "", F.lit("0")).otherwise(F.replace(bare, F.lit(","), F.lit(""))), 38, 4)
        limit = F.lit(MONEY[name]).cast("decimal(38,4)")
        return F.when(F.abs(number) <= limit, F.round(number, 2).cast("decimal(38,2)").cast("string"))
    if name in FLOATS:
        return _float_text(value, name)
    if name in TEXTS:
        if name in ("text", "ntext") or declared.size == "max":
            return value
        size = SYSNAME_SIZE if name == "sysname" else DEFAULT_TEXT_SIZE if declared.size == "0" else int(declared.size)
        return F.substring(value, 1, size)
    if name in DATES:
        return F.when(_moment(value, name).isNotNull(), F.lit("x" * TEXT_LENGTH[name]))
    if name == "bit":
        word = F.lower(trimmed)
        return F.when(word.isin("true", "") | word.rlike(r"^[+-]?\d+$") | (word == "false"), F.lit("1"))
    if name == "uniqueidentifier":
        guid = r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
        return F.when(value.rlike(rf"^({guid}|\{{{guid}\}})"), F.lit("x" * 36))
    return nothing
