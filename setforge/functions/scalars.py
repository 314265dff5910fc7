"""Scalar rules where the reference's SQL dialect and Spark differ, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date styles by number.
DATE_STYLES = {104: "dd.MM.yyyy", 108: "HH:mm:ss", 120: "yyyy-MM-dd HH:mm:ss"}


def nullif0(value: Column) -> Column:
    """0 means "not given"."""
    return F.when(value != 0, value)


def end_to_zero(value: Column, ended: Column) -> Column:
    """The id of an ended rule becomes 0."""
    return F.when(ended, F.lit(0).cast("bigint")).otherwise(value)


def concat_skip_null(*values: Column) -> Column:
    """CONCAT: a NULL counts as an empty text."""
    return F.concat_ws("", *values)


def concat_strict(*values: Column) -> Column:
    """``+`` on texts: one NULL makes the whole NULL."""
    return F.concat(*values)


def styled(moment: Column, style: int) -> Column:
    return F.date_format(moment, DATE_STYLES[style])


def seconds_crossed(start: Column, end: Column) -> Column:
    """Whole-second boundaries between two moments (not the whole seconds elapsed)."""
    first, last = (F.date_trunc("second", c.cast("timestamp")) for c in (start, end))
    return F.unix_seconds(last) - F.unix_seconds(first)


def split_list(text: Column, separator: str = ",") -> Column:
    """The items of a delimited text, one row each."""
    return F.explode(F.split(text, r"\Q" + separator + r"\E"))
