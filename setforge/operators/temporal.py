"""Effective-dated rows: latest row on a date, rows active on a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: last day of the small date type, used by the reference as "no end".
OPEN_END = "2079-06-06"


def latest_as_of(df: DataFrame, keys: Sequence[str], ts: str, date: Column | None = None) -> DataFrame:
    """All rows that carry the newest ``ts`` (not after ``date``) of their key; ties all stay.

    The newest stamp per key is a partial aggregate, and the join back is on (key, stamp).
    A hot key is therefore combined map-side and, on the way back, spread over its stamps,
    which a rank window over the key could not do.
    """
    past = df if date is None else df.filter(F.col(ts) <= date)
    newest = past.groupBy(*keys).agg(F.max(ts).alias(ts))
    return past.join(newest, [*keys, ts]).select(*df.columns)


def latest_one(df: DataFrame, keys: Sequence[str], ts: str, date: Column | None = None) -> DataFrame:
    """Same for data where (keys, ts) is unique: one aggregate, no join."""
    past = df if date is None else df.filter(F.col(ts) <= date)
    rest = [c for c in df.columns if c not in keys]
    picked = past.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ts)).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def active_on(
    df: DataFrame, date: Column, begin: str, end: str, grace_days: int = 0, null_end: str = "never"
) -> DataFrame:
    """Rows whose period holds ``date``; ``grace_days`` keeps rows that ended that recently.

    ``null_end``: "never" drops rows without an end, "open" keeps them, "sentinel" reads the
    missing end as the last day of the small date type (also open until then).
    """
    if null_end not in ("never", "open", "sentinel"):
        raise ValueError(f"null_end: {null_end}")
    last = F.col(end)
    if null_end == "open":
        last = F.coalesce(last, date)
    elif null_end == "sentinel":
        last = F.coalesce(last, F.lit(OPEN_END).cast("date"))
    return df.filter(date.between(F.col(begin), F.date_add(last, grace_days) if grace_days else last))


def started(df: DataFrame, column: str, date: Column) -> DataFrame:
    """Rows whose start date has come; a missing start never comes."""
    return df.filter(F.col(column) <= date)


def opt_eq(df: DataFrame, column: str, value=None) -> DataFrame:
    """Filter by equality only when a value is given."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))
