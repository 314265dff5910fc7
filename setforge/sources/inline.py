"""Literal rows as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float, Decimal)):
        return f"'{value}'"
    if isinstance(value, (date, datetime)):
        return f"'{value.isoformat(sep=' ') if isinstance(value, datetime) else value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def values(spark: SparkSession, rows: Sequence[Sequence], columns: Mapping[str, str]) -> DataFrame:
    """Rows known at plan time, kept in the plan itself (no job, no Python worker)."""
    names = ", ".join(f"`{n}`" for n in columns)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in columns.items())
        return spark.sql(f"SELECT {nulls} WHERE false")
    types = list(columns.values())
    body = ", ".join("(" + ", ".join(f"CAST({_literal(v)} AS {t})" for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
