"""Naming and rounding of whole column sets (driver-side metadata only)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]


def round_columns(df: DataFrame, digits: int = 4, columns: Sequence[str] | None = None) -> DataFrame:
    """Round floating columns (half up); a negative zero becomes zero."""
    chosen = set(float_columns(df) if columns is None else columns)
    return df.selectExpr(
        *[f"round(`{c}`, {digits}) + 0.0D AS `{c}`" if c in chosen else f"`{c}`" for c in df.columns]
    )


def suffix_columns(df: DataFrame, suffix: str, columns: Iterable[str]) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in columns})


def unit_name(variable: str, unit: str) -> str:
    """Column name with an ASCII unit suffix, e.g. ``ssr`` in ``W m⁻²`` becomes ``ssr_Wm2``."""
    plain = unit.replace("²", "2")
    return variable + "_" + "".join(ch for ch in plain if ch.isascii() and ch.isalnum())
