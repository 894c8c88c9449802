"""Checks on inputs.  Column checks read metadata; emptiness checks run a one-row job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from isograd.functions.columns import numeric_columns


def available(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """Wanted columns that the table has, in the order wanted."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def common_columns(a: DataFrame, b: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns of both tables, in the order of the first."""
    other = set(numeric_columns(b, exclude))
    return [c for c in numeric_columns(a, exclude) if c in other]


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df


def require_nonempty(df: DataFrame, what: str = "table") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
