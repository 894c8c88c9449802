"""Combining tables that share a key.

Keys of grids and result tables are unique, so combining is a matter of putting
the rows of equal key side by side.  The tables are stacked and grouped once,
so that a repeated key is reported instead of multiplying rows as a join would.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isograd.catalog import COORDS, TIME
from isograd.functions.columns import suffix_columns


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; variables a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def merge_on_keys(
    tables: Sequence[DataFrame],
    keys: Sequence[str],
    how: str = "full",
    overlap: str = "no_conflicts",
    cells: bool = False,
) -> DataFrame:
    """Combine tables on unique keys, in one shuffle at most.

    Tables grouped by the same keys before are already partitioned by them and
    meet without a shuffle.  Stored ``cells`` are shuffled first and grouped
    where they arrive: with at most one row per key and table, aggregating
    before the shuffle would build large hash tables and save nothing.

    ``how`` is ``full`` (every key), ``inner`` (keys of all tables) or ``left``
    (keys of the first).  A variable held by several tables is filled from
    whichever has it and must agree where more than one does
    (``no_conflicts``), or is taken from the first table only (``override``).
    A key that occurs twice in one table is an error.
    """
    if how not in ("full", "inner", "left"):
        raise ValueError(f"how must be 'full', 'inner' or 'left', not {how!r}")
    if overlap not in ("no_conflicts", "override"):
        raise ValueError(f"overlap must be 'no_conflicts' or 'override', not {overlap!r}")

    holders: dict[str, int] = {}
    parts = []
    for i, table in enumerate(tables):
        values = [c for c in table.columns if c not in keys]
        if overlap == "override":
            values = [c for c in values if c not in holders]
        for c in values:
            holders[c] = holders.get(c, 0) + 1
        parts.append(table.select(*keys, *values, F.lit(i).alias("_table")))

    counts = [f"_rows{i}" for i in range(len(parts))]
    shared = [c for c, n in holders.items() if n > 1]
    stacked = stack(parts).repartition(*keys) if cells else stack(parts)
    grouped = stacked.groupBy(*keys).agg(
        *[F.count(F.when(F.col("_table") == i, 1)).alias(c) for i, c in enumerate(counts)],
        *[F.max(c).alias(c) for c in holders],
        *[F.min(c).alias("_min_" + c) for c in shared],
    )

    def every(conditions):
        return reduce(lambda a, b: a & b, conditions)

    unique = every(F.col(c) <= 1 for c in counts)
    keep = F.assert_true(unique, "a key occurs more than once in one table").isNull()
    if shared:
        agree = every(F.col(c).eqNullSafe(F.col("_min_" + c)) for c in shared)
        keep = keep & F.assert_true(agree, "tables disagree on a shared variable").isNull()
    if how == "inner":
        keep = keep & every(F.col(c) == 1 for c in counts)
    elif how == "left":
        keep = keep & (F.col(counts[0]) == 1)
    return grouped.where(keep).select(*keys, *holders)


def _cells(grid: DataFrame) -> DataFrame:
    """Grid without the partition columns of its storage; they follow from the time."""
    return grid.drop("year", "month")


def merge_steps(instant: DataFrame, accum: DataFrame, how: str = "full", overlap: str = "override") -> DataFrame:
    """Merge the two step types of a dataset cell by cell.

    Needed only for questions about single cells.  When means over space are
    wanted, ``spatial.regional_series`` reduces both step types without it.
    """
    return merge_on_keys([_cells(instant), _cells(accum)], COORDS, how=how, overlap=overlap, cells=True)


def combine_grids(tables: Sequence[DataFrame], disjoint: bool = False) -> DataFrame:
    """Open several grids as one; they must agree wherever they overlap.

    Files known to hold different times need no comparison (``disjoint``) and
    then no shuffle either.
    """
    if disjoint:
        return stack(tables)
    return merge_on_keys([_cells(t) for t in tables], COORDS, how="full", overlap="no_conflicts", cells=True)


def with_heat(daily: DataFrame, heat: DataFrame, key: str = "time") -> DataFrame:
    """Add the daily heat fractions to the days of the daily table."""
    return merge_on_keys([daily, heat], [key], how="left")


def pair_on_time(a: DataFrame, b: DataFrame, columns: Sequence[str], key: str = "time") -> DataFrame:
    """Rows of both tables with equal key, columns suffixed ``_a`` and ``_b``."""
    left = suffix_columns(a.select(key, *columns), "_a", columns)
    right = suffix_columns(b.select(key, *columns), "_b", columns)
    return merge_on_keys([left, right], [key], how="inner")


def common_keys(a: DataFrame, b: DataFrame, key: str = TIME) -> DataFrame:
    """Distinct keys found in both tables."""
    marked = a.select(key, F.lit(1).alias("_in_a"), F.lit(0).alias("_in_b")).unionAll(
        b.select(key, F.lit(0).alias("_in_a"), F.lit(1).alias("_in_b"))
    )
    return (
        marked.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("_in_a").alias("_in_a"), F.max("_in_b").alias("_in_b"))
        .where((F.col("_in_a") == 1) & (F.col("_in_b") == 1))
        .select(key)
    )


def common(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both tables cut down to their common numeric columns, and the column names."""
    from isograd.sources.guards import common_columns

    names = common_columns(a, b, exclude=[key])
    return a.select(key, *names), b.select(key, *names), names
