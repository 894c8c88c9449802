"""Agreement of two result tables, column by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isograd.functions.units import nan_to_null
from isograd.operators.align import common, pair_on_time


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Wide to long: one row per key and column."""
    return df.unpivot(list(keys), list(columns), name, value)


def paired_long(a: DataFrame, b: DataFrame, columns: Sequence[str], key: str, name: str) -> DataFrame:
    """One row per common key and column with the values of both tables as ``a`` and ``b``."""
    rows = [
        F.struct(
            F.lit(c).alias(name),
            nan_to_null(F.col(c + "_a").cast("double")).alias("a"),
            nan_to_null(F.col(c + "_b").cast("double")).alias("b"),
        )
        for c in columns
    ]
    return pair_on_time(a, b, columns, key).select(F.inline(F.array(*rows)))


def side_by_side(df: DataFrame, columns: Sequence[str], name: str, suffix: str = "", **labels: str | float) -> DataFrame:
    """The rows of ``paired_long`` from one table that holds both results, as ``<column>_a`` and ``<column>_b``.

    ``suffix`` follows these names, ``labels`` are constant columns.
    """
    rows = [
        F.struct(
            F.lit(c).alias(name),
            *[nan_to_null(F.col(f"{c}_{side}{suffix}").cast("double")).alias(side) for side in ("a", "b")],
            *[F.lit(v).alias(k) for k, v in labels.items()],
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*rows)))


def difference_report(pairs: DataFrame, name: str = "metric") -> DataFrame:
    """Rows compared, largest and mean absolute difference, by the column ``name``."""
    diff = F.abs(F.col("a") - F.col("b"))
    return pairs.groupBy(name).agg(F.count(F.lit(1)).alias("rows_compared"), F.max(diff).alias("max_abs_diff"), F.avg(diff).alias("mean_abs_diff"))


def consistency(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, key: str = "time") -> DataFrame:
    """Rows compared, largest and mean absolute difference of every common column asked for."""
    _, _, shared = common(a, b, key)
    names = [c for c in (shared if columns is None else columns) if c in shared]
    if not names:
        raise ValueError("the two tables have no comparable column in common")
    return difference_report(paired_long(a, b, names, key, "metric"))


def compare_tables(
    reference: DataFrame,
    candidate: DataFrame,
    key: str = "time",
    atol: float = 1e-3,
    rtol: float = 1e-3,
    label: str = "table",
) -> DataFrame:
    """Error measures and tolerance check per common numeric column.

    A value passes when ``|cand - ref| <= atol + rtol * |ref|``; two missing
    values agree, one missing value does not.  Error measures skip missing
    differences.  Columns are few and rows many, so the grouping relies on
    map-side partial aggregation: each task sends one row per column.
    """
    _, _, names = common(reference, candidate, key)
    if not names:
        raise ValueError(f"no overlapping columns for {label}")
    pairs = paired_long(reference, candidate, names, key, "column")
    return tolerance_report(pairs.select("*", *[F.lit(v).alias(c) for c, v in (("table", label), ("atol", atol), ("rtol", rtol))]))


def tolerance_report(pairs: DataFrame) -> DataFrame:
    """Error measures by ``table`` and ``column`` of pairs ``a``, ``b`` with the tolerances ``atol`` and ``rtol``."""
    ref, cand = F.col("a"), F.col("b")
    diff = F.abs(cand - ref)
    relative = diff / F.greatest(F.abs(ref), F.lit(1e-12))
    within = F.coalesce(ref.eqNullSafe(cand) | (diff <= F.col("atol") + F.col("rtol") * F.abs(ref)), F.lit(False))
    return pairs.groupBy("table", "column").agg(
        F.count(F.lit(1)).alias("rows_compared"),
        F.avg(diff).alias("mae"),
        F.max(diff).alias("max_abs"),
        F.sqrt(F.avg(diff * diff)).alias("rmse"),
        F.max(relative).alias("max_rel"),
        F.avg(within.cast("double")).alias("pass_rate"),
        F.bool_and(within).alias("passed"),
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def validation_rollup(report: DataFrame) -> DataFrame:
    """One row over all checks; the table names are as many as tables were compared."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.array_sort(F.collect_set("table")).alias("tables"),
        F.bool_and("passed").alias("all_passed"),
        F.min("pass_rate").alias("min_pass_rate"),
        F.max("max_abs").alias("max_abs_overall"),
        F.max("max_rel").alias("max_rel_overall"),
    )


def best_worst(runs: DataFrame, by: str = "elapsed_s", name: str = "name") -> DataFrame:
    """Fastest and slowest run."""
    return runs.agg(
        F.count(F.lit(1)).alias("runs"),
        F.min_by(name, by).alias("best"),
        F.min(by).alias("best_" + by),
        F.max_by(name, by).alias("worst"),
        F.max(by).alias("worst_" + by),
    )


def run_delta(runs: DataFrame, slow: str, fast: str, value: str, by: str = "elapsed_s", name: str = "name") -> DataFrame:
    """Speed-up of one run over another and how far their results are apart."""

    def of(run: str, column: str):
        return F.max(F.when(F.col(name) == run, F.col(column)))

    return runs.agg(
        F.round(of(slow, by) / F.greatest(of(fast, by), F.lit(1e-9)), 3).alias("speedup"),
        F.round(F.abs(of(slow, value) - of(fast, value)), 6).alias("value_abs_diff"),
    )
