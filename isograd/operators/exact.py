"""Means that do not depend on the order in which rows are added.

Sums of doubles change in their last places with the order of the rows, and so
with the layout of a grid.  Here each value is cut once into two integers, a
coarse and a fine one; integers add exactly in any order, and one division at
the end gives the mean.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isograd.catalog import TIME
from isograd.operators.layout import Layout
from isograd.operators.spatial import latitude_weight

#: Binary places of the coarse integer, and further ones of the fine integer.
COARSE, FINE = 8, 30
#: Values must be smaller than this, and a group must have at most so many rows, for sums to fit 64 bits.
LIMIT, MOST_ROWS = 2.0**25, 2**29


def limbs(value: Column) -> tuple[Column, Column]:
    """A value as ``coarse * 2^-8 + fine * 2^-38``; what is smaller is cut off, in the same way for every order.

    Float32 values of magnitude 2^-14 or more, and 0, are held exactly.
    """
    scaled = value.cast("double") * F.lit(2.0**COARSE)
    too_large = F.raise_error(F.concat(F.lit("too large for an exact sum: "), value.cast("string"))).cast("double")
    fitting = F.when(value.isNull() | (F.abs(value) < LIMIT), scaled).otherwise(too_large)
    coarse = F.floor(fitting)
    return coarse, F.floor((fitting - coarse) * F.lit(2.0**FINE))


def _total(name: str) -> Column:
    """The sum in units of 2^-38 as a decimal: 64 + 30 bits at most."""
    return F.col(f"{name}_coarse").cast("decimal(20,0)") * F.lit(2**FINE).cast("decimal(10,0)") + F.col(f"{name}_fine").cast("decimal(20,0)")


def exact_sums(df: DataFrame, values: Mapping[str, Column], by: Sequence[str]) -> DataFrame:
    """``<name>_coarse``, ``<name>_fine``, ``<name>_n`` of every value; such rows can be added up further."""
    cut = {name: limbs(v) for name, v in values.items()}
    cells = df.select(*by, *[c.alias(f"{name}_{part}") for name, two in cut.items() for c, part in zip(two, ("coarse", "fine"), strict=True)])
    return add_sums(cells.withColumns({f"{name}_n": F.when(F.col(f"{name}_coarse").isNotNull(), 1).otherwise(0).cast("long") for name in values}), list(values), by)


def add_sums(sums: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows of ``exact_sums`` added up by another key."""
    rows = [F.sum(f"{name}_n").alias(f"{name}_n") for name in names]
    parts = [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for name in names for part in ("coarse", "fine")]
    added = sums.groupBy(*by).agg(*parts, *rows)
    many = F.raise_error(F.lit(f"more than {MOST_ROWS} rows in one exact sum")).cast("long")
    return added.withColumns({f"{name}_n": F.when(F.col(f"{name}_n") <= MOST_ROWS, F.col(f"{name}_n")).otherwise(many) for name in names})


def exact_means(sums: DataFrame, names: Sequence[str], by: Sequence[str], weights: Mapping[str, str] | None = None) -> DataFrame:
    """One division for each mean: by the number of rows, or by the sum named in ``weights``."""
    out = []
    for name in names:
        if weights and name in weights:
            mean = F.try_divide(_total(name).cast("double"), _total(weights[name]).cast("double"))
        else:
            mean = F.try_divide(_total(name).cast("double"), F.col(f"{name}_n") * F.lit(2.0 ** (COARSE + FINE)))
        out.append(mean.alias(name))
    return sums.select(*by, *out)


def exact_spatial_mean(df: DataFrame, variables: Sequence[str], weighted: bool = True, by: Sequence[str] = (TIME,)) -> DataFrame:
    """Mean over all cells of a step, plain or weighted by area; missing cells drop out with their weights."""
    if not weighted:
        return exact_means(exact_sums(df, {v: F.col(v) for v in variables}, by), variables, by)
    w = latitude_weight()
    values = {v: F.col(v) * w for v in variables} | {f"_w_{v}": F.when(F.col(v).isNotNull(), w) for v in variables}
    return exact_means(exact_sums(df, values, by), variables, by, {v: f"_w_{v}" for v in variables})


def same_under_layouts(df: DataFrame, layouts: Mapping[str, Layout], reduce_fn, key: str) -> DataFrame:
    """The result of a reduction, and for every row whether it is the same to the last bit under every layout."""
    results = None
    for name, tile in layouts.items():
        one = reduce_fn(tile(df)).withColumn("_layout", F.lit(name))
        results = one if results is None else results.unionByName(one)
    values = [c for c in results.columns if c not in (key, "_layout")]
    alike = F.count(F.lit(1)) == len(layouts)
    for c in values:
        alike = alike & (F.min(c).eqNullSafe(F.max(c))) & F.count(c).isin(0, len(layouts))
    return results.groupBy(key).agg(*[F.max(c).alias(c) for c in values], alike.alias("same"))
