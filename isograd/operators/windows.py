"""Anomalies, rolling means and other operators that look at neighbouring or grouped rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isograd.functions.columns import numeric_columns

BLOCK_ROWS = 65_536


def anomaly(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    time: str = "time",
    partition: Sequence[str] = (),
) -> DataFrame:
    """Deviation of each value from the mean of its month of the year, ``<column>_anom``.

    The means are an aggregation with map-side partials: a month may hold any
    share of the rows without one task sorting it, as a window over months
    would.  Without ``partition`` they are at most thirteen rows (twelve months
    and the missing time), which are broadcast, so no row of the table is
    shuffled by its month.  With ``partition`` (say, one climate per cell) the
    rows are dealt once, by partition and month, to meet their means; a hot
    cell is split there as a skewed join.  Rows whose partition is missing
    have no climate and stay null.
    """
    names = numeric_columns(df, exclude=[time, "month", "year", *partition]) if columns is None else list(columns)
    kept = df.select(time, *partition, *names)
    month = F.coalesce(F.month(time), F.lit(0))  # 0: the time is missing
    means = kept.groupBy(*[F.col(p).alias("_of_" + p) for p in partition], month.alias("_of_month")).agg(
        *[F.avg(c).alias("_mean_" + c) for c in names]
    )
    same = [F.col(p) == F.col("_of_" + p) for p in partition] + [month == F.col("_of_month")]
    return kept.join(means if partition else F.broadcast(means), same, "left").select(
        time, *partition, *[(F.col(c) - F.col("_mean_" + c)).alias(c + "_anom") for c in names]
    )


def month_index(time: Column | str) -> Column:
    """Months since year 0, a coarse key that grows with time."""
    return F.year(time) * 12 + F.month(time) - 1


def with_ordinal(
    df: DataFrame,
    order: str,
    bucket: Callable[[Column], Column] = month_index,
    name: str = "ordinal",
    partition: Sequence[str] = (),
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Row number from 0 along a unique ``order``, in each ``partition``, without sorting a series in one task.

    ``bucket`` turns the order into a coarse key that grows with it, calendar
    months by default.  Rows are numbered inside their bucket; the running
    total of the bucket sizes, one row per series and calendar month, gives
    each bucket its start.  Sizes that were stored with the table (see
    ``bucket_sizes``) are taken as they are; else they are counted, for cells
    over their keys alone, so that no other column is read for it.  A series
    without ``partition`` is a reduced table and is counted over whole rows,
    so that Spark serves both uses from the one shuffle that reduced it.  An
    order that repeats in a series is an error.
    """
    own = bucket(F.col(order))
    if sizes is None:
        sizes = bucket_sizes(df, order, bucket, partition, whole=not partition)
    before = W.partitionBy(*partition).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(p).alias("_of_" + p) for p in partition], "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = W.partitionBy(*partition, own).orderBy(order)
    numbered = df.withColumns({"_row": F.row_number().over(inside), "_same": F.lag(order).over(inside).eqNullSafe(F.col(order))})
    once = F.assert_true(~F.col("_same") | (F.col("_row") == 1), f"{order} occurs more than once in one series").isNull()
    match = [F.col(p).eqNullSafe(F.col("_of_" + p)) for p in partition] + [own.eqNullSafe(F.col("_bucket"))]
    return (
        numbered.where(once)
        .join(starts, match, "left")
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_bucket", "_row", "_same", "_start", *["_of_" + p for p in partition])
    )


def bucket_sizes(
    df: DataFrame, order: str, bucket: Callable[[Column], Column] = month_index, partition: Sequence[str] = (), whole: bool = False
) -> DataFrame:
    """``_bucket`` and its number of rows ``_n`` for every series; small enough to be stored beside a grid.

    ``whole`` keeps all columns of the table in the count, by a digest.
    """
    n, seen = F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns)).isNull()
    return df.groupBy(*partition, bucket(F.col(order)).alias("_bucket")).agg((F.when(seen, F.lit(0)).otherwise(n) if whole else n).alias("_n"))


def _guarded_mean(column: str, window, min_periods: int) -> Column:
    c = F.col(column)
    return F.when(F.count(c).over(window) >= min_periods, F.avg(c).over(window))


def rolling_mean(
    df: DataFrame,
    columns: Mapping[str, str],
    before: int,
    after: int,
    min_periods: int,
    order: str = "time",
    partition: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    bucket: Callable[[Column], Column] = month_index,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Mean over the rows ``-before .. +after``, null where fewer than ``min_periods`` are present.

    ``columns`` maps input to output names.  Rows are numbered, within each
    ``partition`` if one is given (say, one series per cell), cut into blocks
    of ``block_rows``, and each block is given copies of the few neighbouring
    rows its edge windows need, so that blocks are computed independently and
    no task sorts a whole series.  An order that repeats in a series is an
    error.
    """
    o, size = F.col("_ordinal"), F.lit(block_rows)
    first = F.floor(F.greatest(o - after, F.lit(0)) / size)
    last = F.floor((o + before) / size)
    numbered = with_ordinal(df, order, bucket, "_ordinal", partition, sizes)
    spread = numbered.withColumn("_block", F.explode(F.sequence(first, last)))
    w = W.partitionBy(*partition, "_block").orderBy("_ordinal").rowsBetween(-before, after)
    rolled = spread.withColumns({out: _guarded_mean(c, w, min_periods) for c, out in columns.items()})
    return rolled.where(F.col("_block") == F.floor(o / size)).drop("_block", "_ordinal")


def rolling15(df: DataFrame, column: str, name: str, order: str = "time", **kw) -> DataFrame:
    """Centred 15-row mean that needs seven present rows."""
    return rolling_mean(df, {column: name}, before=7, after=7, min_periods=7, order=order, **kw)


def rolling24(df: DataFrame, columns: Mapping[str, str], order: str = "valid_time", **kw) -> DataFrame:
    """Centred 24-row mean; the even width covers rows -12 to +11 and all must be present.

    Rows are counted, not hours: on 6-hourly data the window spans six days.
    """
    return rolling_mean(df, columns, before=12, after=11, min_periods=24, order=order, **kw)


def month_ticks(daily: DataFrame, time: str = "date") -> DataFrame:
    """Position of each day in its year and the axis label of days that open a month.

    Numbered from 0 within each year, so a group never exceeds 366 days.
    """
    w = W.partitionBy(F.year(time)).orderBy(time)
    month = month_index(time)
    changed = F.coalesce(month != F.lag(month).over(w), F.lit(True))
    return daily.withColumns(
        {
            "x": F.row_number().over(w) - 1,
            "month_start": changed,
            "tick_label": F.when(changed, F.concat_ws(" ", _month_name(time), F.year(time).cast("string"))),
        }
    )


def _month_name(time: str) -> Column:
    from isograd.functions.calendar import month_label

    return month_label(F.month(time))


def with_scalar(df: DataFrame, one_value: DataFrame, name: str) -> DataFrame:
    """Add the only value of a one-row, one-column table to every row, as a scalar subquery."""
    return df.withColumn(name, one_value.scalar())


def month_vs_annual(
    daily: DataFrame, column: str, also: Sequence[str] = (), time: str = "time", name: str | None = None
) -> DataFrame:
    """Month mean minus the mean of all daily values, with the month means of ``also``.

    The daily values are folded into a sum and a count per month; the mean of
    the year follows from the at most twelve month rows, so the daily table is
    read once.
    """
    monthly = daily.groupBy(F.month(time).alias("month")).agg(
        *[F.avg(c).alias(c) for c in (column, *also)], F.sum(column).alias("_sum"), F.count(column).alias("_n")
    )
    year = W.partitionBy()
    annual = F.try_divide(F.sum("_sum").over(year), F.sum("_n").over(year))
    return monthly.withColumn(name or column + "_vs_annual", F.col(column) - annual).drop("_sum", "_n")


def minmax_scale(months: DataFrame, columns: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """Scale columns of a month table (at most twelve rows) to [0, 1] by their own extremes."""
    year = W.partitionBy()
    lo = {c: F.min(c).over(year) for c in columns}
    hi = {c: F.max(c).over(year) for c in columns}
    return months.withColumns({c: (F.col(c) - lo[c]) / (hi[c] - lo[c] + F.lit(eps)) for c in columns})


def sign_bands(df: DataFrame, column: str, warm: str = "warm", cool: str = "cool") -> DataFrame:
    """Split a series into its non-negative and its negative part."""
    c = F.col(column)
    return df.withColumns({warm: F.when(c >= 0, c), cool: F.when(c < 0, c)})
