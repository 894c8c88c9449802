"""Calendar keys on zone-less timestamps; no expression depends on the session zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_to_ts(seconds: Column) -> Column:
    """Unix seconds to a zone-less UTC timestamp."""
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, seconds.cast("decimal(18,6)")
    )


def ntz(text: str) -> Column:
    """Timestamp literal without zone."""
    return F.lit(text).cast("timestamp_ntz")


def day_of(col: Column) -> Column:
    return col.cast("date")


def month_end(col: Column) -> Column:
    """Last day of the calendar month, the label of month tables."""
    return F.last_day(day_of(col))


def with_calendar(df: DataFrame, time: str = "valid_time", day: str = "date") -> DataFrame:
    """Add day, month and year keys."""
    t = F.col(time)
    return df.withColumns({day: day_of(t), "month": F.month(t), "year": F.year(t)})


def month_label(month: Column) -> Column:
    """Three-letter English label of a month number, whatever the locale."""
    from isograd.catalog import MONTH_ABBR

    return F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR]), month.cast("int"))


def is_monsoon(month: Column) -> Column:
    from isograd.catalog import MONSOON_MONTHS

    return month.isin(*MONSOON_MONTHS)


def season(month: Column) -> Column:
    """Two-class season label of a month number."""
    from isograd.catalog import MONSOON_LABEL, OTHER_LABEL

    return F.when(is_monsoon(month), F.lit(MONSOON_LABEL)).when(month.isNotNull(), F.lit(OTHER_LABEL))
