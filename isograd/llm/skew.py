"""Meeting a table of unique keys whatever share of the other side a key has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from one ``HOT_KEYS``-th of all rows, so that at most so many keys are.
HOT_KEYS = 4096


def meet(rows: DataFrame, unique: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``unique``, which has each of the ``keys`` once, and in ``count`` the rows that carry it.

    Hot keys are at most ``HOT_KEYS``, by their definition, and are broadcast,
    so that their rows stay where they are; the others are joined by the keys.
    Read ``unique`` from storage: it is used three times.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    is_hot = F.col(count) > unique.agg(F.ceil(F.sum(count) / HOT_KEYS)).scalar()
    hot = F.broadcast(unique.where(is_hot))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(unique.where(~is_hot), keys, how)
    return rows.join(hot, keys).unionByName(rest)
