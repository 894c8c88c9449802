"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isograd.llm.storage import stored


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"] or 0


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, its least member, for every id of the links (``a``, ``b``).

    Each round hangs neighbours on the least one with an aggregation and a
    join on the node; links are written to the shared folder between rounds,
    until a round changes nothing.
    """
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, "links")
    state = _state(now)
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionAll(down.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
