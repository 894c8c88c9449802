"""Nested result documents read back and compared path by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF = "array<struct<path:string,number:double,text:string>>"


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document as written by ``write_summary``: one row, nested as it was."""
    return spark.read.json(path)


def _leaves(value: Column, kind: T.DataType, path: Column) -> Column:
    """All scalars below a value with their paths; the schema says how deep to go."""
    if isinstance(kind, T.StructType):
        parts = [_leaves(value.getField(f.name), f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind.fields]
        return F.flatten(F.array(*parts)) if parts else F.array().cast(LEAF)
    if isinstance(kind, T.ArrayType):
        each = F.transform(value, lambda x, i: _leaves(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.coalesce(F.flatten(each), F.array(_leaf(path, None, None)))
    if isinstance(kind, T.NumericType):
        return F.array(_leaf(path, value, None))
    return F.array(_leaf(path, None, value))


def _leaf(path: Column, number: Column | None, text: Column | None) -> Column:
    return F.struct(
        path.alias("path"),
        (F.lit(None) if number is None else number).cast("double").alias("number"),
        (F.lit(None) if text is None else text).cast("string").alias("text"),
    )


def leaves(document: DataFrame) -> DataFrame:
    """``path``, ``number`` and ``text`` of every scalar of a document; array items are named by their place.

    A missing array is one empty leaf, an array without items has none.
    """
    parts = [_leaves(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in document.schema.fields]
    whole = F.flatten(F.array(*parts)) if parts else F.array()
    return document.select(F.inline(whole.cast(LEAF)))


def document_diff(a: DataFrame, b: DataFrame, atol: float = 0.0, rtol: float = 0.0) -> DataFrame:
    """Two documents side by side: ``path``, both values, the difference of numbers, and a verdict.

    ``status`` is ``same`` (numbers within ``atol + rtol * |first|``, equal
    texts, or both missing), ``different``, ``first only`` or ``second only``
    (the path is not in the other document).  A number and a text differ.
    """
    one, other = (leaves(d).select("path", F.struct("number", "text").alias(side)) for d, side in ((a, "a"), (b, "b")))
    met = one.join(other, "path", "full")
    gap = F.abs(F.col("a.number") - F.col("b.number"))
    close = F.coalesce(gap <= F.lit(atol) + F.lit(rtol) * F.abs("a.number"), F.col("a.number").isNull() & F.col("b.number").isNull())
    alike = close & F.col("a.text").eqNullSafe(F.col("b.text"))
    status = F.when(F.col("b").isNull(), "first only").when(F.col("a").isNull(), "second only")
    return met.select(
        "path", F.col("a.number").alias("first"), F.col("b.number").alias("second"), F.col("a.text").alias("first_text"), F.col("b.text").alias("second_text"),
        gap.alias("difference"), status.when(alike, "same").otherwise("different").alias("status"),
    )
