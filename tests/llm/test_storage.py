"""Tables stored on the way: what tasks hand to Python at once."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm import storage, text

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest(df, kept):
    """Bytes of the largest batch that reaches Python."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes], "rows": [batch.num_rows]})

    found = kept(df.mapInArrow(run, "bytes long, rows long")).agg(F.max("bytes"), F.sum("rows")).first()
    return found[0], found[1]


def test_stored_tables_reach_python_in_batches_of_bytes(spark):
    long = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("abcd efgh "), 500).alias("t"))
    size, rows = largest(long, lambda df: storage.stored(df, "batches"))
    assert rows == 3000 and size <= 1.5 * storage.BATCH_BYTES < 3000 * 5000
    assert spark.conf.get(SETTING, None) is None  # only while the table is written


def test_a_setting_of_the_session_holds(spark):
    spark.conf.set(SETTING, "64k")
    try:
        size, rows = largest(spark.range(0, 500, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("t")), lambda df: storage.stored(df, "batches"))
        assert rows == 500 and size <= 2 * (64 << 10) and spark.conf.get(SETTING) == "64k"
    finally:
        spark.conf.unset(SETTING)


def test_measures_see_no_more_text_at_once_than_asked(spark):
    docs = spark.range(0, 40, 1, 1).select("id", F.repeat(F.lit("x"), 50_000).alias("t"))
    fields = T.StructType([T.StructField("seen", T.LongType())])
    got = text.annotate(docs, "t", "m", fields, lambda: lambda data, offsets: {"seen": [len(data)] * (len(offsets) - 1)}, size=1 << 18)
    assert {r.m.seen for r in got.collect()} == {250_000}
