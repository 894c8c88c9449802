"""Order MinHash: fingerprints of texts that follow the edit distance.

The k-mers of a text (``K`` code points; a shorter text is one k-mer) are
numbered by occurrence, so that repeated ones count apart, and hashed to 64
bits.  Each of ``ORDERS`` orders ranks them by the distance of their hash above
the order's seed, round the circle of 64-bit numbers: for random hashes every
such order is a random one, and the least k-mers of all orders are found by
binary search in one sorted list.  Of each order the ``TUPLE`` least k-mers are
put back into text order and hashed together to 32 bits.  Two texts agree in an
order if they share its least k-mers and have them in the same order; the share
of orders in which they agree is their likeness.

A null text counts as empty; empty texts have no k-mers and a fingerprint of
their own.  Very long texts are read whole (about 100 bytes of memory for each
of their bytes).  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm.storage import shuffle_partitions
from isograd.llm.text import Spans, annotate, mix, pieces, repeats

K = 6
TUPLE = 2
ORDERS = 64
#: Sampled rows for each cut between buckets; cuts steer where rows go, not what comes out.
SAMPLED = 64

_STEP = np.uint64(0xD6E8FEB86659FD93)
SEEDS = np.arange(ORDERS, dtype=np.uint64) * np.uint64((1 << 64) // ORDERS) + np.uint64(0x1F83D9ABFB41BD6B % ((1 << 64) // ORDERS))


def numbered_kmers(data: np.ndarray, offsets: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-numbered k-mers of every text, in text order, and where each text's begin."""
    docs = len(offsets) - 1
    points = np.flatnonzero((data & 0xC0) != 0x80)
    begin = np.searchsorted(points, offsets)
    size = np.diff(begin)
    doc = np.repeat(np.arange(docs), size)
    count = np.maximum(size - k + 1, np.minimum(size, 1))
    at = np.flatnonzero(np.arange(len(points)) - begin[doc] < count[doc])
    of, bound = doc[at], np.append(points, len(data))
    after = at + k
    ends = np.where(after < begin[of + 1], bound[np.minimum(after, len(points))], offsets[of + 1])
    hashes = Spans(data).hash(points[at], ends)
    salted = hashes ^ mix(np.arange(1, docs + 1, dtype=np.uint64))[of]
    double, _ = repeats(salted)
    if len(double):
        double = double[np.argsort(salted[double], kind="stable")]
        same = salted[double]
        first = np.maximum.accumulate(np.where(np.concatenate([[True], same[1:] != same[:-1]]), np.arange(len(same)), 0))
        occurrence = (np.arange(len(same)) - first).astype(np.uint64)
        hashes[double] = mix(hashes[double] + occurrence * _STEP)
    return hashes, np.concatenate([[0], np.cumsum(count)])


def sketch(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``ORDERS`` 32-bit values for each text."""
    hashes, begin = numbered_kmers(data, offsets)
    docs, following = len(offsets) - 1, np.arange(TUPLE)
    least = np.zeros((docs, ORDERS, TUPLE), dtype=np.int64)
    edges = begin.tolist()
    for i in range(docs):
        a, b = edges[i], edges[i + 1]
        if a < b:
            mine = hashes[a:b]
            order = np.argsort(mine)
            above = np.searchsorted(mine[order], SEEDS)
            least[i] = order[(above[:, None] + following) % (b - a)] + a
    least.sort(axis=2)
    out = np.zeros((docs, ORDERS), dtype=np.uint64)
    if len(hashes):
        for j in range(TUPLE):
            out = mix(out * _STEP + hashes[least[:, :, j]])
    out[np.diff(begin) == 0] = 0
    return (out >> np.uint64(32)).astype(">u4")


def as_text(sketches: np.ndarray) -> list[str]:
    """Sketches in lowercase hex."""
    return [row.tobytes().hex() for row in sketches]


def fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with a struct: ``n_chars`` and the ``fingerprint`` of the text; one pass, no shuffle."""
    fields = T.StructType([T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])

    def measure(data, offsets):
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        return {"n_chars": np.diff(chars), "fingerprint": as_text(sketch(data, offsets))}

    return annotate(docs, text, into, fields, lambda: measure)


def likeness(a: str | Column, b: str | Column) -> Column:
    """Share of orders in which two fingerprints agree."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    equal = lambda i: (F.substr(a, 8 * i + 1, F.lit(8)) == F.substr(b, 8 * i + 1, F.lit(8))).cast("int")
    return F.aggregate(F.sequence(F.lit(0), F.lit(ORDERS - 1)), F.lit(0), lambda s, i: s + equal(i)) / F.lit(float(ORDERS))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many of the first code points of another, or all of them."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


RESULT = [
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
]


def _sketches(texts: list[str]) -> np.ndarray:
    held = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(held), dtype=np.uint8)
    return sketch(data, np.concatenate([[0], np.cumsum([len(t) for t in held])]).astype(np.int64))


class _Line:
    """Documents in order: each waits until the next one of its bucket is seen."""

    def __init__(self):
        self.held: list | None = None  # [bucket, guest, key, text hash, text, copies, sketch]

    def judge(self, rows: list[tuple]) -> tuple[list, list[tuple]]:
        """Keys and results of the documents whose follower is known, one for each copy."""
        line = [self.held] if self.held else []
        fresh = len(line)
        for row in rows:
            if line and tuple(line[-1][:4]) == row[:4]:
                line[-1][5] += 1
            else:
                line.append([*row, 1, None])
        for item, found in zip(line[fresh:], _sketches([x[4] for x in line[fresh:]]), strict=True):
            item[6] = found
        pairs = [(a, b) for a, b in zip(line[:-1], line[1:], strict=True) if not a[1]]
        self.held = line[-1]
        texts = [edited(a[4], b[4]) for a, b in pairs]
        keys, out = [], []
        for (a, b), text, after in zip(pairs, texts, _sketches(texts), strict=True):
            near = [float(np.mean(a[6] == other)) for other in (after, b[6])]
            value = (len(a[4]), hashlib.sha256(text.encode()).hexdigest(), a[6].tobytes().hex(), after.tobytes().hex(), *near)
            keys.extend([a[2]] * a[5])
            out.extend([value] * a[5])
        return keys, out


def _place(key: tuple) -> tuple:
    return (key[0] is not None, key[0], key[1]) if key[0] is not None else (False, 0, key[1])


class Cuts:
    """Where the ordered documents are cut into buckets, from a sample of their keys.

    A key that fills several buckets, because a large share of all rows are
    copies of one document, is dealt out over them.
    """

    def __init__(self, sample: list[tuple], buckets: int):
        ordered = sorted(map(_place, sample))
        self.cuts = [ordered[len(ordered) * i // buckets] for i in range(1, buckets)] if ordered else []

    def bucket(self, key: tuple, row: int) -> int:
        """Twice the bucket of a row, and one more for a key that has several."""
        place = _place(key)
        high = bisect_right(self.cuts, place)
        low = bisect_left(self.cuts, place, 0, high)
        return 2 * high if high - low < 2 else 2 * (low + 1 + row % (high - low)) + 1


def _guests(spans: list[tuple[int, tuple, tuple]]) -> list[tuple[tuple, int]]:
    """For every bucket the first key after its last one, in circular order; from (bucket code, least, greatest key)."""
    starts = sorted({least for _, least, _ in spans}, key=_place)
    places = [_place(k) for k in starts]
    last: dict[int, tuple] = {}
    for code, _, greatest in spans:
        bucket = code // 2
        last[bucket] = max(last.get(bucket, greatest), greatest, key=_place)
    return [(starts[bisect_right(places, _place(key)) % len(starts)], bucket) for bucket, key in last.items()]


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, fingerprint, that of an edit of the text with its follower's, and the likeness to both.

    The follower of a document is the next one by ascending key, of the last
    one the first.  Null keys come first; documents with one key are ordered
    by a hash of their text; rows that repeat key and text are one document
    and get equal results.  Other columns are not read.

    Rows are dealt to buckets of the ordered keys in one shuffle.  Each bucket
    gets a copy of the one document that follows its last, so no bucket waits
    for another, and each task reads its rows in order, a megabyte of text at a
    time.  What the driver sees is a sample of keys and two keys of each bucket.
    """
    spark = docs.sparkSession
    t = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(key).alias("k"), F.xxhash64(t).alias("h"), t.alias("t"))
    kind = keyed.schema["k"].dataType
    tasks = shuffle_partitions(spark)
    buckets = 4 * tasks
    share = min(1.0, buckets * SAMPLED / max(1, docs.count()))
    cuts = Cuts([tuple(r) for r in keyed.select("k", "h").sample(share, seed=17).collect()], buckets)

    @F.arrow_udf("int")
    def bucket(k: pa.Array, h: pa.Array, row: pa.Array) -> pa.Array:
        keys = zip(k.to_pylist(), h.to_pylist(), strict=True)
        return pa.array([cuts.bucket(x, i) for x, i in zip(keys, row.to_pylist(), strict=True)], pa.int32())

    code = bucket("k", "h", F.monotonically_increasing_id())
    place = F.struct("k", "h")
    spans = keyed.select("k", "h").withColumn("b", code).groupBy("b").agg(F.min(place).alias("least"), F.max(place).alias("most"))
    guests = _guests([(r.b, tuple(r.least), tuple(r.most)) for r in spans.collect()] or [])
    asked = T.StructType([T.StructField("gk", kind), T.StructField("gh", T.LongType()), T.StructField("b", T.IntegerType())])
    listed = spark.createDataFrame([(*k, b) for k, b in guests], asked)  # one row for each bucket
    names = F.broadcast(listed.select("gk", "gh").distinct())
    found = keyed.join(names, F.col("k").eqNullSafe(F.col("gk")) & (F.col("h") == F.col("gh"))).groupBy("k", "h").agg(F.first("t").alias("t"))
    invited = found.join(F.broadcast(listed), F.col("k").eqNullSafe(F.col("gk")) & (F.col("h") == F.col("gh")))
    rows = keyed.withColumn("b", F.floor(code / 2).cast("int")).select("b", F.lit(0).alias("g"), "k", "h", "t")
    rows = rows.unionAll(invited.select("b", F.lit(1).alias("g"), "k", "h", "t"))
    ordered = rows.repartition(tasks, "b").sortWithinPartitions("b", "g", "k", "h")
    schema = T.StructType([T.StructField(key, kind), *RESULT])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = _Line()
        for batch in batches:
            for part, _, _ in pieces(batch, "t"):
                keys, values = line.judge(list(zip(*[c.to_pylist() for c in part.columns], strict=True)))
                held = list(zip(*values, strict=True)) or [[]] * len(RESULT)
                columns = [pa.array(keys, part.schema.field("k").type), pa.array(held[0], pa.int64())]
                columns += [pa.array(c, pa.string()) for c in held[1:4]] + [pa.array(c, pa.float64()) for c in held[4:]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return ordered.mapInArrow(judged, schema)
