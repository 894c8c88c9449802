"""Near-duplicate classes by ProbMinHash, banding and verification.

Every element of a weighted set of word shingles is a Poisson process whose
rate is its weight; an arrival falls into one of the registers, and a register
keeps the element that came first.  A text stops when no further arrival can
come before the latest register.  Two texts agree in a register with their
probability Jaccard similarity.  Runs of registers are bands; texts that share
a band are candidates.  ``BANDS`` bands are of weights that grow with the
number of times a text repeats a shingle; ``UNIT_BANDS`` more, with arrivals of
their own, are of equal weights, so that texts which repeat their common
shingles unequally are found by their plain similarity.

Links are exact: the Jaccard similarity of the distinct shingles is computed
for candidate pairs and must reach ``similarity``.  Equal texts are gathered
first, so that only different texts are compared.  In each bucket all members
meet one, the member with the smallest share of rare shingles, which in a
group of copies is the closest to their origin.  Members of other components
then meet each other.  Both steps leave out pairs that cannot be similar:
shingles that no other candidate has are in no intersection, and rare ones,
which at most ``FEW`` candidates have, only in that of pairs found by them.
No link between members of a bucket is lost, and a bucket of copies costs no
more than its size.

Texts without a word, and rows without an id, are never linked.  A text of
fewer words than a shingle has one shingle.  Rows that share an id are one
document, whatever their texts.  Other columns are not read by
:func:`classes` and pass through :func:`one_of_each`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm.components import components
from isograd.llm.storage import free_names, stored
from isograd.llm.text import Spans, mix, ngrams, pieces, words

WORDS = 5
SIMILARITY = 0.8
BANDS = 12
UNIT_BANDS = 20
ROWS = 5
FEW = 16

_VALUE_BITS = 44
_PIECE = 1 << 18


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, 44-bit value and count of the distinct shingles of each text, by document and value."""
    starts, ends, doc = words(data, offsets)
    hashes = Spans(data).hash(starts, ends)
    value, at = ngrams(hashes, doc, width)
    values, docs = [value], [doc[at]]
    count = np.bincount(doc, minlength=len(offsets) - 1)
    for n in range(1, width):  # texts of fewer words: all of them are one shingle
        few = np.flatnonzero(count[doc] == n)
        value, at = ngrams(hashes[few], doc[few], n)
        values.append(value)
        docs.append(doc[few][at])
    low = np.concatenate(values) >> np.uint64(64 - _VALUE_BITS)
    key = (np.concatenate(docs).astype(np.uint64) << np.uint64(_VALUE_BITS)) | low
    key, times = np.unique(key, return_counts=True)
    return (key >> np.uint64(_VALUE_BITS)).astype(np.int64), key & np.uint64((1 << _VALUE_BITS) - 1), times


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, docs: int, registers: int, salt: int = 0) -> np.ndarray:
    """The element that came first in every register of every text (0 for texts without elements); another salt, other arrivals."""
    first = np.full(docs * registers, np.inf)
    winner = np.zeros(docs * registers, dtype=np.uint64)
    latest = np.full(docs, np.inf)
    time = np.zeros(len(doc))
    seed = mix(value + np.uint64(1 + (salt << 48)))
    round_ = 0
    while len(doc):
        round_ += 1
        draw = mix(seed + np.uint64(round_ * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log(((draw >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40) / weight
        early = time < latest[doc]
        doc, value, weight, seed, time, draw = doc[early], value[early], weight[early], seed[early], time[early], draw[early]
        at = doc * registers + (((draw & np.uint64(0xFFFFFF)) * np.uint64(registers)) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = value[won]
        left = doc[np.concatenate([[True], doc[1:] != doc[:-1]])] if len(doc) else doc
        latest[left] = first.reshape(docs, registers)[left].max(axis=1)
        stay = time < latest[doc]
        doc, value, weight, seed, time = doc[stay], value[stay], weight[stay], seed[stay], time[stay]
    return winner.reshape(docs, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int, first: int = 0) -> np.ndarray:
    """One 64-bit key for each band of each text; bands are numbered from ``first``."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(first + 1, first + bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, r])
    return key.view(np.int64)


def all_band_keys(doc: np.ndarray, value: np.ndarray, times: np.ndarray, docs: int, bands: int, unit_bands: int, rows: int) -> np.ndarray:
    """Keys of the weighted bands, then of those of equal weights."""
    weighted = band_keys(signatures(doc, value, 1 + np.log(times), docs, bands * rows), bands, rows)
    unit = band_keys(signatures(doc, value, np.ones(len(doc)), docs, unit_bands * rows, 1), unit_bands, rows, bands)
    return np.concatenate([weighted, unit], axis=1)


def _banded(docs: DataFrame, width: int, bands: int, unit_bands: int, rows: int) -> DataFrame:
    """``k``, ``d``, and the band keys of every text with a word (null otherwise)."""
    schema = T.StructType([*docs.select("k", "d").schema.fields, T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            for part, data, offsets in pieces(batch, "t", _PIECE):
                n = len(offsets) - 1
                doc, value, times = shingles(data, offsets, width)
                keys = all_band_keys(doc, value, times, n, bands, unit_bands, rows)
                full = np.bincount(doc, minlength=n) > 0
                ends = np.concatenate([[0], np.cumsum(np.where(full, bands + unit_bands, 0))])
                lists = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32), mask=np.concatenate([~full, [False]])), pa.array(keys[full].reshape(-1))
                )
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=schema.fieldNames())

    return docs.select("k", "d", "t").mapInArrow(run, schema)


def _packed(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(held: bytes) -> np.ndarray:
    wide = np.zeros((len(held) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(held, dtype=np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view(np.uint64)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``id`` and the packed sorted set of shingles of each text."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part, data, offsets in pieces(batch, "t", _PIECE):
                doc, value, _ = shingles(data, offsets, width)
                cuts = np.searchsorted(doc, np.arange(len(offsets)))
                held = _packed(value)
                sets = [held[6 * a : 6 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(sets, pa.binary())], names=["id", "s"])

    return docs.select("k", "t").mapInArrow(run, schema)


def _rare_shingles(sets: DataFrame) -> DataFrame:
    """``token``, ``id`` and ``df`` of the shingles that at most ``FEW`` rows of ``sets`` have."""
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("id", T.LongType())])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                held = [_unpacked(x.as_py()) for x in part.column(1)]
                identity = np.repeat(part.column(0).to_numpy(), [len(x) for x in held])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64)), pa.array(identity)], names=["token", "id"])

    tokens = sets.select("id", "s").mapInArrow(run, schema)
    rare = tokens.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") <= FEW)
    return tokens.join(rare.hint("merge"), "token")


def _counted(sets: DataFrame, rare: DataFrame) -> DataFrame:
    """``id``, ``n``, ``q`` and ``low``: shingles of each text, those nobody else has, and the rare ones (null: several texts)."""
    counts = rare.groupBy("id").agg(F.count_if(F.col("df") == 1).alias("q"), F.count("*").alias("low"))
    n = sets.groupBy("id").agg(F.when(F.count("*") == 1, F.max(F.octet_length("s") / 6).cast("long")).alias("n"))
    return n.join(counts, "id", "left").select("id", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("q", "low")])


def _possible(n1, q1, n2, q2, similarity: float, shared=0):
    """Whether sets of ``n`` shingles can be as similar, if of ``q`` of each only ``shared`` can be common."""
    common = F.least(n1 - q1, n2 - q2) + shared
    known = n1.isNotNull() & n2.isNotNull()
    return ~known | (common + 1e-6 >= similarity * (n1 + n2 - common))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b`` and the Jaccard similarity of their sets."""
    both = pairs.hint("merge").join(sets.select(F.col("id").alias("b"), F.col("s").alias("t")), "b").hint("merge")
    both = both.join(sets.select(F.col("id").alias("a"), "s"), "a")

    def run(batches):
        for batch in batches:
            found = []
            for s, t in zip(batch.column(2), batch.column(3), strict=True):
                x, y = _unpacked(s.as_py()), _unpacked(t.as_py())
                together = np.sort(np.concatenate([x, y]))
                common = int((together[1:] == together[:-1]).sum())
                found.append(common / max(1, len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["a", "b", "sim"])

    return both.select("a", "b", "s", "t").mapInArrow(run, "a long, b long, sim double")


def classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    width: int = WORDS,
    bands: int = BANDS,
    unit_bands: int = UNIT_BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row for each row of ``docs``: ``key`` (a long) and ``class_id``, the least key of its class."""
    own = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).withColumn("d", F.md5(F.coalesce("t", F.lit(""))))
    marked = stored(_banded(own, width, bands, unit_bands, rows), "bands")

    distinct = marked.where("k IS NOT NULL AND bands IS NOT NULL").groupBy("d").agg(F.min("k").alias("id"), F.first("bands").alias("bands"))
    member = distinct.select(F.explode("bands").alias("band"), "id")
    shared_bands = member.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("band")
    bucket = stored(member.join(shared_bands, "band").distinct(), "buckets")
    wanted = bucket.select(F.col("id").alias("k")).distinct()
    # One row for each different text of an id.
    sets = stored(_sets(own.join(wanted.hint("merge"), "k", "left_semi").dropDuplicates(["k", "d"]), width), "sets")
    known = stored(_counted(sets, _rare_shingles(sets)), "shingles")
    sized = stored(bucket.join(known, "id"), "sized")

    share = F.struct((F.col("low") / F.col("n")).alias("low"), (F.col("q") / F.col("n")).alias("q"), "id")
    middle = sized.groupBy("band").agg(F.min_by(F.struct("id", "n", "q"), share).alias("m"))
    star = sized.join(middle, "band").where(
        (F.col("id") != F.col("m.id")) & _possible(F.col("n"), F.col("q"), F.col("m.n"), F.col("m.q"), similarity)
    )
    star = star.select(F.least("id", "m.id").alias("a"), F.greatest("id", "m.id").alias("b")).distinct()

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        found = _verified(stored(pairs, name), sets).where(F.col("sim") >= similarity)
        return stored(found.select("a", "b").distinct(), f"{name}-links")

    links = linked(star, "star")
    found = components(links)

    # Members that some partner of their bucket could match, where they are of several components.
    least = sized.groupBy("band").agg(F.min("n").alias("least"))
    common = F.col("n") - F.col("q")
    could = common + 1e-6 >= similarity * (F.col("n") + F.greatest("least", common) - common)
    able = sized.join(least, "band").where(F.coalesce(could, F.lit(True)))
    able = able.join(found, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    mixed = able.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    able = stored(able.join(mixed, "band"), "able")
    # Shingles are counted anew among these; their rare ones give pairs, at most FEW members each.
    some = sets.join(able.select("id").distinct().hint("merge"), "id", "left_semi")
    rare = stored(_rare_shingles(some), "rare")
    of = _counted(some, rare).join(able.groupBy("id").agg(F.min("component").alias("component"), F.collect_list("band").alias("bands")), "id")
    of = stored(of, "of")
    together = rare.where("df > 1").groupBy("token").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    pairs = together.select(F.posexplode("ids").alias("at", "a"), "ids").select("a", F.explode(F.slice("ids", F.col("at") + 2, F.size("ids"))).alias("b"))
    pairs = pairs.where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    x, y = (of.select("id", "n", "low", "component").alias(c) for c in "xy")
    by_token = pairs.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id")).where(
        (F.col("x.component") != F.col("y.component"))
        & _possible(F.col("x.n"), F.col("x.low"), F.col("y.n"), F.col("y.low"), similarity, F.col("shared"))
    )
    member = able.select("band", "id").join(of, "id")
    x, y = member.alias("x"), member.alias("y")
    by_band = x.join(
        y,
        (F.col("x.band") == F.col("y.band")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
        & _possible(F.col("x.n"), F.col("x.low"), F.col("y.n"), F.col("y.low"), similarity)
        & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.band")),  # each pair once
    )
    rest = by_band.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).unionAll(by_token.select("a", "b")).distinct()
    more = linked(rest, "rest")
    if not more.isEmpty():
        found = components(links.unionAll(more))

    # Copies of a text, and the texts of an id, belong to one class.
    shared = marked.where("k IS NOT NULL AND bands IS NOT NULL").join(distinct.select("d", "id"), "d").select("k", "id").distinct()
    several = shared.groupBy("k").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select(F.col("k"))
    if not several.isEmpty():  # some id has different texts
        ties = shared.join(several, "k", "left_semi").select(F.col("k").alias("a"), F.col("id").alias("b"))
        found = components(links.unionAll(more).unionAll(ties))
        shared = shared.groupBy("k").agg(F.min("id").alias("id"))
    classed = shared.join(found, "id", "left").select("k", F.coalesce("component", "id").alias("class_id"))
    everyone = marked.select("k").join(classed, "k", "left")
    return everyone.select(F.col("k").alias(key), F.coalesce("class_id", "k").alias("class_id"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose key is their class; of rows that are equal in key and text, one; rows without a key all stay."""
    (class_,) = free_names(docs.columns, "__class")
    kept = classes(docs, key, text, **options).where(F.col(key) == F.col("class_id")).select(F.col(key).alias(class_)).distinct()
    chosen = docs.join(kept, F.col(key).cast("long") == F.col(class_), "left_semi").dropDuplicates([key, text])
    return chosen.unionAll(docs.where(F.col(key).isNull()))
