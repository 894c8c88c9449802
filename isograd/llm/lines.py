"""Substring deduplication by hashing units of lines or paragraphs.

Units are normalised (ASCII lower case, words apart by one blank) and digested
to 128 bits.  Digests are grouped over all documents with partial aggregation
in the tasks, and the earliest ranked occurrence of each stays.  A passage may
begin inside a line, so lines are cut at sentence ends by default, and a
repeated unit goes only inside a run of neighbouring repeated units that has
``min_words`` words: a short line that many texts share is no passage.

Digests are stored once and read by the grouping and by the way back.  A
digest with more than a fixed share of all occurrences meets its earliest
place by broadcast (there are at most ``HOT_KEYS`` of these, whatever the
input); the others meet in a join on the digest.

Null texts have no units and stay null.  Units without a word are never
removed, and do not end a run.  Rows that repeat an id and a text are one
document and get equal results; rows that share an id but not the text are
told apart by the text.  Null ids rank first.  Other columns pass through; one
called like ``into`` is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm.storage import stored
from isograd.llm.text import SPACE, Spans, document_of, mix, pieces, words

#: A run of repeated units with fewer words stays.
MIN_WORDS = 30
#: A digest is hot from one ``HOT_KEYS``-th of all occurrences, so that at most so many are.
HOT_KEYS = 4096

UNITS = ("sentence", "line", "paragraph")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 32]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_WIDE_STOPS = ("。", "！", "？")
_SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FIELDS = T.StructType(
    [
        T.StructField("n_units", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()), T.StructField("removed", SPAN),
    ]
)


def _before(mask: np.ndarray) -> np.ndarray:
    """For each position the last position before it where ``mask`` holds, or -1."""
    at = np.where(mask, np.arange(len(mask)), -1)
    return np.concatenate([[-1], np.maximum.accumulate(at)[:-1]]) if len(mask) else at


def unit_starts(data: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """First byte of every unit; a unit ends with the break behind it and never crosses texts.

    Lines end with a line break, paragraphs with white space that holds two;
    sentences also end with ``.``, ``!`` or ``?`` and the blanks behind it, or
    with a full-width stop.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    n = len(data)
    begins = np.zeros(n, dtype=bool)
    begins[offsets[:-1][offsets[:-1] < n]] = True
    lines = data == 10
    if unit == "paragraph":
        breaks, word = np.concatenate([[0], np.cumsum(lines)]), ~SPACE[data]
        last = _before(word)
        begins |= word & (breaks[np.arange(n)] - breaks[last + 1] >= 2)
        return np.flatnonzero(begins)
    begins[1:] |= lines[:-1]
    if unit == "sentence":
        blank = _BLANK[data]
        at = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
        last = _before(~blank)[at]
        inside = last >= offsets[document_of(at, offsets)]
        begins[at[inside][_STOP[data[last[inside]]]]] = True
        for stop in _WIDE_STOPS:
            a, b, c = stop.encode()
            begins[3:] |= (data[:-3] == a) & (data[1:-2] == b) & (data[2:-1] == c)
    return np.flatnonzero(begins)


def units(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units with a word: first and last byte, document, number of words, and two hashes of the normalised words."""
    begins = unit_starts(data, offsets, unit)
    starts, ends, of = words(data, np.append(begins, len(data)))  # a full-width stop ends a unit without a blank
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, dtype=np.int64)
    held = of[first]
    count = np.diff(np.concatenate([first, [len(of)]]))
    hashes = Spans(_LOWER[data]).hash(starts, ends)
    place = (np.arange(len(of)) - np.repeat(first, count) + 1).astype(np.uint64)
    digests = [np.add.reduceat(mix(hashes ^ mix(place * seed)), first) if len(first) else np.zeros(0, np.uint64) for seed in _SEEDS]
    until = np.concatenate([begins[1:], [len(data)]])[held] if len(held) else held
    return begins[held], until, document_of(begins[held], offsets), count, np.stack(digests, axis=1)


def places(doc: np.ndarray) -> np.ndarray:
    """Number of every unit among those of its document."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, dtype=np.int64)
    return np.arange(len(doc)) - np.repeat(first, np.diff(np.concatenate([first, [len(doc)]])))


def in_long_runs(repeated: np.ndarray, doc: np.ndarray, count: np.ndarray, min_words: int) -> np.ndarray:
    """Mask of the repeated units whose run of neighbouring repeated units has ``min_words`` words."""
    if not len(doc):
        return repeated
    turn = np.concatenate([[True], (repeated[1:] != repeated[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(turn)
    total = np.add.reduceat(count, first)
    return repeated & (np.repeat(total, np.diff(np.concatenate([first, [len(doc)]]))) >= min_words)


def dedup_units(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unit: str = "sentence",
    into: str = "dedup",
    rank: str | None = None,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` with a struct: ``n_units``, ``n_removed``, ``kept_text``, and byte spans ``removed`` of the original text.

    The occurrence with the least ``rank`` (the key by default), then key,
    then place in the text stays.  With ``min_words=1`` every repeated unit
    goes.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    own = docs.select(F.col(rank or key).alias("r"), F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    long = T.LongType()
    occurrence = T.StructType(
        [T.StructField("d", long), T.StructField("e", long), *own.schema.fields[:3], T.StructField("p", T.IntegerType())]
    )

    def digests(batches):
        for batch in batches:
            for rows, data, offsets in pieces(batch, "t"):
                _, _, doc, _, two = units(data, offsets, unit)
                at = pa.array(doc)
                hashes = [pa.array(two[:, i].view(np.int64)) for i in (0, 1)]
                columns = [*hashes, *[rows.column(c).take(at) for c in range(3)], pa.array(places(doc).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=occurrence.fieldNames())

    found = stored(own.mapInArrow(digests, occurrence), "units")
    place = F.struct("r", "k", "h", "p")
    grouped = found.groupBy("d", "e").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stored(grouped, "repeated-units")
    hot = F.col("n") > found.agg(F.ceil(F.count("*") / HOT_KEYS)).scalar()
    few = F.broadcast(first.where(hot).select("d", "e", "first"))
    often = found.join(few, ["d", "e"])
    rest = found.join(few.select("d", "e"), ["d", "e"], "left_anti").join(first.where(~hot).select("d", "e", "first"), ["d", "e"])
    later = [part.where(place > F.col("first")).select("k", "h", "p") for part in (often, rest)]
    gone = later[0].unionAll(later[1]).groupBy("k", "h").agg(F.collect_set("p").alias("gone"))  # as many as the text has units

    kept = docs.drop(into)
    rows = kept.select(F.struct(*kept.columns).alias("row"), F.col(key).alias("k"), F.xxhash64(text).alias("h")).alias("d")
    met = rows.join(gone.alias("g"), F.col("d.k").eqNullSafe(F.col("g.k")) & (F.col("d.h") == F.col("g.h")), "left")
    names = kept.columns
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def removed(batches):
        for batch in batches:
            columns = batch.column(0).flatten()
            flat = pa.RecordBatch.from_arrays([*columns, batch.column(1)], names=[f"c{i}" for i in range(len(names))] + ["gone"])
            for part, data, offsets in pieces(flat, f"c{names.index(text)}"):
                body = part.column(names.index(text))
                start, end, doc, count, _ = units(data, offsets, unit)
                lists = part.column(len(names))
                told = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=part.num_rows))])
                repeated = np.zeros(len(doc), dtype=bool)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                repeated[np.repeat(told[:-1], sizes) + lists.flatten().to_numpy(zero_copy_only=False)] = True
                out = np.flatnonzero(in_long_runs(repeated, doc, count, min_words))
                per_doc = np.bincount(doc[out], minlength=part.num_rows)
                texts = body.to_pylist()
                held = data.tobytes()
                ends = np.cumsum(per_doc)
                for i in np.flatnonzero(per_doc).tolist():
                    mine = out[ends[i] - per_doc[i] : ends[i]]
                    cuts = [int(offsets[i]), *np.stack([start[mine], end[mine]], axis=1).ravel().tolist(), int(offsets[i + 1])]
                    texts[i] = b"".join(held[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)).decode()
                base = offsets[doc[out]]
                spans = pa.StructArray.from_arrays([pa.array(start[out] - base), pa.array(end[out] - base)], names=["start", "end"])
                struct = pa.StructArray.from_arrays(
                    [
                        pa.array(np.diff(told)), pa.array(per_doc), pa.array(texts, pa.string()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), spans).cast(span),
                    ],
                    names=FIELDS.fieldNames(),
                )
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], struct], names=[*names, into])

    return met.select("d.row", "g.gone").mapInArrow(removed, T.StructType([*kept.schema.fields, T.StructField(into, FIELDS)]))
