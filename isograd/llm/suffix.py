"""Exact substring deduplication over all documents.

Every run of ``WIDTH`` bytes that also starts earlier, in a document of lower
rank or before in the same one, marks its bytes for removal.

1. Each text is cut into pieces: successive runs of ``WIDTH`` bytes whose least
   ``GRAM``-byte hash, the leftmost if several, lies at the same place.  Equal
   runs have equal places of that anchor, so they lie in pieces with an equal
   anchor.  Tasks send hashes of anchor and piece, not text; of equal pieces
   a task sends the first and marks the others.
2. Pieces meet by anchor, packed in arrays, one row for each task and shard.
   Equal pieces but the first are marked.  Different pieces with one anchor
   are compared by content.  Shards follow the bytes of the texts.
3. These pieces are cut from the documents and meet by anchor in buckets.  In
   each, the column-wise construction (``columnwise``) sorts all suffixes, and
   runs with a common prefix of ``WIDTH`` bytes are equal; all but the first
   are marked.  An anchor with more than ``HOT`` different pieces is spread:
   its runs meet one by one by their own hash, the first of each task only.
   Buckets follow the counted bytes of these pieces, and several of them,
   each sorted by itself, make a task.
4. Marks are gathered by document and the bytes under them removed.

Hashes have 64 bits; pieces are taken as equal if the hashes of both anchor
and piece are.  Matches do not cross documents.

Null texts are empty.  Null ids rank last.  Rows that repeat an id and a text,
and rows without an id that repeat a text, are one document: they are ranked
once and get equal results.  Rows that share an id only are ranked by a hash of
their text.  Other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from isograd.llm.columnwise import later_copies
from isograd.llm.storage import BATCH_BYTES, free_names, shuffle_partitions, stored
from isograd.llm.text import Spans, mix, pieces, repeats

WIDTH = 100
GRAM = 28
HOT = 4096
#: Bytes of text for each shard, and of pieces for each bucket: what a task holds at once, whatever the size of the tables.
SHARD_BYTES = 24 << 20
BUCKET_BYTES = 2 << 20
#: Buckets that a task sorts one after the other where there are more of them than twice the shuffle partitions.
BUCKETS_A_TASK = 8
_SLICE = 8 << 20
_FLUSH = 4_000_000
_RUNS = 200_000
_PIECE = 1 << 18
_PLACE = np.uint64((1 << 24) - 1)

_MARKS = "kind byte, meet long, k long, h long, p long, n long"


def _least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every run of ``width`` keys, from runs of 1, 2, 4 ... keys."""
    least, run = keys, 1
    while 2 * run <= width:
        least, run = np.minimum(least[:-run], least[run:]), 2 * run
    return np.minimum(least[: len(keys) - width + 1], least[width - run :])


def cut(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Pieces of the texts of one buffer: document, first run, runs, hash of anchor, hash of piece."""
    if len(data) > _SLICE and len(offsets) == 2:  # a very long text, in slices that share width - 1 bytes
        parts = []
        for base in range(0, len(data) - width + 1, _SLICE - width + 1):
            part = data[base : base + _SLICE]
            doc, first, runs, anchor, piece = cut(part, np.array([0, len(part)]), width, gram)
            parts.append((doc, first + base, runs, anchor, piece))
        return tuple(map(np.concatenate, zip(*parts, strict=True)))
    size = np.diff(offsets)
    long = np.flatnonzero(size >= width)
    if not len(long):
        return (*(np.zeros(0, dtype=np.int64) for _ in range(3)), *(np.zeros(0, dtype=np.uint64) for _ in range(2)))
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[offsets[long]] += 1
    edge[offsets[long] + size[long] - width + 1] -= 1
    spans = Spans(data)
    hashes = spans.windows(gram)
    if len(hashes) < width - gram + 1:
        hashes = np.concatenate([hashes, np.zeros(width - gram + 1 - len(hashes), dtype=np.uint64)])
    place = np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least_in_windows((hashes & ~_PLACE) | place, width - gram + 1) & _PLACE).astype(np.int64)
    inside = np.cumsum(edge[: len(anchor)], dtype=np.int8) > 0
    same = np.zeros(len(anchor) + 1, dtype=bool)
    same[1:-1] = inside[1:] & inside[:-1] & (anchor[1:] == anchor[:-1])
    first = np.flatnonzero(inside & ~same[:-1])
    last = np.flatnonzero(inside & ~same[1:])
    doc = np.searchsorted(offsets, first, side="right") - 1
    return doc, first - offsets[doc], last - first + 1, hashes[anchor[first]], spans.hash(first, last + width)


def _firsts(columns: list[np.ndarray], keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of different rows in order of key and rank, and whether each is the first of its key (``keys`` leading columns)."""
    order = np.lexsort(columns[::-1])
    changes = [c[order][1:] != c[order][:-1] for c in columns]
    if len(order):
        new = np.concatenate([[True], np.any(changes, axis=0)])  # a repeated row has no place of its own
        first = np.concatenate([[True], np.any(changes[:keys], axis=0)])[new]
        return order[new], first
    return order, np.ones(0, dtype=bool)


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The bytes of the values as rows that begin at these offsets."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _sent(own: DataFrame, width: int, gram: int, shards: int) -> DataFrame:
    """Packed pieces by shard (kind 0), and marks of copies inside a task (kind 1)."""
    names = ["a", "s", "k", "h", "p", "n"]
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("kind", T.ByteType())] + [T.StructField(c, T.BinaryType()) for c in names])
    arrow = to_arrow_schema(schema)

    def packed(columns, at, shard, kind):
        """A row for each shard; batches hold about ``BATCH_BYTES``, so that their number follows the bytes, not the shards."""
        order = np.argsort(shard, kind="stable")
        at, shard = at[order], shard[order]
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, np.int64)
        batch = cuts[:-1] * sum(c.itemsize for c in columns) // BATCH_BYTES
        firsts = np.flatnonzero(np.concatenate([[True], batch[1:] != batch[:-1], [True]])) if len(batch) else np.zeros(1, np.int64)
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            inside = at[cuts[a] : cuts[b]]
            row = [pa.array(shard[cuts[a:b]], pa.int32()), pa.array(np.full(b - a, kind, np.int8), pa.int8())]
            row += [_binary(c[inside], (cuts[a : b + 1] - cuts[a]) * c.itemsize) for c in columns]
            yield pa.RecordBatch.from_arrays(row, schema=arrow)

    def flush(held):
        if not held:
            return
        columns = [np.concatenate([part[i] for part in held]) for i in range(len(names))]
        held.clear()  # the columns hold it all
        anchor, piece, k = columns[:3]
        at, _ = repeats(mix(anchor * np.uint64(3) + piece))
        order, first = _firsts([c[at] for c in columns[:5]], 2)
        copies = at[order[~first]]
        keep = np.ones(len(anchor), dtype=bool)
        keep[at] = False
        keep[at[order[first]]] = True
        keep = np.flatnonzero(keep)
        yield from packed(columns, keep, (anchor[keep] % np.uint64(shards)).astype(np.int32), 0)
        yield from packed(columns, copies, (mix(k[copies].astype(np.uint64)) % np.uint64(shards)).astype(np.int32), 1)

    def run(batches):
        held, total = [], 0
        for batch in batches:
            for rows, data, offsets in pieces(batch, "t", _PIECE):
                doc, first, runs, anchor, piece = cut(data, offsets, width, gram)
                k, h = rows.column(0).to_numpy(), rows.column(1).to_numpy()
                held.append((anchor, piece, k[doc], h[doc], first.astype(np.uint32), runs.astype(np.uint16)))
                total += len(doc)
                if total > _FLUSH:
                    yield from flush(held)
                    held, total = [], 0
        yield from flush(held)

    return own.select("k", "h", "t").mapInArrow(run, schema)


def _met(sent: DataFrame, shards: int, hot: int) -> DataFrame:
    """Marks (kind 1) and pieces to compare by content (kind 2; they meet by a number of their anchor, -1 where it is hot)."""

    def table(kind, meet, k, h, p, n):
        return pd.DataFrame({"kind": np.full(len(k), kind, np.int8), "meet": meet, "k": k, "h": h, "p": p.astype(np.int64), "n": n.astype(np.int64)})

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind in (1, 0):
            rows = group[group["kind"] == kind]
            a, s, k, h, p, n = (
                np.frombuffer(b"".join(rows[c]), dtype=t)
                for c, t in zip(("a", "s", "k", "h", "p", "n"), (np.uint64, np.uint64, np.int64, np.int64, np.uint32, np.uint16), strict=True)
            )
            if kind == 1:
                out.append(table(1, np.zeros(len(k), np.int64), k, h, p, n))
                continue
            at, _ = repeats(a)
            columns = [c[at] for c in (a, s, k, h, p, n)]
            order, first = _firsts(columns[:5], 2)
            a, s, k, h, p, n = (c[order] for c in columns)
            out.append(table(1, np.zeros(int((~first).sum()), np.int64), k[~first], h[~first], p[~first], n[~first]))
            a, k, h, p, n = (c[first] for c in (a, k, h, p, n))
            _, group_of, size = np.unique(a, return_inverse=True, return_counts=True)
            several = size[group_of] > 1
            meet = (mix(a) >> np.uint64(1)).astype(np.int64)
            meet[size[group_of] > hot] = -1
            out.append(table(2, meet[several], k[several], h[several], p[several], n[several]))
        return pd.concat(out)

    return sent.repartitionById(shards, F.col("shard")).groupBy("shard").applyInPandas(run, _MARKS)


def _pieces(docs: DataFrame, text: str, asked: DataFrame, width: int, buckets: int) -> DataFrame:
    """Bytes of the pieces to compare, by bucket; rows without bytes are marks."""
    schema = T.StructType(
        [T.StructField("bucket", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("k", "h", "p", "n")]
        + [T.StructField("body", T.BinaryType())]
    )
    arrow = to_arrow_schema(schema)
    k_, h_ = docs.columns[-2:]
    (asked_,) = free_names(docs.columns, "__asked")
    lists = asked.groupBy("k", "h").agg(F.collect_list(F.struct("p", "n", "bucket")).alias("asked"))
    both = docs.alias("d").join(lists.alias("l"), (F.col(f"d.`{k_}`") == F.col("l.k")) & (F.col(f"d.`{h_}`") == F.col("l.h"))).select("d.*", F.col("l.asked").alias(asked_))

    def batch_of(bucket, k, h, p, n, body):
        values = [bucket, k, h, p, n, body]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)

    def single(runs):
        """One piece for each run of a hot anchor; of equal ones in the task the first, and marks for the others."""
        *columns, body = (np.concatenate(c) for c in zip(*runs, strict=True))
        order, first = _firsts(columns, 1)
        bucket = (mix(columns[0]) % np.uint64(buckets)).astype(np.int32)
        for at, text in ((order[first], True), (order[~first], False)):
            bodies = _binary(body[at], np.arange(len(at) + 1) * width) if text else pa.nulls(len(at), pa.binary())
            yield batch_of(bucket[at], *(c[at] for c in columns[1:]), np.ones(len(at), np.int64), bodies)

    def run(batches):
        runs, held_runs, last = [], 0, None
        for batch in batches:
            for rows, data, offsets in pieces(batch, text, _PIECE):
                asked_ = rows.column(rows.num_columns - 1)
                number = asked_.value_lengths().to_numpy()
                flat = asked_.flatten()
                names = [rows.column(rows.num_columns - c).to_numpy() for c in (3, 2)]
                # Of repeated rows one is sent; the comparison drops those of other runs of rows.
                at, _ = _firsts(names, 2)
                once = np.zeros(len(number), dtype=bool)
                once[at] = True
                once &= np.array([name != last for name in zip(*names, strict=True)])
                last = (names[0][-1], names[1][-1])
                doc = np.repeat(np.arange(len(number)), number)
                sent = once[doc]
                doc = doc[sent]
                p, n, bucket = (flat.field(c).to_numpy()[sent] for c in ("p", "n", "bucket"))
                k, h = (name[doc] for name in names)
                begin = offsets[doc] + p
                end = begin + n - 1 + width
                held = data.tobytes()
                usual = np.flatnonzero(bucket >= 0)
                body = [held[a:b] for a, b in zip(begin[usual].tolist(), end[usual].tolist(), strict=True)]
                yield batch_of(bucket[usual], k[usual], h[usual], p[usual], n[usual], body)
                hot = np.flatnonzero(bucket < 0)
                if len(hot):
                    of = np.repeat(hot, n[hot])
                    place = np.arange(len(of)) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
                    starts = begin[of] + place
                    texts = np.lib.stride_tricks.sliding_window_view(data, width)[starts]
                    runs.append((Spans(data).hash(starts, starts + width), k[of], h[of], p[of] + place, texts))
                    held_runs += len(of)
                    if held_runs > _RUNS:
                        yield from single(runs)
                        runs, held_runs = [], 0
        if runs:
            yield from single(runs)

    return both.mapInArrow(run, schema)


def _compared(found: DataFrame, width: int, tasks: int) -> DataFrame:
    """Marks of the runs that occur in an earlier piece of their bucket, one bucket at a time in each task."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        named = group["body"].isna()
        marks = group.loc[named, ["k", "h", "p", "n"]]
        strings = group[~named].drop_duplicates(["k", "h", "p"]).sort_values(["k", "h", "p"])
        if len(strings):
            data = np.frombuffer(b"".join(strings["body"]), dtype=np.uint8)
            offsets = np.concatenate([[0], np.cumsum(strings["body"].map(len).to_numpy(np.int64))])
            of, start = later_copies(data, offsets, width)
            k, h, p = (strings[c].to_numpy()[of] for c in ("k", "h", "p"))
            p = p + start
            order = np.lexsort((p, h, k))
            k, h, p = k[order], h[order], p[order]
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (h[1:] != h[:-1]) | (p[1:] != p[:-1] + 1)]) if len(k) else np.zeros(0, bool)
            begin = np.flatnonzero(new)
            size = np.diff(np.concatenate([begin, [len(k)]]))
            marks = pd.concat([marks, pd.DataFrame({"k": k[begin], "h": h[begin], "p": p[begin], "n": size})])
        return marks.astype("int64")

    dealt = found.withColumn("task", F.pmod("bucket", F.lit(tasks))).repartitionById(tasks, F.col("task"))
    return dealt.groupBy("task", "bucket").applyInPandas(run, "k long, h long, p long, n long")


def _on_characters(body: bytes, gone: np.ndarray) -> np.ndarray:
    """The mask without characters that are removed only in part."""
    first = (np.frombuffer(body, dtype=np.uint8) & 0xC0) != 0x80
    number = np.cumsum(first) - 1
    whole = np.ones(int(number[-1]) + 1, dtype=bool)
    whole[number[~gone]] = False
    return whole[number]


def dedup_substrings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    into: str = "dedup",
    width: int = WIDTH,
    gram: int = GRAM,
    hot: int = HOT,
    characters: bool = False,
    shard_bytes: int = SHARD_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with a struct: ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes) and ``removed`` (byte spans of the original).

    With ``characters`` only whole characters are removed, so that what is
    kept is valid text.  Keys are integers.
    """
    spark = docs.sparkSession
    rest = docs.drop(into)
    rank = F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1))
    k_, h_, marks_ = free_names(rest.columns, "__k", "__h", "__marks")
    whole = rest.withColumns({k_: rank, h_: F.xxhash64(text)})
    own = rest.select(rank.alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    least = 2 * shuffle_partitions(spark)
    size = own.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("bytes")).first()["bytes"]
    shards = max(least, -(-size // shard_bytes))
    met = stored(_met(_sent(own, width, gram, shards), shards, hot), "pieces")
    marks = met.where("kind = 1").select("k", "h", "p", "n")
    asked = met.where("kind = 2")
    body = F.when(F.col("meet") < 0, F.col("n") * width).otherwise(F.col("n") + (width - 1))
    buckets = max(1, -(-(asked.agg(F.sum(body).alias("bytes")).first()["bytes"] or 0) // bucket_bytes))
    tasks = min(buckets, max(least, -(-buckets // BUCKETS_A_TASK)))
    bucket = F.when(F.col("meet") < 0, F.lit(-1)).otherwise(F.pmod("meet", F.lit(buckets))).cast("int")
    compared = _compared(_pieces(whole, text, asked.select("k", "h", "p", "n", bucket.alias("bucket")), width, buckets), width, tasks)
    lists = marks.unionAll(compared).groupBy("k", "h").agg(F.collect_list(F.struct("p", "n")).alias("marks"))
    same = (F.col(f"d.`{k_}`") == F.col("l.k")) & (F.col(f"d.`{h_}`") == F.col("l.h"))
    both = whole.alias("d").join(lists.alias("l"), same, "left").select("d.*", F.col("l.marks").alias(marks_))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept", T.BinaryType()), T.StructField("removed", T.ArrayType(span))]
    )
    schema = T.StructType([*rest.schema.fields, T.StructField(into, fields)])
    kind = to_arrow_schema(T.StructType([schema[into]])).field(0).type

    def run(batches):
        for batch in batches:
            for rows, data, offsets in pieces(batch, text, _PIECE):
                lists_ = rows.column(rows.num_columns - 1)
                number = lists_.value_lengths().fill_null(0).to_numpy()
                flat = lists_.drop_null().flatten()
                p, n = (flat.field(c).to_numpy() for c in ("p", "n"))
                doc = np.repeat(np.arange(len(number)), number)
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(edge, offsets[doc] + p, 1)
                np.add.at(edge, offsets[doc] + p + n - 1 + width, -1)
                gone = np.cumsum(edge[:-1]) > 0
                values = []
                for a, b, touched in zip(offsets[:-1].tolist(), offsets[1:].tolist(), number.tolist(), strict=True):
                    body = data[a:b].tobytes()
                    if not touched:
                        values.append({"n_bytes": b - a, "n_removed": 0, "n_spans": 0, "kept": body, "removed": []})
                        continue
                    mask = _on_characters(body, gone[a:b]) if characters else gone[a:b]
                    ends = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()
                    spans = [{"start": s, "end": e} for s, e in zip(ends[::2], ends[1::2], strict=True)]
                    kept = data[a:b][~mask].tobytes()
                    values.append({"n_bytes": b - a, "n_removed": b - a - len(kept), "n_spans": len(spans), "kept": kept, "removed": spans})
                columns = [*rows.columns[: rows.num_columns - 3], pa.array(values, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return both.mapInArrow(run, schema)
