"""Packing by concatenating and cutting.

First pass: every text becomes token ids, written to the shared folder with
its partition and its place among the partition's tokens.  The totals of the
partitions, one number each, are summed to global offsets.  Second pass: every
text knows its global span and is cut where a fixed window ends; a text across
a boundary gives one record for each window.  No row is shuffled, so neither a
hot source nor a very long text meets others in one task, and all sequences
but the last are full.

Null and empty texts are one end token.  Very long texts run over many
windows.  Equal rows are packed once each.  Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm.storage import stored
from isograd.llm.text import SPACE, Spans, pieces

WINDOW = 2048
END_ID = 1
CACHE = 500_000
_PIECE = 1 << 18

#: Byte-level vocabularies write printable bytes as themselves and number the others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARACTER = {b: chr(b) for b in _SHOWN} | {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
#: White space beyond ASCII; texts with it are encoded in one piece.
_WIDE_BLANK = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WIDE_BYTES = [c.encode()[:2] for c in "\x85\xa0\u1680\u2000\u2028\u205f\u3000"]


def units(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the units of all texts: a word with the blank before it, or a run of white space up to there.

    Tokens of byte-level vocabularies never cross the border of a unit.
    """
    space = SPACE[data]
    begins = np.zeros(len(data), dtype=bool)
    opens = offsets[:-1][np.diff(offsets) > 0]
    begins[opens] = True
    turn = np.flatnonzero(space[1:] != space[:-1]) + 1  # words and runs of white space
    turn = turn[~begins[turn]]
    word = turn[~space[turn]]
    begins[word - 1] = True
    begins[word[data[word - 1] != 32]] = True
    begins[turn[space[turn]]] = True
    return np.flatnonzero(begins)


class Encoder:
    """Token ids of whole texts; the ids of units seen before are found by their 64-bit hash.

    Known units are sorted arrays, emptied when more than ``cache`` are held.
    A unit of letters only is one word to a byte-level tokenizer, which is then
    asked for the word at once; a comma or stop behind it is another.
    """

    def __init__(self, path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        split = made.get("pre_tokenizer") or {}
        self.by_unit = (
            made.get("normalizer") is None and made["model"]["type"] == "BPE" and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space") and split.get("use_regex", True)
        )
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = cache
        self._forget()

    def _forget(self) -> None:
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, unit: str) -> list[int]:
        shown = unit.replace(" ", "\u0120") if unit.isascii() else unit.encode().decode("latin-1").translate(_CHARACTER)
        return [t.id for t in self.tokenizer.model.tokenize(shown)]

    def _learn(self, keys: np.ndarray, bodies: list[str]) -> None:
        found, rest = [], []
        for i, unit in enumerate(bodies):
            bare = unit[1:] if unit[0] == " " else unit
            if bare.isalpha():
                found.append(self._word(unit))
            elif unit[-1] in ",." and bare[:-1].isalpha():
                found.append(self._word(unit[:-1]) + self._word(unit[-1]))
            else:
                found.append([])
                rest.append(i)
        for i, ids in zip(rest, self._whole([bodies[i] for i in rest]), strict=True):
            found[i] = ids
        size = np.array([len(x) for x in found], dtype=np.int64)
        begin = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.array([t for x in found for t in x], dtype="<u4")])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.size = (np.insert(x, at, y) for x, y in ((self.keys, keys), (self.begin, begin), (self.size, size)))

    def _by_unit(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        start = units(data, offsets)
        end = np.concatenate([start[1:], [len(data)]]) if len(start) else start
        distinct, first, which = np.unique(Spans(data).hash(start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.cache:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != distinct[inside]
        if new.any():
            held = data.tobytes()
            ends = end[first[new]].tolist()
            self._learn(distinct[new], [held[a:b].decode("utf-8", "replace") for a, b in zip(start[first[new]].tolist(), ends, strict=True)])
            at = np.searchsorted(self.keys, distinct)
        place = at[which]
        size = self.size[place]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.repeat(self.begin[place] - total[:-1], size) + np.arange(total[-1])].tobytes()
        cuts = 4 * total[np.searchsorted(start, offsets)]
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text of a buffer."""
        held, edges = data.tobytes(), offsets.tolist()
        odd = set(range(len(edges) - 1)) if not self.by_unit else set()
        if self.by_unit and any(x in held for x in [*self.special, *_WIDE_BYTES]):
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                body = held[a:b]
                if any(x in body for x in self.special) or _WIDE_BLANK.search(body.decode("utf-8", "replace")):
                    odd.add(i)
        if not odd:
            return self._by_unit(data, offsets)
        usual = [i for i in range(len(edges) - 1) if i not in odd]
        out = [b""] * (len(edges) - 1)
        if usual:
            parts = [data[edges[i] : edges[i + 1]] for i in usual]
            for i, ids in zip(usual, self._by_unit(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])), strict=True):
                out[i] = ids
        for i, ids in zip(sorted(odd), self._whole([held[edges[i] : edges[i + 1]].decode("utf-8", "replace") for i in sorted(odd)]), strict=True):
            out[i] = np.array(ids, dtype="<u4").tobytes()
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenised(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """First pass: ids of each text, its partition, and its first place among the partition's tokens.

    Returns ``key``, ``ids`` (packed little-endian unsigned 32-bit), ``doc_tokens``, ``part``, ``place``.
    """
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("place", T.LongType()),
        ]
    )
    tail = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        machine, part, place = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows, data, offsets in pieces(batch, text, _PIECE):
                ids = [x + tail for x in machine.encode(data, offsets)]
                count = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                begin = place + np.cumsum(count) - count
                place += int(count.sum())
                columns = [rows.column(0), pa.array(ids, pa.binary()), pa.array(count), pa.array([part] * len(ids), pa.int32()), pa.array(begin)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.select(key, text).mapInArrow(run, schema)


def cut(tokens: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Second pass over a stored result of :func:`tokenised`.

    Returns one row for each piece: ``key``, ``start`` in the document,
    ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.  Only one
    total for each partition is gathered by the driver.
    """
    totals = sorted((r["part"], r["total"]) for r in tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total")).collect())
    before, base = 0, {}
    for part, total in totals:
        base[part] = before
        before += total
    shared = tokens.sparkSession.sparkContext.broadcast(base)
    longs = ("start", "length", "doc_tokens", "sequence_id", "offset")
    schema = T.StructType([tokens.schema[key], T.StructField("ids", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in longs]])

    def run(batches):
        for batch in batches:
            size = batch.column(2).to_numpy()
            part = batch.column(3).to_numpy()
            first = batch.column(4).to_numpy() + np.array([shared.value[p] for p in part.tolist()], dtype=np.int64)
            count = np.where(size > 0, (first + size - 1) // window - first // window + 1, 0)
            row = np.repeat(np.arange(len(size)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            sequence = first[row] // window + nth
            begin = np.maximum(sequence * window, first[row])
            end = np.minimum((sequence + 1) * window, first[row] + size[row])
            start = begin - first[row]
            held = batch.column(1)
            texts = [held[i].as_py() for i in range(len(size))]
            ids = [texts[r][4 * a : 4 * b] for r, a, b in zip(row.tolist(), start.tolist(), (end - first[row]).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)), pa.array(ids, pa.binary()), pa.array(start), pa.array(end - begin),
                    pa.array(size[row]), pa.array(sequence), pa.array(begin - sequence * window),
                ],
                names=schema.fieldNames(),
            )

    return tokens.select(key, "ids", "doc_tokens", "part", "place").mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int | None = END_ID
) -> DataFrame:
    """Pieces of all texts in sequences of ``window`` tokens (see :func:`cut`)."""
    return cut(stored(tokenised(docs, tokenizer, key, text, end_id), "tokens"), key, window)
