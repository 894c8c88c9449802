"""Whole texts as byte buffers: words, rolling hashes, and mapping over Arrow batches.

A batch of texts is handled as one ``uint8`` buffer with document offsets, so
that numpy works on megabytes at a time and no text is copied into Python
strings.  Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (finaliser of the splitmix generator)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: One random 64-bit code for each byte value.
CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _grow(n: int) -> None:
    if len(_powers[0]) > n:
        return
    size = max(1 << 18, 1 << int(n).bit_length())
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        _powers[k] = np.multiply.accumulate(steps)


class Spans:
    """Hashes of any span of a byte buffer, from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        self._add(CODES[data])

    @classmethod
    def of(cls, values: np.ndarray) -> Spans:
        """Hashes of any span of a sequence of random 64-bit values."""
        spans = cls.__new__(cls)
        spans._add(values)
        return spans

    def _add(self, values: np.ndarray) -> None:
        n = len(values)
        _grow(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _powers[0][:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _powers[1][start] + (end - start).astype(np.uint64) * _STEP)

    def windows(self, width: int) -> np.ndarray:
        """Hash of every ``width``-byte window, by its start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * _powers[1][:n])


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; words do not cross documents."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~space[data]
    here, before, after = inside[1:-1], inside[:-2], inside[2:]
    opens, closes = here & ~before, here & ~after
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] |= here[edges]
    closes[edges - 1] |= here[edges - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, document_of(starts, offsets)


def document_of(position: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, position, side="right") - 1


def ngrams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` items inside one document, and their starts."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = hashes[:count].copy()
    for j in range(1, n):
        total *= _STEP
        total += hashes[j : count + j]
    at = np.flatnonzero(doc[:count] == doc[n - 1 :])
    return mix(total[at]), at


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of keys that occur more than once, ascending, and whether each is a later occurrence."""
    ordered = np.sort(keys)
    double = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(double):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    bits = np.uint64((1 << 20) - 1)
    sieve = np.zeros(1 << 20, dtype=bool)
    sieve[(double & bits).astype(np.int64)] = True
    at = np.flatnonzero(sieve[(keys & bits).astype(np.int64)])
    place = np.minimum(np.searchsorted(double, keys[at]), len(double) - 1)
    at = at[double[place] == keys[at]]
    order = np.argsort(keys[at], kind="stable")
    value = keys[at][order]
    later = np.zeros(len(at), dtype=bool)
    later[order[1:]] = value[1:] == value[:-1]
    return at, later


def covered(starts: np.ndarray, width: int | np.ndarray, size: int) -> np.ndarray:
    """Mask of the positions inside any of the runs that begin at ``starts``."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``size`` bytes of text: rows, bytes, offsets."""
    if not batch.num_rows:
        return
    data, offsets = column_bytes(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def annotate(
    docs: DataFrame,
    text: str,
    into: str,
    fields: T.StructType,
    measure: Callable[[], Callable[[np.ndarray, np.ndarray], dict]],
    keep: str | None = None,
    size: int = 1 << 20,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``into`` with what ``measure`` finds in each text.

    ``measure()`` is called once in each task and returns a function of
    (bytes, offsets) that gives one value per text for every field.  A column
    called like ``into`` is replaced.  With ``keep``, the name of a boolean
    field, only rows where it holds are returned, without the struct.  ``size``
    is the text that ``measure`` sees at once (see :func:`pieces`).
    """
    rest = docs.drop(into)
    schema = rest.schema if keep else T.StructType([*rest.schema.fields, T.StructField(into, fields)])
    kinds = to_arrow_schema(fields)

    def run(batches):
        found = measure()
        for batch in batches:
            for rows, data, offsets in pieces(batch, text, size):
                values = found(data, offsets)
                if keep:
                    yield rows.filter(pa.array(values[keep]))
                    continue
                struct = pa.StructArray.from_arrays([pa.array(values[f.name], type=f.type) for f in kinds], fields=list(kinds))
                yield pa.RecordBatch.from_arrays([*rows.columns, struct], names=[*rows.schema.names, into])

    return rest.mapInArrow(run, schema)
