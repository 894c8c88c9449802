"""Benchmark decontamination with one Aho-Corasick automaton.

The normalised windows of all test items are the patterns of one automaton.
Each text is normalised to single-spaced words and scanned once; matches are
mapped back to the words and byte offsets of the original text.

The automaton goes to every task, so the benchmark must be small by nature:
its bytes are summed first and more than ``max_bytes`` is an error.  There is
no shuffle; a source or group of copies with most rows costs no task more.

Null or empty texts have no words and are clean.  Items without words have no
window.  Equal rows get equal results, repeated items count once by id, items
without an id take part under the empty id, and other columns pass through.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm.text import annotate

WINDOW = 13
SHARE = 20
MAX_BYTES = 64 << 20
_PIECE = 1 << 18

_TABLE = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TABLE[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TABLE[_c] = _c + 32
_TABLE = bytes(_TABLE)

FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField("clean", T.BooleanType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField(
            "spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
        ),
    ]
)


def normalised(text: bytes) -> list[bytes]:
    """Words of a text: ASCII letters lower-cased, digits, and everything beyond ASCII."""
    return text.translate(_TABLE).split()


def windows_of(text: bytes, width: int) -> list[bytes]:
    found = normalised(text)
    return [b" ".join(found[i : i + width]) for i in range(max(1, len(found) - width + 1))] if found else []


class Automaton:
    """All windows of all items; built once in each task."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        owners: dict[bytes, set[str]] = {}
        for name, text in items:
            for window in windows_of(text, width):
                owners.setdefault(window, set()).add(name)
        self.machine = ahocorasick.Automaton()
        for window, names in owners.items():
            self.machine.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, len(window), tuple(names)))
        if owners:
            self.machine.make_automaton()
        self.empty = not owners

    def scan(self, found: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Mask of the words inside any window, and the items whose windows occur."""
        hit, names = np.zeros(len(found), dtype=bool), set()
        if self.empty or not found:
            return hit, names
        begins = None
        for end, (count, size, owners) in self.machine.iter(f" {b' '.join(found).decode('latin-1')} "):
            if begins is None:
                begins = np.concatenate([[0], np.cumsum([len(w) + 1 for w in found])]) + 1
            first = int(np.searchsorted(begins, end - size))
            hit[first : first + count] = True
            names.update(owners)
        return hit, names


def _spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of the original text under runs of hit words."""
    bare = np.frombuffer(text.translate(_TABLE), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], bare, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    run = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(run[::2], run[1::2], strict=True)]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    into: str = "overlap",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    share: int = SHARE,
    max_bytes: int = MAX_BYTES,
    only_clean: bool = False,
) -> DataFrame:
    """``docs`` with a struct of matches, or only the rows that are not contaminated.

    A text is contaminated when a word is hit and the hit words are at least
    one in ``share``.
    """
    spark = docs.sparkSession
    wanted = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(item_text)).where(F.col(item_text).isNotNull())
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"the benchmark has {size} bytes; an automaton for every task is built for at most {max_bytes}")
    items = spark.sparkContext.broadcast([(name, body.encode()) for name, body in wanted.collect()])

    def measure():
        automaton = Automaton(items.value, width)

        def found(data: np.ndarray, offsets: np.ndarray) -> dict:
            out: dict[str, list] = {f: [] for f in FIELDS.fieldNames()}
            held = data.tobytes()
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                body = held[a:b]
                bag = normalised(body)
                hit, names = automaton.scan(bag)
                n, k = len(bag), int(hit.sum())
                listed = sorted(names)
                bad = k > 0 and share * k >= n
                row = (
                    n, k, len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bad, not bad, listed,
                    [{"start": s, "end": e} for s, e in _spans(body, hit)] if k else [],
                )
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
            return out

        return found

    return annotate(docs, text, into, FIELDS, measure, "clean" if only_clean else None, _PIECE)
