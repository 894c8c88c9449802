"""Periodic runs of words inside each text, by enumerating maximal pairs.

The suffixes of a text, as sequences of words, are ordered by prefix doubling
and the common prefixes of neighbours are measured; both are done for all
texts of a buffer at once.  The tree of common-prefix intervals is then walked
bottom-up.  An interval holds the list of its suffixes by position, each with
the class of its left word.  When a child joins its interval, the suffixes of
the shorter list look into the longer one for partners of another class: such
a pair agrees for exactly the interval's length and for no word more on either
side.  A pair ``q`` words apart that agrees for at least ``q`` words is a
stretch of period ``q`` that no neighbour extends, so nothing is extended here.

Of the partners before a suffix that lie within the agreeing length, three or
more occurrences form an arithmetic progression inside one run, and all but
the first have the suffix's own left word; behind it, at most one lies that
near.  So each suffix asks its list twice, and the work is ``n log n`` list
steps for any text.  A stretch found at several distances has the least of
them as its period.

Every text is judged from itself alone: one pass, no shuffle.  Nulls and empty
texts have no words and no runs; very long texts are read whole; equal rows
get equal results; other columns pass through, one called like ``into`` is
replaced.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from isograd.llm.text import Spans, annotate, mix, words

WORD = r"[^\x20\x09-\x0D]+"
#: Fewest words of a run; it also repeats its period at least twice.
MIN_LENGTH = 12

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FIELDS = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
)


def _firsts(different: np.ndarray) -> np.ndarray:
    """For each place the place at which its group of equal neighbours begins."""
    begins = np.concatenate([[True], different])
    return np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))


def suffix_order(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions ordered by the words from them to the end of their text.

    ``ids`` name words so that no two texts share one; ``ends`` is the end of
    the text of each position.  Any order of the ids will do: suffixes with a
    common prefix come next to each other.
    """
    n = len(ids)
    at = np.argsort(ids)
    rank = np.empty(n, dtype=np.int64)
    first = _firsts(ids[at][1:] != ids[at][:-1])
    rank[at] = first
    open_ = at[np.bincount(first, minlength=n)[first] > 1]
    step = 1
    while len(open_):
        ahead = open_ + step
        second = np.where(ahead < ends[open_], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        order = np.argsort(key)
        open_, key = open_[order], key[order]
        old = rank[open_]
        fresh = _firsts(key[1:] != key[:-1])
        rank[open_] = old + fresh - _firsts(old[1:] != old[:-1])
        open_ = open_[np.bincount(fresh, minlength=len(open_))[fresh] > 1]
        step *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


def common_prefixes(order: np.ndarray, ids: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Common words of each suffix with the one before it; 0 where there are fewer than ``least``."""
    out = np.zeros(len(order), dtype=np.int64)
    if len(order) < 2:
        return out
    spans, a, b = Spans.of(ids), order[:-1], order[1:]
    limit = np.minimum(ends[a] - a, ends[b] - b)
    where = np.flatnonzero(limit >= least)
    where = where[spans.hash(a[where], a[where] + least) == spans.hash(b[where], b[where] + least)]
    a, b = a[where], b[where]
    low, high = np.full(len(where), least), limit[where]
    while np.any(low < high):
        middle = (low + high + 1) // 2
        same = spans.hash(a, a + middle) == spans.hash(b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    out[where + 1] = low
    return out


class _Pairs:
    """Maximal pairs at most their agreeing length apart, as stretches with their least period."""

    def __init__(self, left: list[int], least: int):
        self.left, self.least = left, least
        self.found: dict[tuple[int, int], int] = {}

    def _take(self, first: int, second: int, agree: int) -> None:
        apart = second - first
        if agree + apart >= self.least and self.left[first] != self.left[second]:
            stretch = (first, agree + apart)
            if apart < self.found.get(stretch, apart + 1):
                self.found[stretch] = apart

    def join(self, a: list[int], b: list[int], agree: int) -> list[int]:
        """Two children of an interval of common prefix ``agree``: report their pairs, give the joined list."""
        if len(a) < len(b):
            a, b = b, a
        for p in b:
            i = bisect_left(a, p - agree)
            if i < len(a) and a[i] < p:
                self._take(a[i], p, agree)
            j = bisect_right(a, p, i)
            if j < len(a) and a[j] <= p + agree:
                self._take(p, a[j], agree)
        if len(b) * 16 > len(a):
            return sorted(a + b)
        for p in b:
            insort(a, p)
        return a

    def walk(self, positions: list[int], common: list[int]) -> None:
        """The interval tree of neighbouring suffixes; ``common[i]`` words are shared by suffixes i - 1 and i."""
        stack: list[tuple[int, list[int]]] = []
        child = [positions[0]]
        for p, agree in zip(positions[1:], common[1:], strict=True):
            while stack and stack[-1][0] > agree:
                longer, held = stack.pop()
                child = self.join(held, child, longer)
            if stack and stack[-1][0] == agree:
                child = self.join(stack.pop()[1], child, agree)
            stack.append((agree, child))
            child = [p]
        while stack:
            longer, held = stack.pop()
            child = self.join(held, child, longer)


def find_runs(ids: np.ndarray, doc: np.ndarray, docs: int, min_length: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, by start, then period; ``ids`` differ between texts."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(docs)]
    if not len(ids):
        return out
    begin = np.searchsorted(doc, np.arange(docs + 1))
    ends = begin[doc + 1]
    order = suffix_order(ids, ends)
    common = common_prefixes(order, ids, ends, -(-min_length // 2))
    deep = np.flatnonzero(common)
    if not len(deep):
        return out
    left = np.concatenate([[0], ids[:-1]])
    left[begin[:-1][begin[:-1] < len(ids)]] = 0
    pairs = _Pairs(left.tolist(), min_length)
    cuts = np.flatnonzero(np.diff(deep) > 1) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(deep)], strict=True):
        block = slice(int(deep[a]) - 1, int(deep[b - 1]) + 1)
        pairs.walk(order[block].tolist(), common[block].tolist())
    for (first, length), period in pairs.found.items():
        out[doc[first]].append((first - int(begin[doc[first]]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def measure(data: np.ndarray, offsets: np.ndarray, min_length: int) -> dict[str, list | np.ndarray]:
    docs = len(offsets) - 1
    starts, ends, doc = words(data, offsets)
    salt = mix(np.arange(1, docs + 1, dtype=np.uint64))
    ids = mix(Spans(data).hash(starts, ends) ^ salt[doc])
    runs, held, edges = find_runs(ids, doc, docs, min_length), data.tobytes(), offsets.tolist()
    n_words = np.bincount(doc, minlength=docs)
    texts = []
    for i, found in enumerate(runs):
        said = held[edges[i] : edges[i + 1]].split()
        if found:
            edge = np.zeros(n_words[i] + 1, dtype=np.int64)
            for start, length, period in found:
                edge[start + period] += 1
                edge[start + length] -= 1
            said = [w for w, gone in zip(said, (np.cumsum(edge[:-1]) > 0).tolist(), strict=True) if not gone]
        texts.append(b" ".join(said).decode())
    return {"n_words": n_words, "runs": runs, "collapsed": texts}


def periodic_runs(docs: DataFrame, text: str = "text", into: str = "periodic", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with a struct: ``n_words``, the ``runs`` by word number, and the ``collapsed`` text.

    A run is a stretch of words of least period ``q`` and at least
    ``max(min_length, 2 q)`` words that no neighbour extends with that period.
    The collapsed text keeps the first period of every run; its words are one
    blank apart.  Words are what ASCII white space divides.
    """
    if min_length < 2:
        raise ValueError("min_length must be 2 or more")
    return annotate(docs, text, into, FIELDS, lambda: lambda data, offsets: measure(data, offsets, min_length))
