"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds a bounded sample of labelled text.
A text is parsed against each: a phrase is the longest match from where the
last one ended.  The phrases, times the bits it takes to name a place in the
sample, give the cross-entropy; the least one wins.

Automata become one table of transitions in which a missing transition
already leads to where the next phrase stands and says how many phrases it
ends, so numpy moves thousands of places of many texts one byte ahead at a
time.  Long texts are read in blocks of ``BLOCK`` bytes side by side, first as
if a phrase began with each block; then every block is read again from the
state that the block before it leaves, up to where both readings agree.  So
the phrases are those of the whole text, whatever the size of a block.

Only the sample is gathered, at most ``docs_per_language`` excerpts of
``excerpt`` bytes for each language.  A table holds at most ``MAX_LANGUAGES``
automata; of more languages each group has a table of its own, mapped from a
temporary file, and a text takes the best of all.  Judging is one pass over the
rows without a shuffle.

Null texts and texts without a letter are ``und``; without any learned
language so is every text.  Ties go to the first language by name.  Equal
rows get equal results; other columns pass through.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isograd.llm.text import annotate, document_of

DOCS_PER_LANGUAGE = 160
EXCERPT = 256
BLOCK = 512
MAX_LANGUAGES = 40
_ROUNDS = 4

#: Bytes are folded: letters to lower case, digits together, white space together, other ASCII together.
_FOLD = np.full(256, ord("."), dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[48:58] = ord("0")
_FOLD[[9, 10, 11, 12, 13, 32]] = ord(" ")
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[65:91] = True

FIELDS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def suffix_automaton(symbols: Sequence[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all factors of ``symbols``; state 0 begins."""
    moves: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Model:
    """All automata as one table: the entry of a state and symbol is the next state's row, times four, plus the phrases ended."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(lang for lang, texts in samples.items() if any(texts))
        folded = {lang: [_FOLD[np.frombuffer(t, np.uint8)] for t in samples[lang] if t] for lang in self.languages}
        used = np.unique(np.concatenate([x for texts in folded.values() for x in texts])) if folded else np.zeros(0, np.uint8)
        self.width = len(used) + 1  # symbol 0: unknown, and between excerpts
        self.symbol = np.zeros(256, dtype=np.int64)
        self.symbol[used] = np.arange(1, self.width)
        self.symbol = self.symbol[_FOLD]
        tables, roots, self.bits, base = [], [], [], 0
        for lang in self.languages:
            line: list[int] = []
            for text in samples[lang]:
                line += [0, *self.symbol[np.frombuffer(text, np.uint8)].tolist()]
            moves = suffix_automaton(line)
            table = np.full((len(moves), self.width), -1, dtype=np.int64)
            for state, to in enumerate(moves):
                for c, t in to.items():
                    table[state, c] = t
            table[:, 0] = -1
            start = np.where(table[0] >= 0, table[0], 0)
            ended = np.where(table[0] >= 0, 1, 2)
            entry = np.where(table >= 0, 4 * (table + base) * self.width, 4 * (start + base) * self.width + ended)
            entry[0] = np.where(table[0] >= 0, entry[0], 4 * base * self.width + 1)
            tables.append(entry)
            roots.append(base * self.width)
            base += len(moves)
            self.bits.append(float(np.log2(max(2, len(line)))))
        self.table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int64)
        if len(self.table) < 1 << 28:
            self.table = self.table.astype(np.int32)
        self.roots = np.array(roots, dtype=self.table.dtype)

    def phrases(self, data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> np.ndarray:
        """Phrases of every text against every language."""
        size = np.diff(offsets)
        blocks = -(-size // block)
        doc = np.repeat(np.arange(len(size)), blocks)
        if not len(doc) or not len(self.roots):
            return np.zeros((len(self.roots), len(size)))
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = offsets[doc] + nth * block
        length = np.minimum(block, offsets[doc + 1] - start)
        codes = self.symbol[data].astype(self.table.dtype)
        count, end = self._guess(codes, start, length)
        begin = np.repeat(self.roots[:, None], len(doc), axis=1)
        self._mend(codes, start, length, nth > 0, begin, end, count)
        last = np.flatnonzero(np.append(doc[1:] != doc[:-1], True))
        count[:, last] += end[:, last] != self.roots[:, None]
        return np.stack([np.bincount(doc, weights=c, minlength=len(size)) for c in count])

    def _guess(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases ended in every block and the state behind it, each block read as if a phrase began with it."""
        order = np.argsort(-length, kind="stable")
        at, size = start[order], length[order]
        active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
        state = np.repeat(self.roots[:, None], len(order), axis=1)
        ended = np.zeros(state.shape, dtype=np.int64)
        for step, k in enumerate(active.tolist()):
            entry = self.table.take(state[:, :k] + codes[at[:k] + step])
            ended[:, :k] += entry & 3
            state[:, :k] = entry >> 2
        count, end = np.empty_like(ended), np.empty_like(state)
        count[:, order], end[:, order] = ended, state
        return count, end

    def _mend(self, codes, start, length, inner, begin, end, count) -> None:
        """Read blocks again from the state in which the block before them ends, as far as that makes a difference.

        The old reading and the new one go on side by side until they stand in
        the same state.  Where that takes more than ``_ROUNDS`` blocks, as in a
        text of one repeated letter, the rest is read byte by byte.
        """
        within = np.flatnonzero(inner)
        for _ in range(_ROUNDS):
            of, at = np.nonzero(begin[:, within] != end[:, within - 1])
            if not len(of):
                return
            at = within[at]
            old, new = begin[of, at], end[of, at - 1]
            begin[of, at] = new
            more, lane, step = np.zeros(len(of), dtype=np.int64), np.arange(len(of)), 0
            while len(lane):
                code = codes[start[at[lane]] + step]
                before, after = self.table.take(old + code), self.table.take(new + code)
                more[lane] += (after & 3).astype(np.int64) - (before & 3)
                old, new, step = before >> 2, after >> 2, step + 1
                done = length[at[lane]] == step
                end[of[lane[done]], at[lane[done]]] = new[done]
                on = ~done & (old != new)
                lane, old, new = lane[on], old[on], new[on]
            count[of, at] += more
        table = memoryview(self.table)
        for i in range(len(begin)):
            for b in within[begin[i, within] != end[i, within - 1]].tolist():
                while b < len(start) and inner[b] and begin[i, b] != end[i, b - 1]:
                    begin[i, b] = state = int(end[i, b - 1])
                    ended = 0
                    for code in codes[start[b] : start[b] + length[b]].tolist():
                        entry = table[state + code]
                        ended += entry & 3
                        state = entry >> 2
                    count[i, b], end[i, b] = ended, state
                    b += 1

    def bits_per_byte(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Cross-entropy of every text against every language."""
        return self.phrases(data, offsets) * np.array(self.bits)[:, None] / np.maximum(np.diff(offsets), 1)

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> dict[str, list]:
        docs = len(offsets) - 1
        lettered = np.bincount(document_of(np.flatnonzero(_LETTER[data]), offsets), minlength=docs) > 0
        for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)).tolist():
            lettered[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
        if not self.languages:
            return {"lang": ["und"] * docs, "score": [0.0] * docs, "bits_per_byte": [None] * docs}
        bits = self.bits_per_byte(data, offsets)
        best = bits.argmin(axis=0)
        least = bits[best, np.arange(docs)]
        bits[best, np.arange(docs)] = np.inf
        second = bits.min(axis=0)
        score = np.where(np.isfinite(second), 1 - least / np.maximum(second, 1e-300), 1.0)
        names = [self.languages[b] if ok else "und" for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return {"lang": names, "score": np.where(lettered, np.clip(score, 0, 1), 0.0), "bits_per_byte": least}


def sample(docs: DataFrame, key: str, text: str, lang: str, per_language: int = DOCS_PER_LANGUAGE, excerpt: int = EXCERPT) -> dict[str, list[bytes]]:
    """At most ``per_language`` excerpts of each language, chosen by a hash of the key."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = {r[lang]: r["n"] for r in rows.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)).cast("double") / float(1 << 40)
    shares = [F.lit(min(1.0, 1.5 * per_language / n + 20 / n)) for n in counts.values()]
    share = F.try_element_at(F.map_from_arrays(F.array(*map(F.lit, counts)), F.array(*shares)), F.col(lang))
    place = F.pmod(F.xxhash64(key, F.lit("place")), F.greatest(F.lit(1), F.length(text) - excerpt)).cast("int") + 1
    drawn = rows.where(draw < share).select(lang, draw.alias("draw"), F.substring(F.col(text), place, F.lit(excerpt)).alias("part"))
    found: dict[str, list[tuple]] = {}
    for r in drawn.collect():
        found.setdefault(r[lang], []).append((r["draw"], r["part"].encode()))
    return {name: [part for _, part in sorted(parts)[:per_language]] for name, parts in found.items()}


def identify(docs: DataFrame, samples: dict[str, list[bytes]], text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct: ``lang``, ``score`` (how far the second-best language is off), ``bits_per_byte``."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    return annotate(docs, text, into, FIELDS, lambda: _model(shared.value).judge)


class Models(Model):
    """Groups of at most ``most`` languages, each with a table of its own in a temporary file."""

    def __init__(self, samples: dict[str, list[bytes]], most: int = MAX_LANGUAGES):
        self.languages = sorted(lang for lang, texts in samples.items() if any(texts))
        self.folder, self.groups = tempfile.TemporaryDirectory(), []
        for i in range(0, len(self.languages), most):
            group = Model({lang: samples[lang] for lang in self.languages[i : i + most]})
            path = f"{self.folder.name}/{i}.npy"
            np.save(path, group.table)
            group.table = np.load(path, mmap_mode="r")
            self.groups.append(group)

    def bits_per_byte(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.concatenate([group.bits_per_byte(data, offsets) for group in self.groups])


_models: dict[str, Model] = {}


def _model(samples: dict[str, list[bytes]]) -> Model:
    """One model for all tasks of a worker, built there from the sample."""
    name = hashlib.sha256(repr(sorted(samples.items())).encode()).hexdigest()
    if name not in _models:
        _models.clear()
        _models[name] = (Model if len(samples) <= MAX_LANGUAGES else Models)(samples)
    return _models[name]


def held_out(key: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold
