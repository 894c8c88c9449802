"""Quality rules: how much of a text lies inside repeated n-grams and lines.

Rolling hashes of several n-gram lengths are compared inside each text with
numpy; the characters under repeated n-grams, after their first occurrence,
and under repeated lines are measured against the characters of all words.
Every text is judged from itself alone, so the work is one pass without a
shuffle, whatever source or copies hold most rows.

Nulls and empty texts have no words and fail the base rule; very long texts
are measured whole; equal rows get equal results; other columns pass through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from isograd.llm.text import Spans, annotate, covered, mix, ngrams, repeats, words

#: Largest share of word characters inside repeated n-grams of each length, and inside repeated lines.
NGRAM_LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
LINE_CHAR_LIMIT = 0.20
LINE_LIMIT = 0.30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_PIECE = 1 << 18

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def fields(ngram_limits: dict[int, float]) -> T.StructType:
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    shares = [f"dup_{n}gram_share" for n in ngram_limits] + ["dup_line_char_share", "dup_line_share"]
    return T.StructType(
        [T.StructField(c, T.LongType()) for c in longs]
        + [T.StructField(c, T.DoubleType()) for c in shares]
        + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    )


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def measure(data: np.ndarray, offsets: np.ndarray, ngram_limits: dict[int, float]) -> dict[str, np.ndarray]:
    """The measures of every text of one buffer."""
    docs = len(offsets) - 1
    spans = Spans(data)
    starts, ends, doc = words(data, offsets)
    hashes = spans.hash(starts, ends)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    salt = mix(np.arange(1, docs + 1, dtype=np.uint64))

    def total(of: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of, weights=weight, minlength=docs).astype(np.int64)

    out = {"n_words": total(doc), "word_chars": total(doc, chars)}
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]

    # Lines with a word: each begins at the document or after a line break.
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    line_of_word = np.searchsorted(begin, starts, side="right") - 1
    lines = np.unique(line_of_word)
    until = np.concatenate([begin[1:], [len(data)]])[lines]
    until = until - (data[until - 1] == 10) if len(lines) else until
    line_doc = np.searchsorted(offsets, begin[lines], side="right") - 1
    at, later = repeats(spans.hash(begin[lines], until) ^ salt[line_doc])
    double = at[later]
    out["n_dup_lines"] = total(line_doc[double])
    in_double = np.isin(line_of_word, lines[double])
    out["dup_line_char_share"] = _share(total(doc[in_double], chars[in_double]), out["word_chars"])
    out["dup_line_share"] = _share(out["n_dup_lines"], total(line_doc))

    grams, first = ngrams(hashes, doc, 3)
    at, _ = repeats(grams ^ salt[doc[first]])
    inside = covered(first[at], 3, len(starts))
    out["n_repeat_words"] = total(doc[inside])

    good = (out["dup_line_char_share"] <= LINE_CHAR_LIMIT) & (out["dup_line_share"] <= LINE_LIMIT)
    for n, limit in ngram_limits.items():
        grams, first = ngrams(hashes, doc, n)
        at, later = repeats(grams ^ salt[doc[first]])
        inside = covered(first[at[later]], n, len(starts))
        out[f"dup_{n}gram_share"] = _share(total(doc[inside], chars[inside]), out["word_chars"])
        good &= out[f"dup_{n}gram_share"] <= limit
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    out["kept"] = good & ~out["base_failed"]
    return out


def quality(
    docs: DataFrame,
    text: str = "text",
    into: str = "quality",
    ngram_limits: dict[int, float] = NGRAM_LIMITS,
    only_kept: bool = False,
) -> DataFrame:
    """``docs`` with a struct of measures and verdicts, or only the rows that are kept."""
    limits = dict(ngram_limits)
    return annotate(
        docs, text, into, fields(limits), lambda: lambda data, offsets: measure(data, offsets, limits), "kept" if only_kept else None, _PIECE
    )
