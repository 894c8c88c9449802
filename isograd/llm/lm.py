"""Language-model scoring with a weighted backoff automaton.

States are the n-grams of the training texts, without bound on their number.
An arc reads a word that followed the state's words in training; where there
is none, a failure arc leads to the state that is one word shorter and costs
the weight that smoothing leaves to it.  A text is read once from left to
right: it carries its state, the longest known run of the words before, and
adds up the logarithms of the weights.  All texts of a block advance by one
word at a time.  A long text is read in segments side by side: as order - 1
words alone decide a state, a segment enters the automaton that many words
early, without words, and has its state when its own words begin.

Smoothing is by a Dirichlet prior: after words h, a word w has probability
``(c(hw) + strength * p(w after the shorter h)) / (c(h) + strength)``; without
any words before it ``(c(w) + 1) / (N + V + 1)``.

The automaton grows with the corpus and is never in one place.  Documents are
dealt to blocks of bounded bytes by a hash.  A block sends its distinct
n-grams, packed, with their counts in its training texts, to shards of the
hash range; shards add up and answer each block in its own order; the block
then builds its part of the automaton and scores its texts.  Numbers of blocks,
shards follow the bytes of the texts, and each is one partition: no task grows.  A word that a
third of all tokens repeat is one number from each block.  N-grams are told
apart by 64-bit hashes.

Null and empty texts are one end token.  Very long texts belong to one block
and are scored whole.  Equal rows get equal scores.  Rows with a null key are
not held out.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from isograd.llm.storage import shuffle_partitions
from isograd.llm.text import Spans, mix, pieces, words

ORDER = 2
STRENGTH = 2.0
BLOCK_BYTES = 12 << 20
SHARD_BYTES = 16 << 20
SEGMENT = 256
_FLUSH = 3_000_000
_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(key: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text with a start before and an end behind it; text; whether a start."""
    data = _LOWER[data]
    starts, ends, doc = words(data, offsets)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    end = np.cumsum(count + 2) - 1
    begin = end - count - 1
    out = np.empty(int(count.sum()) + 2 * len(count), dtype=np.uint64)
    at = np.arange(len(doc)) + 2 * doc + 1
    out[at] = Spans(data).hash(starts, ends)
    out[begin], out[end] = _START, _END
    text = np.repeat(np.arange(len(count)), count + 2)
    is_start = np.zeros(len(out), dtype=bool)
    is_start[begin] = True
    return out, text, is_start


def grams(hashes: np.ndarray, text: np.ndarray, is_start: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length up to ``order``: hashes of the n-grams, and the place of their last token (never a start)."""
    out, run = [], hashes
    for n in range(1, order + 1):
        if n > 1:  # append one token to the runs that end just before it
            run = run[:-1] * _STEP + hashes[n - 1 :]
        last = np.arange(n - 1, len(hashes))
        fits = ~is_start[last] & (text[last] == text[last - n + 1])
        out.append((mix(run[fits] + np.uint64(n)), last[fits]))
    return out


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together; where they are all zero they compress to nothing."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(held: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(held, dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1)


def _steps(keys: np.ndarray) -> bytes:
    """Ascending keys as packed differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _keys(held: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(held, np.uint64), dtype=np.uint64)


def _shard_cuts(keys: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """Shards of the hash range with their parts of ascending keys."""
    edges = [min((i << 64) // shards, (1 << 64) - 1) for i in range(1, shards)]
    cuts = np.concatenate([[0], np.searchsorted(keys, np.array(edges, dtype=np.uint64)), [len(keys)]]).tolist()
    return [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]


def vocabulary(docs: DataFrame, shards: int) -> dict[str, int]:
    """Of the training rows (``t``, ``out``): tokens, texts, and distinct tokens."""
    schema = T.StructType(
        [T.StructField("shard", T.IntegerType()), T.StructField("words", T.BinaryType())]
        + [T.StructField(c, T.LongType()) for c in ("tokens", "texts")]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        held, size, sums = [], 0, [0, 0]

        def flush():
            keys = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            rows = [(i, _steps(keys[a:b]), 0, 0) for i, a, b in _shard_cuts(keys, shards)] + [(0, None, *sums)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for rows, data, offsets in pieces(batch, "t"):
                train = ~rows.column(rows.schema.get_field_index("out")).to_numpy(zero_copy_only=False).astype(bool)
                hashes, text, is_start = tokens(data, offsets)
                (unigrams, last), *_ = grams(hashes, text, is_start, 1)
                used = train[text[last]]
                held.append(np.unique(unigrams[used]))
                size += len(held[-1])
                sums = [sums[0] + int(used.sum()), sums[1] + int(train.sum())]
                if size > _FLUSH:
                    yield flush()
                    held, size, sums = [], 0, [0, 0]
        yield flush()

    def distinct(group: pa.Table) -> pa.Table:
        keys = [_keys(x.as_py()) for x in group.column("words") if x.is_valid]
        n = len(np.unique(np.concatenate(keys))) if keys else 0
        sums = [int(sum(group.column(c).to_pylist())) for c in ("tokens", "texts")]
        return pa.table([pa.array([v], pa.int64()) for v in (n, *sums)], names=["distinct", "tokens", "texts"])

    found = docs.select("t", "out").mapInArrow(run, schema).repartitionById(shards, F.col("shard")).groupBy("shard").applyInArrow(distinct, "distinct long, tokens long, texts long")
    row = found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in found.columns]).first()
    return row.asDict()


class Automaton:
    """The part of the automaton that a block of texts can reach.

    ``levels`` are the n-grams of the block (see :func:`grams`), ``known`` the
    training counts of the distinct keys of all levels.  A state is the run of
    ``m`` tokens that ends before a place; its arc there is the run of ``m + 1``
    tokens that ends at the place.
    """

    def __init__(self, levels, at: list[np.ndarray], known: np.ndarray, strength: float, total: int, types: int, texts: int, size: int):
        self.order, self.texts = len(levels), texts
        self.places = levels[0][1]
        count = known[at[0]]
        value = np.ones(size)  # smoothed probability of the token at a place, after the runs so far
        value[self.places] = (count + 1.0) / (total + types + 1.0)
        context = np.full(size, texts, dtype=np.int64)  # counts of the state by place; a start was seen once in each text
        context[self.places] = count
        #: By length of the state and place: whether an arc reads the token, its weight, and the weight of the failure arc.
        self.has_arc = np.zeros((self.order, size), dtype=bool)
        self.has_arc[0] = True
        self.arc = np.zeros((self.order, size))
        np.log10(value, out=self.arc[0])
        self.failure = np.zeros((self.order, size))
        self.seen = np.zeros(size, dtype=bool)
        self.seen[self.places] = count > 0
        for m, ((_, last), index) in enumerate(zip(levels[1:], at[1:], strict=True), start=1):
            count, before = known[index], context[last - 1]
            value[last] = (count + strength * value[last]) / (before + strength)
            self.has_arc[m, last] = count > 0
            self.arc[m, last] = np.log10(value[last])
            self.failure[m, last] = np.log10(strength / (before + strength))
            context = np.zeros(size, dtype=np.int64)
            context[last] = count
        self.base = self.arc[0][self.places]

    def read(self, segment: int = SEGMENT) -> np.ndarray:
        """Log10 probability of every token, read from left to right."""
        size, longest = self.arc.shape[1], self.order - 1
        segment = max(segment, longest, 1)
        token = np.zeros(size + 1, dtype=bool)
        token[self.places] = True
        begin = np.flatnonzero(~token)  # the start of every text, and the end of all
        tokens_, begin = np.diff(begin) - 1, begin[:-1]
        runs = -(-tokens_ // segment)
        text = np.repeat(np.arange(len(begin)), runs)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
        early = np.where(nth > 0, longest, 0)
        first = begin[text] + 1 + nth * segment
        stop = np.minimum(first + segment, begin[text] + 1 + tokens_[text])
        at = first - early
        order = np.argsort(at - stop, kind="stable")
        at, early, steps = at[order], early[order], (stop - at)[order]
        state = np.where(early > 0, 0, min(longest, int(self.texts > 0)))  # a text begins behind its start
        active = np.searchsorted(-steps, -np.arange(1, int(steps[0]) + 1), side="right") if len(steps) else np.zeros(0, np.int64)
        has_arc, arc, failure = self.has_arc.reshape(-1), self.arc.reshape(-1), self.failure.reshape(-1)
        score = np.zeros(size)
        for step, k in enumerate(active.tolist()):
            place, m = at[:k] + step, state[:k]
            cost = np.zeros(k)
            for _ in range(longest):
                here = m * size + place
                fall = ~has_arc[here]
                cost += np.where(fall, failure[here], 0.0)
                m = m - fall
            cost += arc[m * size + place]
            state[:k] = np.where((m > 0) | self.seen[place], np.minimum(m + 1, longest), 0)
            own = early[:k] <= step
            score[place[own]] = cost[own]
        return score[self.places]


def score(
    docs: DataFrame,
    out: Column,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    strength: float = STRENGTH,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row for each row of ``docs``; rows where ``out`` holds take no part in training.

    Returns ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (of the plain unigram model) and ``score``.
    """
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.coalesce(out, F.lit(False)).alias("out"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("bytes")).first()["bytes"]
    shards = max(2 * shuffle_partitions(docs.sparkSession), -(-size // shard_bytes))
    blocks = -(-size // block_bytes) + 1
    seen = vocabulary(own, shards)
    total, types, texts = seen["tokens"], seen["distinct"], seen["texts"]
    dealt = own.withColumn("block", F.pmod(F.xxhash64("k", "t"), F.lit(blocks)).cast("int")).repartitionById(blocks, F.col("block"))

    def of_block(group: pa.Table):
        parts, texts_ = [], 0
        for batch in group.to_batches():
            for part, data, offsets in pieces(batch, "t"):
                hashes, text_, is_start = tokens(data, offsets)
                parts.append((hashes, text_ + texts_, is_start))
                texts_ += part.num_rows
        hashes, text_, is_start = map(np.concatenate, zip(*parts, strict=True))
        levels = grams(hashes, text_, is_start, order)
        keys, at = np.unique(np.concatenate([g for g, _ in levels]), return_inverse=True)
        return hashes, text_, levels, keys, np.split(at, np.cumsum([len(g) for g, _ in levels])[:-1])

    def ask(group: pa.Table) -> pa.Table:
        _, text_, levels, keys, at = of_block(group)
        train = ~group.column("out").to_numpy().astype(bool)
        used = np.concatenate([train[text_[last]] for _, last in levels])
        count = np.bincount(np.concatenate(at)[used], minlength=len(keys)).astype(np.uint32)
        cuts = _shard_cuts(keys, shards)
        block = group.column("block")[0].as_py()
        return pa.table(
            [
                pa.array([i for i, _, _ in cuts], pa.int32()), pa.array([block] * len(cuts), pa.int32()),
                pa.array([_steps(keys[a:b]) for _, a, b in cuts], pa.binary()), pa.array([_planes(count[a:b]) for _, a, b in cuts], pa.binary()),
            ],
            names=["shard", "block", "grams", "counts"],
        )

    def answer(group: pa.Table) -> pa.Table:
        parts = [_keys(x.as_py()) for x in group.column("grams")]
        counts = np.concatenate([_from_planes(x.as_py(), np.uint32) for x in group.column("counts")])
        _, at = np.unique(np.concatenate(parts), return_inverse=True)
        known = np.bincount(at, weights=counts).astype(np.uint64)[at]
        held = np.split(known, np.cumsum([len(p) for p in parts])[:-1])
        return pa.table(
            [group.column("block"), group.column("shard"), pa.array([_planes(x) for x in held], pa.binary())], names=["block", "shard", "known"]
        )

    names = ["k", "held_out", "n_tokens", "n_known", "base_score", "score"]
    schema = T.StructType(
        [T.StructField("k", own.schema["k"].dataType), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in names[2:4]]
        + [T.StructField(c, T.DoubleType()) for c in names[4:]]
    )

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return to_arrow_schema(schema).empty_table()
        hashes, text_, levels, _, at = of_block(left)
        by_shard = sorted(zip(right.column("shard").to_pylist(), right.column("known").to_pylist(), strict=True))
        known = np.concatenate([_from_planes(x, np.uint64) for _, x in by_shard]).astype(np.int64)
        machine = Automaton(levels, at, known, strength, total, types, texts, len(hashes))
        of, n = text_[machine.places], left.num_rows
        sums = [np.bincount(of, weights=w, minlength=n) for w in (None, known[at[0]] > 0, machine.base, machine.read())]
        held = [left.column(c) for c in ("k", "out")]
        values = [*held, pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array(sums[3])]
        return pa.table(values, names=names)

    asked = dealt.groupBy("block").applyInArrow(ask, "shard int, block int, grams binary, counts binary")
    answers = asked.repartitionById(shards, F.col("shard")).groupBy("shard").applyInArrow(answer, "block int, shard int, known binary")
    there = answers.repartitionById(blocks, F.col("block"))
    scored = dealt.groupBy("block").cogroup(there.groupBy("block")).applyInArrow(read, schema)
    return scored.select(
        F.col("k").alias(key), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
