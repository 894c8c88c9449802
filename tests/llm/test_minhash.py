"""Near-duplicate classes against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from cases import awkward

from isograd.llm import minhash as mh
from isograd.llm.components import components
from isograd.llm.queries import LLM_QUERIES, table


def sets_of(text: str | None) -> frozenset:
    found = (text or "").split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def plain_classes(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    parent = {i: i for i, _ in rows}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    held = [(i, sets_of(t)) for i, t in rows]
    for n, (i, s) in enumerate(held):
        for j, t in held[:n]:
            if s and t and len(s & t) >= 0.8 * len(s | t):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in parent}


def near_copies(seed: int) -> list[tuple[int, str]]:
    """Bases with copies of few and of many changed words, and chains of copies of copies."""
    rng = random.Random(seed)
    prose = lambda n: [f"{rng.choice('abcdefgh')}{rng.randrange(4000)}" for _ in range(n)]
    texts = []
    for _ in range(6):
        base = prose(rng.choice([60, 150, 400]))
        texts.append(" ".join(base))
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(0, len(base) // 12)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
        chain = list(base)
        for _ in range(8):
            chain = chain + prose(len(base) // 14)
            texts.append(" ".join(chain))
    texts += [" ".join(prose(80)) for _ in range(20)] + ["one two", "one two", "one two three"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_brute_force(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    expected = plain_classes(rows)
    got = {r.doc_id: r.class_id for r in mh.classes(docs).collect()}
    wrong = {i for i in got if got[i] != expected[i]}
    # A pair at the limit itself has no common band less than once in a hundred; here every link is found.
    assert not wrong


def test_classes_on_the_test_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = {r.doc_id: r.class_id for r in LLM_QUERIES["op9_minhash"](spark, sf_dir).collect()}
    assert got == plain_classes(rows)


def test_awkward_rows(spark):
    rows, schema = awkward("class_id")
    docs = spark.createDataFrame(rows, schema)
    found = sorted((r.doc_id or -1, r.class_id or -1) for r in mh.classes(docs).collect())
    same = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, -1: -1}
    assert found == sorted((r[0] or -1, same.get(r[0] or -1, r[0] or -1)) for r in rows)
    kept = mh.one_of_each(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 5, 6, 7, 8, 10, 11, 12]
    assert mh.classes(docs.limit(0)).collect() == [] and mh.one_of_each(docs.limit(0)).collect() == []


def test_texts_of_one_id_are_one_document(spark):
    text = " ".join(f"a{i}" for i in range(60))
    other = " ".join(f"b{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, other), (3, text), (3, other + " tail"), (4, "x y z")], "doc_id long, text string")
    assert {(r.doc_id, r.class_id) for r in mh.classes(docs).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


@pytest.mark.parametrize("part,times", [(0, 1), (3, 8), (3, 20), (5, 60)])
def test_pairs_at_the_limit_share_a_band(part, times):
    """180 common shingles of 225, of which every third or fifth occurs many times in one text only."""
    rng = np.random.default_rng(times)
    missed, trials = 0, 3000
    for _ in range(trials // 100):
        value = rng.integers(1, 2**43, (100, 225)).astype(np.uint64)
        pairs = np.stack([value[:, :202], np.concatenate([value[:, :180], value[:, 202:]], axis=1)[:, :202]], axis=1)
        count = np.ones((100, 2, 202))
        if part:
            count[:, 0, :180:part] = times
        doc = np.repeat(np.arange(200), 202)
        keys = mh.all_band_keys(doc, pairs.reshape(-1), count.reshape(-1), 200, mh.BANDS, mh.UNIT_BANDS, mh.ROWS)
        missed += int((~(keys[::2] == keys[1::2]).any(axis=1)).sum())
    assert missed / trials < 0.01


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    value = rng.integers(1, 2**43, 400).astype(np.uint64)
    first, second = np.arange(300), np.arange(100, 400)
    weight = rng.choice([1.0, 2.0, 5.0], 400)
    doc = np.repeat([0, 1], 300)
    picks = np.concatenate([first, second])
    got = mh.signatures(doc, value[picks], weight[picks], 2, 4000)
    x, y = np.zeros(400), np.zeros(400)
    x[first], y[second] = weight[first], weight[second]
    both = np.flatnonzero((x > 0) & (y > 0))
    expected = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in both)
    assert (got[0] == got[1]).mean() == pytest.approx(expected, abs=0.04)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 500)]
    rng.shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in links], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}
