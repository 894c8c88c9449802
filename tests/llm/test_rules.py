"""Quality rules, decontamination, line deduplication and packing against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import LONG, awkward
from pyspark.sql import functions as F

from isograd.llm import decontaminate as dc
from isograd.llm import lines as ln
from isograd.llm import packing as pk
from isograd.llm import quality as ql
from isograd.llm.queries import LLM_QUERIES, table, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_quality(text: str | None) -> tuple:
    text = text or ""
    found = WORD.findall(text)
    runs = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    count, inside = Counter(runs), set()
    for i, run in enumerate(runs):
        if count[run] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(inside), failed


def plain_share(text: str | None, n: int) -> float:
    found, seen, inside = WORD.findall(text or ""), set(), set()
    for i in range(len(found) - n + 1):
        run = tuple(found[i : i + n])
        if run in seen:
            inside |= set(range(i, i + n))
        seen.add(run)
    return sum(len(found[i]) for i in inside) / max(1, sum(map(len, found)))


def test_quality_on_the_test_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    for r in LLM_QUERIES["op1_quality_rules"](spark, sf_dir).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_quality(texts[r.doc_id])
        assert r.dup_5gram_share == pytest.approx(plain_share(texts[r.doc_id], 5))
        assert not (r.base_failed and r.kept)


def test_quality_of_awkward_rows(spark):
    rows, schema = awkward("kept")
    docs = spark.createDataFrame(rows, schema)
    got = ql.quality(docs)
    assert got.columns == [*docs.columns, "quality"]
    for r in got.collect():
        q = r.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == plain_quality(r.text)
    kept = ql.quality(docs, only_kept=True)
    assert kept.schema == docs.schema
    assert sorted(r.kept for r in kept.collect()) == sorted(r.kept for r in got.where("quality.kept").collect())
    assert ql.quality(docs.limit(0)).collect() == []


def test_repetition_is_rejected(spark):
    fresh = " ".join(f"word{i}" for i in range(200))
    again = fresh + " " + " ".join(f"word{i}" for i in range(60))
    lines = "\n".join([f"line number {i} of many words" for i in range(20)] + ["the same line again"] * 12)
    docs = spark.createDataFrame([(1, fresh), (2, again), (3, lines)], "doc_id long, text string")
    assert {r.doc_id: r.quality.kept for r in ql.quality(docs).collect()} == {1: True, 2: False, 3: False}


def plain_overlap(text: str | None, items: list[tuple]) -> tuple:
    found, hit, names = ITEM_WORD.findall((text or "").translate(LOWER)), set(), set()
    for name, body in items:
        ask = ITEM_WORD.findall((body or "").translate(LOWER))
        for i in range(max(1, len(ask) - 12) if ask else 0):
            run = ask[i : i + 13]
            for j in range(len(found) - len(run) + 1):
                if found[j : j + len(run)] == run:
                    hit |= set(range(j, j + len(run)))
                    names.add(str(name))
    return len(found), len(hit), ",".join(sorted(names)), len(hit) > 0 and 20 * len(hit) >= len(found)


def test_overlap_with_items(spark):
    item = " ".join(f"Q{i}" for i in range(20))
    items = [(1, item), (2, "short one"), (3, ""), (4, None), (10, "short one"), (11, "Ünicode ok")]
    fill = " ".join(f"z{i}" for i in range(300))
    rows, schema = awkward("item_id")
    texts = [item.lower(), f"{fill} q3-{'-'.join(f'q{i}' for i in range(4, 18))}! {fill}", f"{fill} Short, ONE", "x ünicode OK", "xshort one", "short onex"]
    rows += [(100 + i, t, None, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema)
    got = dc.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == [*docs.columns, "overlap"]
    for r in got.collect():
        o = r.overlap
        n, hit, names, bad = plain_overlap(r.text, items)
        assert (o.n_words, o.n_hit, ",".join(o.items), o.contaminated) == (n, hit, names, bad)
        assert o.items_sha256 == hashlib.sha256(names.encode()).hexdigest()
        body = (r.text or "").encode()
        assert sum(len(ITEM_WORD.findall(body[s.start : s.end].decode().translate(LOWER))) for s in o.spans) == hit
    assert dc.decontaminate(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    none = dc.decontaminate(docs, spark.createDataFrame([], "item_id long, text string"), only_clean=True)
    assert none.count() == len(rows)
    with pytest.raises(ValueError, match="bytes"):
        dc.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), max_bytes=10)


CUT = {"line": re.compile(r"\n"), "paragraph": re.compile(r"[\x20\x09-\x0D]*\n[\x20\x09\x0B-\x0D]*\n[\x20\x09-\x0D]*"), "sentence": re.compile(r"\n|[.!?][ \t]+|[。！？]")}


def plain_units(text: str, unit: str) -> list[str]:
    """Units with the breaks behind them."""
    ends = [m.end() for m in CUT[unit].finditer(text)]
    return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True) if a < b]


def plain_dedup(rows: list[tuple], unit: str, min_words: int) -> dict[tuple, tuple]:
    """(number of units, kept text) by (id, text): repeated units in long runs of repeated units go."""
    first: dict = {}
    held = {(k, t): [(u, " ".join(WORD.findall(u)).translate(LOWER)) for u in plain_units(t or "", unit)] for k, t in rows}
    for (k, t), us in held.items():
        for p, (_, plain) in enumerate(us):
            place = (-1 if k is None else k, p)
            first[plain] = min(first.get(plain, place), place)
    out = {}
    for (k, t), us in held.items():
        runs, gone = [[]], set()
        for p, (_, plain) in enumerate(us):
            if plain and first[plain] < (-1 if k is None else k, p):
                runs[-1].append(p)
            elif plain:
                runs.append([])
        for run in runs:
            if sum(len(us[p][1].split(" ")) for p in run) >= min_words:
                gone |= set(run)
        out[k, t] = (sum(1 for _, plain in us if plain), len(gone), None if t is None else "".join(u for p, (u, _) in enumerate(us) if p not in gone))
    return out


@pytest.mark.parametrize("unit", ["sentence", "line", "paragraph"])
@pytest.mark.parametrize("min_words", [1, 8])
def test_units_keep_the_first(spark, unit, min_words):
    rng = random.Random(5)
    said = ["A b. ", "a  B. ", "c d\n", "One two three four! ", "five six?\t", "日本。", "seven eight nine ten eleven\n\n", "\n \n", " . ", "x", "twelve 3.5 e\u0301\r\n"]
    texts = ["".join(rng.choice(said) for _ in range(rng.randrange(1, 14))) for _ in range(60)] + [LONG, LONG[:-50] + " end. tail"]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(90, None, "k"), (91, "", "k"), (4, texts[4], "k"), (None, texts[7], "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dedup string").withColumns({"row": F.lit(1), "gone": F.lit(2), "h": F.lit(3)})
    got = ln.dedup_units(docs.repartition(3), unit=unit, min_words=min_words)
    assert got.columns == ["doc_id", "text", "row", "gone", "h", "dedup"]
    want = plain_dedup([r[:2] for r in rows], unit, min_words)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.dedup.n_units, r.dedup.n_removed, r.dedup.kept_text) == want[r.doc_id, r.text]
        cut = sorted((s.start, s.end) for s in r.dedup.removed)
        body, at, left = (r.text or "").encode(), 0, b""
        for a, b in cut:
            left, at = left + body[at:a], b
        assert (left + body[at:]).decode() == (r.dedup.kept_text or "") and len(cut) == r.dedup.n_removed
    assert ln.dedup_units(docs.limit(0), unit=unit).collect() == []


def test_a_short_shared_line_stays_and_a_shared_passage_goes(spark):
    said = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    passage = ". ".join(said(i, 9) for i in range(7)) + "."
    rows = [(1, f"{said(90, 20)} {passage} Read more\n{said(91, 20)}"), (2, f"{said(92, 20)}. {passage} {said(93, 10)}.\nRead more"), (3, f"{said(94, 30)}\nread  more\n")]
    kept = {r.doc_id: r.dedup.kept_text for r in ln.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept[1] == rows[0][1] and kept[3] == rows[2][1]
    assert kept[2] == f"{said(92, 20)}. {said(0, 9)}. {said(93, 10)}.\nRead more"  # its first sentence shared a line with other words


def test_packing_is_an_exact_round_trip(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    rng = random.Random(3)
    rows, schema = awkward("ids")
    blanks = [" ", "  ", "\n", "\n\n", " \n ", "\t", "\u3000", "\xa0", "\x1f"]
    rows += [(200 + i, "".join(rng.choice(["don't", "we'll", "x", "9", "..", "É", *blanks]) for _ in range(80)), None, None, None, None) for i in range(60)]
    docs = spark.createDataFrame(rows, schema).repartition(4)
    got = pk.pack(docs, path, window=64).collect()
    sequences: dict[int, list] = {}
    pieces: dict[tuple, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault((r.sequence_id * 64 + r.offset - r.start, r.doc_id), []).append(r)
    for s, held in sequences.items():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == [0, *np.cumsum([r.length for r in held])[:-1]]
        assert sum(r.length for r in held) == 64 or s == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))
    found = Counter()
    for (_, doc), held in pieces.items():
        held.sort(key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in held), dtype="<u4").tolist()
        assert len(ids) == held[0].doc_tokens
        found[(doc, tuple(ids))] += 1
    assert found == Counter((r[0], (*plain.encode(r[1] or "", add_special_tokens=False).ids, 1)) for r in rows)
    assert pk.pack(docs.limit(0), path).collect() == []
