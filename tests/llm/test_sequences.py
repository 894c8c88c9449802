"""Order MinHash, periodic runs and the conversation trie against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import awkward

from isograd.llm import fingerprints as fp
from isograd.llm import runs as rn
from isograd.llm import trie as tr
from isograd.llm.queries import LLM_QUERIES, rebuilt, table, with_periods

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- Order MinHash ------------------------------------------------------------


def plain_sketch(text: str) -> str:
    """Every order by itself: all k-mers ranked, the least ones in text order."""
    body = text.encode()
    hashes, _ = fp.numbered_kmers(np.frombuffer(body, dtype=np.uint8), np.array([0, len(body)]))
    grams, seen, names = [text[i : i + fp.K] for i in range(max(len(text) - fp.K + 1, min(len(text), 1)))], defaultdict(int), []
    for g in grams:
        names.append((g, seen[g]))
        seen[g] += 1
    assert len(hashes) == len(names) and len(set(zip(names, hashes.tolist(), strict=True))) == len(set(hashes.tolist())) == len(set(names))
    out = []
    for seed in fp.SEEDS.tolist():
        ranked = sorted(range(len(names)), key=lambda i: (int(hashes[i]) - seed) % (1 << 64))  # noqa: B023
        value = np.zeros(1, dtype=np.uint64)
        for i in sorted((ranked * fp.TUPLE)[: fp.TUPLE]):
            value = fp.mix(value * fp._STEP + hashes[i])
        out.append(int(value[0]) >> 32 if names else 0)
    return "".join(f"{v:08x}" for v in out)


def agreement(a: str, b: str) -> float:
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / fp.ORDERS


def plain_neighbours(rows: list[tuple]) -> list[tuple]:
    """Results by following the ordered different documents round; one row for each copy."""
    texts = [(k, t or "") for k, t in rows]
    order = sorted(set(texts), key=lambda r: (r[0] is not None, r[0] or 0))
    after = {r: order[(i + 1) % len(order)][1] for i, r in enumerate(order)}
    out = []
    for k, t in texts:
        q = len(t) // 4
        changed = t[: len(t) - q] + after[k, t][:q]
        a, b, c = plain_sketch(t), plain_sketch(changed), plain_sketch(after[k, t])
        out.append((k, len(t), sha(changed), a, b, agreement(a, b), agreement(a, c)))
    return out


@pytest.mark.parametrize("copies", [1, 40])
def test_neighbours_against_brute_force(spark, copies):
    rows, schema = awkward("fingerprint")
    rng = random.Random(2)
    said = lambda n: "".join(rng.choice(["da ", "él", "mond\n", "où", "日本", "x"]) for _ in range(n))
    rows = [(r[0], r[1] if r[1] is None or len(r[1]) < 9000 else r[1][:9000], *r[2:]) for r in rows if r[0] is not None] + [
        (100 + 3 * i, said(rng.randrange(60)), None, None, None, None) for i in range(40)
    ]
    rows += [(None, "no id", None, None, None, None)] + [(103, said(50), None, None, None, None)] * copies
    rows = [r for r in rows if r[0] != 103 or r[1] == rows[-1][1]]  # documents of one id are ordered by a hash of the text
    docs = spark.createDataFrame(rows, schema).repartition(5)
    got = sorted((tuple(r) for r in fp.compare_neighbours(docs).collect()), key=repr)
    assert got == sorted(plain_neighbours([r[:2] for r in rows]), key=repr)


def test_neighbours_of_few_rows(spark):
    schema = "doc_id long, text string"
    assert fp.compare_neighbours(spark.createDataFrame([], schema)).collect() == []
    alone = fp.compare_neighbours(spark.createDataFrame([(4, "abcdefgh")] * 3, schema)).collect()
    assert [tuple(r) for r in alone] == plain_neighbours([(4, "abcdefgh")] * 3) and alone[0].near_next == 1
    nulls = fp.compare_neighbours(spark.createDataFrame([(None, None), (None, ""), (2, None)], schema)).collect()
    assert {(r.doc_id, r.n_chars, r.near_edited, r.near_next) for r in nulls} == {(None, 0, 1.0, 1.0), (2, 0, 1.0, 1.0)} and len(nulls) == 3
    words = fp.compare_neighbours(spark.createDataFrame([("b", "x" * 50), ("a", "y" * 50)], "name string, body string"), "name", "body")
    assert sorted(r.name for r in words.collect()) == ["a", "b"]


def test_likeness_follows_the_edit_distance(spark):
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(600))
    half = len(text) // 2
    texts = [text, text.replace("w77", "w7", 3), text[: len(text) * 9 // 10], text[half:] + text[:half], " ".join(reversed(text.split())), text[::-1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint.fingerprint for r in fp.fingerprint(docs).collect()}
    near = [agreement(got[0], got[i]) for i in range(6)]
    assert near[0] == 1 and near[1] > 0.85 and near[2] > 0.6 and near[1] > near[3] > near[5] == 0
    # reversed words share most k-mers, but hardly any order
    assert near[4] < 0.3
    pair = spark.createDataFrame([(got[0], got[3])], "a string, b string")
    assert pair.select(fp.likeness("a", "b").alias("x")).first().x == near[3]


# --- Periodic runs ------------------------------------------------------------


def plain_runs(w: list[str], least: int = 12) -> list[tuple]:
    found: dict = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= max(q, least - q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(w: list[str], runs: list[tuple]) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            n, k = rng.randrange(0, 80), rng.choice([1, 2, 3, 5, 30])
            w = [f"w{rng.randrange(k)}" for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randrange(2, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(" ".join(w))
        body = "".join(texts).encode()
        least = rng.choice([12, 12, 2, 3, 5])
        got = rn.measure(np.frombuffer(body, dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), least)
        for t, r in zip(texts, got["runs"], strict=True):
            assert r == plain_runs(t.split(), least)


def test_runs_of_awkward_rows(spark):
    rows, schema = awkward("periodic")
    rows += [(300, "a b c " * 9 + "a b", None, None, None, None), (301, "x\n" * 11, None, None, None, None), (302, "x\t" * 12, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    got = rn.periodic_runs(docs)
    assert got.columns == [*docs.drop("periodic").columns, "periodic"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        w = WORD.findall(r.text or "")
        runs = [tuple(x) for x in r.periodic.runs]
        assert r.periodic.n_words == len(w) and r.periodic.collapsed == plain_collapsed(w, runs)
        if len(w) < 3000:
            assert runs == plain_runs(w)
    kept = {r.doc_id: r.periodic.collapsed for r in found}
    assert kept[300] == "a b c" and kept[301] == " ".join("x" * 11) and kept[302] == "x"
    assert rn.periodic_runs(docs.limit(0)).collect() == []


def plain_periods(doc_id, text: str | None) -> list[str]:
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_on_the_test_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    seen = 0
    for r in LLM_QUERIES["op12_periodic_runs"](spark, sf_dir).collect():
        w = plain_periods(r.doc_id, texts[r.doc_id])
        if len(w) > 600:
            continue
        runs = plain_runs(w)
        seen += bool(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        want = (len(runs), *best, 1000 * best[1] // best[2]) if best else (0, None, None, None, None)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r.collapsed_sha256 == sha(plain_collapsed(w, runs))
    assert seen > 20


def test_periods_of_rows_without_id_or_words(spark):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    rows = [(None, "a b"), (ids[0], None), (ids[1], " \n"), (ids[2], "one"), (ids[3], "one two three four five six seven")]
    got = {r.doc_id: r.text for r in with_periods(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows[1:]:
        assert WORD.findall(got[i] or "") == plain_periods(i, t)
    assert got[None] == "a b"


# --- Conversation trie --------------------------------------------------------


def plain_trie(sequences: dict[int, list[tuple]]) -> list[tuple]:
    members, last = defaultdict(list), {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        out = [node]
        for x in out:
            out.extend(kids[x])
        return out

    rows = []
    for node, held in members.items():
        sub = below(node)
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in sub if x)
        ends = sorted(c for c in held if len(sequences[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        rows.append((min(held), len(node), up, len(held), len(kids[node]), sum(not kids[x] for x in sub), saved, sha(",".join(map(str, ends)))))
        last[min(held), len(node)] = node
    assert len(last) == len(rows)
    return rows


def plain_rebuilt(sequences: dict[int, list[tuple]]) -> dict[int, list[tuple]]:
    out = {}
    for c, turns in sequences.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = sequences.get(c - c % 20, [])[:h] + turns[h:]
    return out


def test_trie_on_the_test_table(spark, sf_dir):
    sequences = defaultdict(list)
    for r in table(spark, sf_dir, "conversations").orderBy("conv_id", "turn").collect():
        sequences[r.conv_id].append((r.role or "", r.text or ""))
    got = LLM_QUERIES["op13_conversation_trie"](spark, sf_dir)
    want = plain_trie(plain_rebuilt(sequences))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr)


def conversations(seed: int) -> list[tuple]:
    """Short and long conversations that share beginnings, with nulls and turns out of order."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 90):
        n = rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 30])
        same = rng.choice([0, 2, n, n])
        for i in range(n):
            said = f"turn {i}  of all\n{'x ' * (i % 3)}" if i < same else rng.choice([None, "", f"own {rng.randrange(4)}"])
            rows.append((c, None if i == 0 else i, rng.choice([None, ""]) if i == 1 else "user" if i < same else rng.choice(["user", "bot"]), said, "k"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [8, 3])
def test_trie_against_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(tr, "WIDTH", width)
    monkeypatch.setattr(tr, "CHUNK", 4)
    rows = conversations(width)
    sequences = defaultdict(list)
    for c, _, role, text, _ in sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        sequences[c].append((role or "", text or ""))
    turns = spark.createDataFrame([*rows, (None, 1, "user", "of no conversation", "k")], "conv_id long, turn long, role string, text string, pos string")
    got = tr.conversation_trie(turns.repartition(4))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_trie(sequences), key=repr)
    again = tr.prefix_trie(*rebuilt(tr.numbered(tr.turn_ids(turns))))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(plain_trie(plain_rebuilt(sequences)), key=repr)


def test_trie_of_few_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert tr.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    same = [(7, 1, "user", "a b")] * 3 + [(8, 1, "user", "a b")] * 2  # repeated rows are turns of their own
    got = {(r.conv_id, r.depth): r for r in tr.conversation_trie(spark.createDataFrame(same, schema)).collect()}
    assert sorted(got) == [(7, 0), (7, 1), (7, 2), (7, 3)]
    assert got[7, 0].saved_tokens == 4 and got[7, 2].ends_sha256 == sha("8") and got[7, 3].ends_sha256 == sha("7")
    # conversations without turns are members of the root alone
    rows = tr.numbered(tr.turn_ids(spark.createDataFrame(same, schema)))
    root = tr.prefix_trie(rows, spark.createDataFrame([(7,), (8,), (1,), (12,)], "conv_id long")).where("depth = 0").first()
    assert (root.conv_id, root.n_convs, root.ends_sha256) == (1, 4, sha("1,12"))
    turnless = tr.prefix_trie(rows.limit(0), spark.createDataFrame([(5,)], "conv_id long")).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_leaves, r.saved_tokens) for r in turnless] == [(5, 0, 1, 1, 0)]


def test_one_conversation_fills_several_parts(spark):
    """Positions are counted over the parts of a range shuffle."""
    rows = [(5, 99 - i if i < 100 else None, "user", f"t{i}") for i in range(104)] + [(c, 0, "user", "x") for c in range(5)]
    ids = tr.turn_ids(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = tr.numbered(ids).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.part for r in got if r.conv_id == 5}) > 1
    assert sorted(r.pos for r in got if r.conv_id == 5) == list(range(104))
    assert {r.pos for r in got if r.conv_id < 5} == {0}
