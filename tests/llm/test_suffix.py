"""Exact substring deduplication against brute force."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from isograd.llm import columnwise, suffix
from isograd.llm.columnwise import common_prefixes, later_copies, sorted_suffixes, symbols


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(strings), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)


def common(a: bytes, b: bytes) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("block", [1, 7, columnwise.BLOCK])
@pytest.mark.parametrize("seed", range(8))
def test_construction_sorts_all_suffixes(seed, block, monkeypatch):
    monkeypatch.setattr(columnwise, "BLOCK", block)
    rng = random.Random(seed)
    letters = bytes([97, 98]) if seed % 2 else bytes([0, 97, 255])
    strings = [bytes(rng.choice(letters) for _ in range(rng.randrange(0, 14))) for _ in range(9)]
    strings.append(strings[0])
    data, offsets = joined(strings)
    size, symbol = np.diff(offsets), symbols(data, 1)
    of, length = sorted_suffixes(symbol, offsets[1:], size)
    suffixes = [(strings[o][len(strings[o]) - n :], o) for o, n in zip(of, length, strict=True)]
    assert suffixes == sorted((s[i:], o) for o, s in enumerate(strings) for i in range(len(s) + 1))
    long = length >= 3
    start = offsets[1:][of[long]] - length[long]
    held = [data[a:].tobytes() for a in start]
    assert common_prefixes(symbol, start[:-1], start[1:], 3).tolist() == [min(3, common(a, b)) for a, b in zip(held, held[1:], strict=False)]


@pytest.mark.parametrize("width", [6, 7, 10])
def test_later_copies_match_brute_force(width):
    rng = random.Random(5)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 60))) for _ in range(20)]
    seen, expected = set(), set()
    for o, s in enumerate(strings):
        for i in range(len(s) - width + 1):
            (expected.add((o, i)) if s[i : i + width] in seen else seen.add(s[i : i + width]))
    of, start = later_copies(*joined(strings), width)
    assert set(zip(of.tolist(), start.tolist(), strict=True)) == expected


def brute(rows: list[tuple[int | None, str | None]], width: int) -> dict:
    """Bytes that stay and spans that go, by row."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for row in order:
        body = (row[1] or "").encode()
        gone = np.zeros(len(body), dtype=bool)
        for i in range(len(body) - width + 1):
            if body[i : i + width] in seen:
                gone[i : i + width] = True
            seen.add(body[i : i + width])
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[row] = (len(body), int(gone.sum()), int((edge == 1).sum()), bytes(b for b, g in zip(body, gone, strict=True) if not g))
    return out


def corpus(seed: int) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    vocabulary = ["da", "élan", "mond", "rivière", "of", "to", "xyz", "日本"]
    prose = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(n))
    shared = [prose(40), prose(25), prose(60)]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(40):
        parts = [prose(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(shared), prose(rng.randrange(0, 10))]
        rows.append((i, " ".join(parts)))
    rows += [(100, "ab" * 300), (101, "ab" * 120), (102, "a" * 400), (103, rows[3][1]), (104, ""), (105, None), (None, rows[5][1]), (7000, prose(3000))]
    rows += [(103, rows[3][1])]  # a repeated row
    return rows


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
def test_documents_match_brute_force(spark, hot):
    rows = corpus(1)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_removed string").repartition(5)
    found = suffix.dedup_substrings(docs, hot=hot)
    assert found.columns == ["doc_id", "text", "n_removed", "dedup"]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") , (r.dedup.n_bytes, r.dedup.n_removed, r.dedup.n_spans, bytes(r.dedup.kept))) for r in found.collect())
    expected = brute(rows, suffix.WIDTH)
    assert got == sorted(((r[0] is None, r[0] or 0, r[1] or ""), expected[r]) for r in rows)


def test_results_do_not_depend_on_the_size_of_groups(spark):
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [
        sorted((r.doc_id or -1, r.text or "", bytes(r.dedup.kept)) for r in suffix.dedup_substrings(docs, **sizes).collect())
        for sizes in ({}, {"shard_bytes": 1000, "bucket_bytes": 100})
    ]
    assert got[0] == got[1] and any(kept != text.encode() for _, text, kept in got[0])


@pytest.mark.parametrize("hot", [suffix.HOT, 1])
@pytest.mark.parametrize("partitions", [1, 6])
def test_repeated_rows_are_one_document(spark, hot, partitions):
    rows = corpus(4)[:30]
    first, last, other = (" ".join(f"{letter}é{i * i}" for i in range(70)) for letter in "flo")
    near = first[:150] + "#" + first[150:]
    # Texts that occur nowhere earlier, in rows with and without an id, and later documents that share a part of them.
    rows += [(50, first)] * 3 + [(51, near)] * 2 + [(60, "x" + first[40:])] + [(None, last)] * 3 + [(None, other + near)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    found = suffix.dedup_substrings(docs, hot=hot).collect()
    got = sorted(((r.doc_id, r.text, r.dedup.n_bytes, r.dedup.n_removed, r.dedup.n_spans, bytes(r.dedup.kept)) for r in found), key=order)
    expected = brute(rows, suffix.WIDTH)
    assert got == sorted(((*r, *expected[r]) for r in rows), key=order)
    assert [r[3] for r in got if r[1] in (first, last)] == [0] * 6


def test_spans_name_the_removed_bytes_and_characters_stay_whole(spark):
    rows = corpus(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in suffix.dedup_substrings(docs, characters=True).collect():
        body, at, kept = (r.text or "").encode(), 0, b""
        for s in r.dedup.removed:
            kept += body[at : s.start]
            at = s.end
        assert kept + body[at:] == bytes(r.dedup.kept)
        bytes(r.dedup.kept).decode()


def test_slices_of_very_long_texts_agree(monkeypatch):
    data = np.frombuffer(corpus(3)[-2][1].encode() * 3, dtype=np.uint8)
    offsets = np.array([0, len(data)])
    covered = lambda parts: sorted(p for f, n in zip(parts[1].tolist(), parts[2].tolist(), strict=True) for p in range(f, f + n))
    whole = suffix.cut(data, offsets)
    monkeypatch.setattr(suffix, "_SLICE", 2000)
    sliced = suffix.cut(data, offsets)
    assert covered(whole) == covered(sliced) == list(range(len(data) - suffix.WIDTH + 1))


def test_columns_may_have_any_name(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "a", "b", "c", "d"), (2, "x " + text, "a", "b", "c", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __k string, __H string, __marks string, marks string")
    got = {r.doc_id: r for r in suffix.dedup_substrings(docs).collect()}
    assert got[1].dedup.n_removed == 0 and bytes(got[2].dedup.kept) == b"x " and got[2].marks == "d" and got[2]["__k"] == "a"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.dedup_substrings(docs).collect() == []


def test_transforms_of_usual_buckets_stay_in_memory(monkeypatch, tmp_path):
    texts = [t.encode() for _, t in corpus(7) if t]
    data, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = later_copies(data, offsets, suffix.WIDTH, folder=str(tmp_path / "no such folder"))
    monkeypatch.setattr(columnwise, "HELD", 1000)
    monkeypatch.setattr(columnwise, "BLOCK", 500)
    with pytest.raises(FileNotFoundError):  # larger ones go to disk
        later_copies(data, offsets, suffix.WIDTH, folder=str(tmp_path / "no such folder"))
    on_disk = later_copies(data, offsets, suffix.WIDTH, folder=str(tmp_path))
    assert len(found[0]) and all(a.tolist() == b.tolist() for a, b in zip(found, on_disk, strict=True))


def test_batches_of_sent_pieces_follow_their_bytes(monkeypatch):
    """A task sends a row to each shard, but not a batch for each row."""
    rows = [(i, 7, t) for i, (_, t) in enumerate(corpus(8)) if t]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["k", "h", "t"])

    class Table:
        select = lambda self, *columns: self
        mapInArrow = lambda self, run, schema: list(run([batch]))  # noqa: E731, N815

    def pieces_of(batches):
        sent = pa.Table.from_batches(batches).to_pylist()
        kinds = dict(a=np.uint64, s=np.uint64, k=np.int64, h=np.int64, p=np.uint32, n=np.uint16)
        return sorted((r["kind"], r["shard"], *piece) for r in sent for piece in zip(*(np.frombuffer(r[c], t).tolist() for c, t in kinds.items()), strict=True))

    few = suffix._sent(Table(), suffix.WIDTH, suffix.GRAM, 500)
    assert len(few) == 2
    monkeypatch.setattr(suffix, "BATCH_BYTES", 1)
    many = suffix._sent(Table(), suffix.WIDTH, suffix.GRAM, 500)
    assert len(many) == sum(b.num_rows for b in few) > 300
    assert pieces_of(few) == pieces_of(many)


@pytest.mark.parametrize("width", [1, 2, 3, 64, 73, 300])
def test_least_in_windows(width):
    keys = np.random.default_rng(width).integers(0, 1 << 63, 300, dtype=np.uint64)
    assert suffix._least_in_windows(keys, width).tolist() == [min(keys[i : i + width].tolist()) for i in range(301 - width)]
