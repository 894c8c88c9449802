"""Language identification, language-model scoring, URL filters and licence scans."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import awkward

from isograd.llm import language as lg
from isograd.llm import licences as lc
from isograd.llm import lm
from isograd.llm import urls as ur
from isograd.llm.queries import LLM_QUERIES, URL_RULES, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_phrases(text: bytes, sample: list[bytes]) -> int:
    fold = lambda b: bytes(lg._FOLD[np.frombuffer(b, np.uint8)])
    known, text, count, at = [fold(s) for s in sample], fold(text), 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and any(text[at : at + size + 1] in s for s in known):
            size += 1
        at += size
        count += 1
    return count


@pytest.mark.parametrize("block", [1, 3, 16, 512])
def test_phrases_are_longest_matches_across_blocks(block):
    samples = {"en": [b"the cat sat on the mat", b"a dog and the cat aaaaa"], "fr": ["le chat était là".encode(), b"un chien et le chat"]}
    model = lg.Model(samples)
    texts = [b"the cat and the dog", "le chien était là, ZZ the".encode(), b"", b"qqq", b"The Cat 12 sat!" * 9, b"the cat sat on the mat" * 60]
    texts += [b"a" * 1701, b"za" + b"a" * 700, b"dog" * 555 + b"cat", b"t", b""]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = model.phrases(np.frombuffer(b"".join(texts), np.uint8), offsets, block=block)
    for row, lang in zip(got, model.languages, strict=True):
        assert row.tolist() == [plain_phrases(t, samples[lang]) for t in texts]


def test_phrases_of_whole_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    samples = lg.sample(docs, "doc_id", "text", "lang", per_language=6)
    texts = [(r.text or "").encode() for r in docs.orderBy("doc_id").limit(40).collect()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    model = lg.Model(samples)
    got = model.phrases(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for row, lang in zip(got, model.languages, strict=True):
        assert row.tolist() == [plain_phrases(t, samples[lang]) for t in texts]


def test_language_is_found_on_held_out_documents(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").collect()}
    rows = LLM_QUERIES["op2_language"](spark, sf_dir).collect()
    assert len(rows) == len(truth)
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.98 * len(out)


def test_language_of_awkward_rows(spark):
    rows, schema = awkward("score")
    docs = spark.createDataFrame(rows, schema)
    samples = lg.sample(docs, "doc_id", "text", "lang")
    found = {r.text: r.language.lang for r in lg.identify(docs, samples).collect()}
    assert found[None] == found[""] == found[" \n\t "] == found["!!! ??? 123"] == "und" and found["日本語 テキスト\nzwei\n\nzwei"] == "en"
    assert {r.language.lang for r in lg.identify(docs, {}).collect()} == {"und"}
    assert lg.identify(docs.limit(0), samples).collect() == [] and lg.sample(docs.limit(0), "doc_id", "text", "lang") == {}


def test_more_languages_than_one_table_holds(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i, j: letters[i % 26] + letters[(i * 7 + j) % 26] + letters[(i // 26 * 5 + j * 3) % 26]
    texts = {f"l{i:02}": " ".join(word(i, j) for j in range(40)) for i in range(lg.MAX_LANGUAGES + 7)}
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(texts.items())], "doc_id long, text string, lang string")
    samples = lg.sample(docs, "doc_id", "text", "lang")
    assert sorted(samples) == sorted(texts)
    found = {r.lang: r.language.lang for r in lg.identify(docs, samples).collect()}
    assert found == {x: x for x in texts}
    held = [t.encode() for t in texts.values()] + [b"", b"the cat", b"123"]
    data, offsets = np.frombuffer(b"".join(held), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in held])])
    one, several = lg.Model(samples).judge(data, offsets), lg.Models(samples, 5).judge(data, offsets)
    assert all(list(one[c]) == list(several[c]) for c in one)


def plain_scores(rows: list[tuple], order: int, strength: float) -> dict:
    """Probabilities by the recursive definition, from counters."""
    split = lambda t: ["<s>", *WORD.findall((t or "").translate(LOWER)), "</s>"]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts: Counter = Counter()
    for i, t in rows:
        if not out(i):
            toks = split(t)
            counts[("<s>",)] += 1
            for n in range(1, order + 1):
                counts.update(tuple(toks[j - n + 1 : j + 1]) for j in range(max(1, n - 1), len(toks)))
    total = sum(c for g, c in counts.items() if len(g) == 1 and g != ("<s>",))
    types = sum(1 for g in counts if len(g) == 1 and g != ("<s>",))

    def p(gram: tuple) -> float:
        if len(gram) == 1:
            return (counts[gram] + 1) / (total + types + 1)
        return (counts[gram] + strength * p(gram[1:])) / (counts[gram[:-1]] + strength)

    found = {}
    for i, t in rows:
        toks = split(t)
        base = sum(math.log10((counts[(w,)] + 1) / (total + types + 1)) for w in toks[1:])
        score = sum(math.log10(p(tuple(toks[max(0, j - order + 1) : j + 1]))) for j in range(1, len(toks)))
        known = sum(counts[(w,)] > 0 for w in toks[1:])
        found[(i, t)] = (out(i), len(toks) - 1, known, total, base, score)
    return found


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_the_definition(spark, sf_dir, order):
    rows, schema = awkward("score")
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").orderBy("doc_id").limit(150).collect()]
    everything = [(r[0], r[1]) for r in rows] + [(5000 + i, t) for i, t in docs]
    df = spark.createDataFrame([(*r, "x") for r in everything], "doc_id long, text string, known string").repartition(6)
    got = lm.score(df, lm.held_out(df["doc_id"]), order=order, block_bytes=40_000).collect()
    expected = plain_scores(everything, order, lm.STRENGTH)
    key = lambda v: (v[0] is None, v[0] or 0, v[1:])
    ours = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got), key=key)
    theirs = sorted(((i, *e[:4], round(e[4], 6), round(e[5], 6)) for (i, t), e in ((r, expected[r]) for r in everything)), key=key)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-5) and a[6] == pytest.approx(b[6], abs=1e-5)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_segments_of_a_text_change_nothing(order):
    rng = np.random.default_rng(order)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "e"], n)).encode() for n in (0, 1, 2, 7, 40, 41, 400)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes, text, is_start = lm.tokens(data, offsets)
    levels = lm.grams(hashes, text, is_start, order)
    keys, at = np.unique(np.concatenate([g for g, _ in levels]), return_inverse=True)
    parts = np.split(at, np.cumsum([len(g) for g, _ in levels])[:-1])
    train = text < 6
    used = np.concatenate([train[text[last]] for _, last in levels])
    known = np.bincount(at[used], minlength=len(keys))
    machine = lm.Automaton(levels, parts, known, 2.0, 500, 6, 6, len(hashes))
    whole = machine.read(10_000)
    assert len(whole) == sum(len(t.split()) + 1 for t in texts)
    for segment in (1, 2, 5, 64):
        assert machine.read(segment).tolist() == whole.tolist()


def test_scores_do_not_depend_on_blocks_and_shards(spark):
    rows = [(i, f"w{i % 3} w{i % 5} x w{i % 7}") for i in range(60)] + [(60, "w1 x w2 " * 900), (61, None), (61, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    key = lambda df: sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in df.collect())
    few = key(lm.score(docs, lm.held_out(docs["doc_id"]), order=3))
    many = key(lm.score(docs, lm.held_out(docs["doc_id"]), order=3, block_bytes=100, shard_bytes=300))
    assert len(few) == len(rows) and few == many


def test_scores_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(docs, lm.held_out(docs["doc_id"])).collect() == []


def plain_url(url: str | None) -> tuple[str, str, str | None]:
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fits = []
    for rule in URL_RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


def test_urls_follow_rules_and_the_model(spark):
    bad = ["http://free-casino.example.com/en/5", "https://www.spam-farm.example.org/de/1"]
    good = ["http://thanst.example.com/en/5?x=1", "https://blog.tionre.example.org/de/4518#top", "http://library.example.com/"]
    odd = [None, "", "no scheme", "http://", "HTTP://A.NET", "http://A.B.NET/x?y", "http://net/", "x://example.net/en/q#z", "x://a.example.com/de/",
           "http://EXAMPLE.ORG/fr/a://b/c", "http://exnet/", "http://é.org/fr/", "http://h.example.com/" + "p/" * 5000, "a\nb://c.net/d\ne"]
    rows = [(i, u, "x") for i, u in enumerate(bad + good + odd)] + [(0, bad[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    weights = ur.train(ur.labelled(spark))
    got = ur.filter_urls(pages, URL_RULES, weights)
    assert got.columns == [*pages.columns, "judged"]
    for r in got.collect():
        assert (r.judged.host, r.judged.path, r.judged.rule) == plain_url(r.url)
        if r.judged.rule:
            assert r.judged.verdict == URL_RULES[r.judged.rule]
        elif r.url in bad + good:
            assert r.judged.verdict == ("block" if r.url in bad else "allow"), (r.url, r.judged.score)
        assert 0 <= r.judged.score <= 1 and r.judged.verdict in ("block", "allow")
    assert ur.filter_urls(pages.limit(0), URL_RULES, weights).collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_licence_notices_are_found(spark, sf_dir):
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC": "Licensed under CC BY-NC 4.0."}
    docs = table(spark, sf_dir, "documents")
    expected = {r.doc_id: sorted({f for f, x in lines.items() if x in (r.text or "").split("\n")}) for r in docs.collect()}
    got = {r.doc_id: r.families for r in LLM_QUERIES["op8_licences"](spark, sf_dir).collect()}
    assert len(got) == len(expected) and any(expected.values())
    assert {i: f for i, f in got.items() if f != ",".join(expected[i])} == {}


def test_reserved_rights_are_found(spark, sf_dir):
    expected = {r.doc_id: "All rights reserved." in (r.text or "").split("\n") for r in table(spark, sf_dir, "documents").collect()}
    got = {r.doc_id: (r.restrictions, r.n_notices > 0) for r in LLM_QUERIES["op8_licences"](spark, sf_dir).collect()}
    assert len(got) == len(expected) and any(expected.values())
    assert {i: g for i, g in got.items() if g[0] != ("Proprietary" if expected[i] else "") or expected[i] > g[1]} == {}


def test_restrictions_and_licences_of_lines(spark):
    none = ["Copyright 2020 the authors", "All rights of the farmers were restored", "All tables are reserved for the guests", "The letters were kept confidential"]
    closed = ["All rights reserved.", "Copyright (c) 2024 Example Corp. All rights reserved.", "PROPRIETARY AND CONFIDENTIAL", "© 2019 Jane Doe, all rights reserved",
              "Unauthorized copying of this file is strictly prohibited."]
    given = ["Released under the MIT License. All rights reserved.", "Copyright 2020 the authors. Licensed under the BSD 3-Clause License. All rights reserved."]
    lines = none + closed + given
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.text: (list(r.licences.families), list(r.licences.restrictions)) for r in lc.scan_licences(docs, lc.background(docs)).collect()}
    expected = [([], [])] * len(none) + [([], ["Proprietary"])] * len(closed) + [(["MIT"], []), (["BSD"], [])]
    assert found == dict(zip(lines, expected, strict=True))


def test_licences_of_awkward_rows(spark):
    rows, schema = awkward("families")
    notice = "This file is Licensed under the Mozilla Public License 2.0, see LICENSE"
    rows += [(300, f"é\n{notice}\nmore text", None, None, None, None), (301, "A licensed driver had a general license.", None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    found = {r.doc_id: r.licences for r in lc.scan_licences(docs, lc.background(docs)).collect()}
    assert [n.family for n in found[300].notices] == ["MPL-2.0"] and found[301].n_notices == 0 and found[5].n_paragraphs == 0
    span = found[300].notices[0]
    assert f"é\n{notice}\nmore text".encode()[span.start : span.end].decode() == notice
    assert lc.scan_licences(docs.limit(0), []).collect() == []


def plain_notices(text: str, model: lc.Classifier) -> list[tuple]:
    """The scan by its definition: runs of lines, sets of word pairs, and one text judged at a time."""
    split = lambda t: re.findall(r"[a-z0-9\x80-\xff]+", t.lower().encode().decode("latin-1"))
    pairs = lambda t: set(itertools.pairwise(split(t)))
    templates = [(f, pairs(n)) for f, notices in lc.TEMPLATES.items() for n in notices]
    owners: dict = {}
    for f, held in templates:
        for x in held:
            owners.setdefault(x, set()).add(f)
    lines, closed, found = text.split("\n"), set(), []
    for size in range(1, lc.WRAP + 1):
        for i in range(len(lines) - size + 1):
            run = range(i, i + size)
            if closed & set(run) or not all(split(lines[j]) for j in run):
                continue
            mine = pairs(" ".join(lines[j] for j in run))
            met = {f for f, held in templates if len(mine & held) >= max(lc.CONFIRM * len(held), min(2, len(held))) and any(len(owners[x]) == 1 for x in mine & held)}
            if not met:
                continue
            closed |= set(run)
            body = "\n".join(lines[j] for j in run)
            z = model._matrix(lc._grams_of([body])) @ model.weights / model.temperature
            label = model.families[int(z[0].argmax())]
            if label in met:
                more = set() if label in lc.RESTRICTIONS else met - lc.RESTRICTIONS
                start = len("\n".join(lines[:i]).encode()) + (i > 0)
                found += [(start, start + len(body.encode()), f) for f in sorted({label} | more)]
    return sorted(found)


WRAPPED = {
    "MIT": "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files (the Software), to deal",
    "BSD": "Redistribution and use in source and binary forms, with or\nwithout modification, are permitted provided that the\nfollowing conditions are met:",
    "GPL": "This program is free software: you can redistribute it\nand/or modify it under the terms of the GNU General\nPublic License as published by",
    "ISC": "Permission to use, copy, modify, and/or distribute this\nsoftware for any purpose with or without fee is hereby\ngranted, provided",
}


def test_wrapped_notices_are_found():
    model = lc.Classifier([])
    for family, notice in WRAPPED.items():
        for text in (notice, f"some words of a story\n\n{notice}\n\nmore of it", f"A line before\n{notice}\nand a line after"):
            held = text.encode()
            found = model.scan(np.frombuffer(held, np.uint8), np.array([0, len(held)]))
            assert found["families"] == [[family]], (text, found)
            for n in found["notices"][0]:
                assert held[n["start"] : n["end"]].decode() in text and held[n["start"]] != 10
    apart = "Redistribution and use in source and\n\nbinary forms, with or without modification".encode()
    assert model.scan(np.frombuffer(apart, np.uint8), np.array([0, len(apart)]))["families"] == [[]]


def test_identifiers_outside_the_list_are_unknown():
    model = lc.Classifier([])
    cases = {"SPDX-License-Identifier: EPL-2.0": [], "SPDX-License-Identifier: MPL-2.0": ["MPL-2.0"], "SPDX-License-Identifier: ISC": ["ISC"],
             "This is free and unencumbered software released into the public domain.": ["Unlicense"],
             "Released under the Apache 2.0 license and the MIT License": ["Apache-2.0", "MIT"]}
    for text, families in cases.items():
        held = text.encode()
        assert model.scan(np.frombuffer(held, np.uint8), np.array([0, len(held)]))["families"] == [families], text


def test_licence_scan_equals_its_definition(spark, sf_dir):
    docs = [r.text or "" for r in table(spark, sf_dir, "documents").orderBy("doc_id").limit(120).collect()]
    lines = [n for x in WRAPPED.values() for n in x.split("\n")] + [n for x in lc.TEMPLATES.values() for n in x] + lc.NEAR_MISSES + ["", " ", "!!", "é word"]
    rng = np.random.default_rng(5)
    texts = docs + ["\n".join(rng.choice(lines, n)) for n in (0, 1, 5, 30, 80)] + list(WRAPPED.values()) + ["", "\n", "\n\n"]
    model = lc.Classifier([t[:300] for t in docs[:20]])
    held = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in held])]).astype(np.int64)
    got = model.scan(np.frombuffer(b"".join(held), np.uint8), offsets)
    assert sum(got["n_notices"]) > 20
    for text, notices in zip(texts, got["notices"], strict=True):
        assert sorted((n["start"], n["end"], n["family"]) for n in notices) == plain_notices(text, model)
