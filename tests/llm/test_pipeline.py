"""The corpus pipeline, stage by stage against brute force."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from test_minhash import plain_classes
from test_rules import plain_overlap, plain_quality, plain_share
from test_suffix import brute

import corpus_pipeline
from isograd.llm import quality
from isograd.llm.queries import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, folder) -> tuple[str, list[tuple]]:
    rng = random.Random(8)
    prose = lambda n: " ".join(f"{rng.choice(['da', 'élan', 'mond', 'où'])}{rng.randrange(3000)}" for _ in range(n))
    item = " ".join(f"q{i}" for i in range(18))
    shared = prose(60)
    texts = [prose(80) for _ in range(12)] + ["short", None, "", prose(30) + " same line\n" * 90]
    texts += [texts[0], texts[1] + " tail", f"{prose(40)} {shared} {prose(30)}", f"{prose(20)} {shared} {prose(50)}", f"{prose(60)} {item} {prose(10)}"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_every_stage_matches_brute_force(spark, tmp_path):
    sf, rows = fixture(spark, tmp_path / "sf")
    docs, stages = table(spark, sf, "documents"), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "shared_passages", "benchmark_overlap", "packing"]

    first = stages["quality_rules"](spark, docs, sf)
    want = [r for r in rows if not plain_quality(r[1])[5] and all(plain_share(r[1], n) <= x for n, x in quality.NGRAM_LIMITS.items())]
    assert first.columns == docs.columns and sorted(map(tuple, first.collect())) == sorted(want)

    second = stages["near_duplicates"](spark, first, sf)
    group = plain_classes([(r[0], r[1]) for r in want])
    want = [r for r in want if group[r[0]] == r[0]]
    assert second.columns == docs.columns and sorted(map(tuple, second.collect())) == sorted(want) and len(want) < 19

    third = stages["shared_passages"](spark, second, sf)
    assert third.columns == docs.columns
    gone = brute([(r[0], r[1]) for r in want], 100)
    kept = {r.doc_id: r for r in third.collect()}
    assert sorted(kept) == sorted(r[0] for r in want) and sum(v[1] > 0 for v in gone.values()) == 1
    for r in want:
        n_bytes, removed, _, _ = gone[(r[0], r[1])]
        text = kept[r[0]].text
        assert 0 <= len(text.encode()) - (n_bytes - removed) <= 2 and kept[r[0]].n_chars == len(text)

    fourth = stages["benchmark_overlap"](spark, third, sf)
    item = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    left = [r.doc_id for r in fourth.collect()]
    assert sorted(left) == sorted(i for i, r in kept.items() if not plain_overlap(r.text, item)[3]) and len(left) == len(kept) - 1

    pieces = stages["packing"](spark, fourth, sf).collect()
    assert {r.doc_id for r in pieces} == set(left)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=lambda r: (r[0], r[1])) is not None
    got = {r.doc_id: r.doc_tokens for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {r.doc_id: r.doc_tokens for r in pieces}


def test_an_empty_table_and_extra_columns(spark, tmp_path):
    sf, _ = fixture(spark, tmp_path / "sf")
    docs = table(spark, sf, "documents").withColumn("kept", F.col("lang"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).collect() == []
