"""Queries that SQL can express against their SQL twins; every query on an empty and on a small table."""

from __future__ import annotations

import duckdb
import pytest

from isograd.llm.queries import LLM_ORACLES, LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_matches_sql(name, spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = LLM_QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    want = sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({LLM_ORACLES[name]})").fetchall(), key=repr)
    assert got == want and len(got) > 0


def test_registered_names_carry_their_number():
    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES)
    assert numbers == list(range(1, 14)) and set(LLM_ORACLES) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_columns_of_the_contract(name, spark):
    asked = {
        "op1": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op2": "doc_id held_out lang_pred score",
        "op3": "doc_id n_words n_hit n_items items_sha256 contaminated",
        "op4": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op6": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op7": "page_id host path rule verdict",
        "op9": "doc_id class_id",
        "op10": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op11": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
        "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    }
    df = LLM_QUERIES[name](spark, "/root/testdata/sf0.001")
    assert set(asked.get(name.split("_")[0], "doc_id").split()) <= set(df.columns)
    kinds = dict(df.dtypes)
    for c in ("n_words", "n_hit", "n_items", "n_bytes", "n_removed", "n_spans", "start", "length", "ids_crc32", "doc_tokens", "n_tokens", "n_known", "train_tokens"):
        assert kinds.get(c, "bigint") == "bigint"
