"""Every registered query against its SQL twin, values compared exactly after rounding."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from isograd.plans.oracles import ORACLES
from isograd.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(rows):
    return sorted(repr([round(v, 8) if isinstance(v, float) else v for v in row]) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = duck.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    assert len(got) == len(want)
    assert len(got) > 0
    g, w = normal(got), normal(want)
    different = [(a, b) for a, b in zip(g, w) if a != b]
    assert not different, f"{len(different)} of {len(g)} rows differ, first {different[0]}"
