"""Every query with an oracle equals its DuckDB SQL on the small tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from conftest import SF_SMALL, sorted_rows

import __spark_entry__ as entry
from riskspark.plans.oracle import SQL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_oracle_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    duck_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(duck_cols)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(duck_cols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["attack_type", "incident_count"]
    assert len(rows) == 5
    counts = [r["incident_count"] for r in rows]
    assert counts == sorted(counts, reverse=True)
