"""The registered queries over the small tables: SQL oracles, columns and row counts."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, sorted_rows
from riskspark.llm import queries

COLUMNS = {
    "op3_suffix_array": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op5_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_simhash": ["doc_id", "fingerprint", "component_id"],
    "op8_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op9_substring": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op11_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                 "repaired_sha256"],
    "op13_spelling_variants": ["word", "form", "root", "n", "n_near", "form_n"],
    "op12_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
}


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES} and "pipeline" in names
    assert set(queries.QUERIES) <= names and set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = con.execute(queries.SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, res.fetchall())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_rows_and_columns(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert df.columns[:len(COLUMNS.get(name, []))] == COLUMNS.get(name, [])
    if name.startswith("op13_"):
        return
    table = {"op4": "embeddings", "op11": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF_SMALL}/{table}.parquet")
    assert df.count() == (rows.select("conv_id").distinct() if table == "conversations" else rows).count()
