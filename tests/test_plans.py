"""Plan shape: pushdown, pruning, and no shuffle for incident-keyed work."""

from __future__ import annotations

import re

from conftest import SF_SMALL
from riskspark.operators import explore
from riskspark.plans import catalog
from riskspark.plans.partitioning import partitions_for_rows
from riskspark.sources.incidents import incidents


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_country_filter_reaches_the_nation_scan(spark):
    df = explore.filter_countries(incidents(spark, SF_SMALL), ["NATION_3", "NATION_7"])
    plan = executed(df)
    nation = [m for m in re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]",
                                    plan) if "n_name" in m[0]]
    assert nation and "In(n_name" in nation[0][1]


def test_scans_read_only_used_columns(spark):
    plan = executed(incidents(spark, SF_SMALL))
    scanned = " ".join(re.findall(r"FileScan parquet \[([^\]]*)\]", plan))
    for unused in ("l_suppkey", "l_linenumber", "l_discount", "l_tax", "l_shipdate",
                   "c_name", "c_acctbal", "p_name", "p_brand", "n_regionkey"):
        assert unused not in scanned
    # only (order, part) key pairs meet the part table, and nothing is gathered in one task
    assert re.search(r"FileScan parquet \[l_orderkey#\d+L,l_partkey#\d+L\]", plan)
    assert "SinglePartition" not in plan


def test_cleaned_table_prunes_and_pushes_down(spark):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    plan = executed(explore.filter_countries(cleaned, ["NATION_3"]).select("year"))
    assert re.search(r"PushedFilters: \[[^\]]*country", plan)
    assert re.search(r"FileScan parquet \[country#\d+,year#\d+\]", plan)


def test_incident_work_needs_no_shuffle(spark):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    for name in ("features_from_deltas", "encoded_features", "forest_score", "exported_service_response"):
        if name != "exported_service_response":  # which reads the raw view
            assert "Exchange" not in executed(catalog.QUERIES[name](spark, SF_SMALL)), name
    plan = executed(catalog.QUERIES["forest_parity"](spark, SF_SMALL))
    assert "hashpartitioning" not in plan and "Join" not in plan
    assert cleaned.count() > 0


def test_labels_and_deltas_fit_no_forest(spark, monkeypatch):
    from riskspark.plans import cache
    cache.forget(spark)
    monkeypatch.setattr(catalog, "resolution_model", lambda *a: 1 / 0)
    assert catalog.QUERIES["label_index"](spark, SF_SMALL).count() > 0
    assert catalog.QUERIES["model_deltas"](spark, SF_SMALL).count() > 0


def test_a_fit_of_many_rows_takes_larger_partitions():
    rows = (1, 20_000, 118_000, 480_000, 1_180_000, 7_070_000, 42_400_000, 10 ** 9)
    assert [partitions_for_rows(n) for n in rows] == [1, 1, 6, 24, 24, 36, 212, 1000]
    assert all(partitions_for_rows(n) <= partitions_for_rows(n + 1_000) for n in range(1, 10 ** 7, 1_000))
