"""Invariants of the registered queries without an exact oracle (sf0.001)."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from riskspark.plans import catalog
from riskspark.schema import FOREST_TREES, PROFILE_NAMES, SILHOUETTE_K_RANGE

import __spark_entry__ as entry

Q = {name: f for name, f in entry.queries().items() if name in catalog.QUERIES}


@pytest.fixture(scope="module")
def cleaned_count(spark):
    return catalog.cleaned_incidents(spark, SF_SMALL).count()


def run(spark, name):
    return Q[name](spark, SF_SMALL)


def test_every_query_has_oracle_or_invariant_test():
    covered = (set(entry.oracle_sql()) & set(Q)) | {
        "score_incidents", "model_metrics", "model_nodes", "model_summary",
        "forest_score", "segment_incidents", "profile_assignment",
        "risk_profile_summary", "profiles_by_count", "profile_count",
        "segmented_snapshot", "silhouette_by_k", "segmented_sink", "stream_score",
        "exported_service_response"}
    assert set(Q) == covered


def test_score_incidents(spark, cleaned_count):
    df = run(spark, "score_incidents")
    assert df.count() == cleaned_count
    assert df.where("predicted_resolution_time_hours IS NULL OR "
                    "predicted_resolution_time_hours < 0").count() == 0


def test_model_metrics(spark):
    row = run(spark, "model_metrics").first()
    assert row["evaluated_rows"] > 0 and row["rmse"] >= row["mae"] >= 0


def test_model_nodes_and_summary(spark):
    nodes = run(spark, "model_nodes")
    assert nodes.where("node_id = 0").count() == FOREST_TREES
    row = run(spark, "model_summary").first()
    assert row["trees"] == FOREST_TREES and row["total_tree_weight"] == float(FOREST_TREES)
    # full binary trees: every tree has one node fewer than twice its leaves
    assert row["nodes"] == nodes.count() == 2 * row["leaves"] - row["trees"]


def test_forest_score_covers_every_incident(spark, cleaned_count):
    df = run(spark, "forest_score")
    assert df.count() == cleaned_count
    assert df.where("prediction IS NULL").count() == 0


def test_segmentation_invariants(spark, cleaned_count):
    seg = run(spark, "segment_incidents")
    assert seg.count() == cleaned_count
    assert {r[0] for r in seg.select("risk_profile").distinct().collect()} == set(PROFILE_NAMES)
    summary = run(spark, "risk_profile_summary").collect()
    assert sum(r["incident_count"] for r in summary) == cleaned_count
    ordered = [r["incident_count"] for r in run(spark, "profiles_by_count").collect()]
    assert ordered == sorted(ordered)
    assert run(spark, "profile_count").first()["risk_profiles"] == 4
    assignment = run(spark, "profile_assignment").collect()
    assert sorted(r["risk_profile"] for r in assignment) == sorted(PROFILE_NAMES)
    assert len({r["cluster_id"] for r in assignment}) == 4


def test_segmented_snapshot_and_sink(spark, cleaned_count):
    snap = run(spark, "segmented_snapshot").collect()
    assert len(snap) == 12 and all(r["risk_profile"] in PROFILE_NAMES for r in snap)
    assert run(spark, "segmented_sink").count() == cleaned_count


def test_silhouette_sweep(spark):
    rows = run(spark, "silhouette_by_k").collect()
    assert [r["k"] for r in rows] == SILHOUETTE_K_RANGE
    assert all(-1.0 <= r["silhouette"] <= 1.0 for r in rows)


def test_stream_score_scores_all_valid_incidents(spark):
    valid = run(spark, "exported_service_response").where("is_valid").count()
    df = run(spark, "stream_score")
    assert df.count() == valid == df.select("incident_id").distinct().count()


def test_memo_is_per_application_and_can_be_released(spark):
    from riskspark.plans import cache
    calls = []
    first = cache.memoized(spark, "/x", "probe", lambda: calls.append(1) or len(calls))
    again = cache.memoized(spark, "/x/", "probe", lambda: calls.append(1) or len(calls))
    assert first == again == 1
    cache.forget(spark)
    assert cache.memoized(spark, "/x", "probe", lambda: 7) == 7
    cache.forget(spark)
