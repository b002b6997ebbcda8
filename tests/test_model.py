"""Feature slots, model tables, relational forest scoring, parity, reload."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskspark.operators import export, features, forest, resolution
from riskspark.plans import catalog
from riskspark.schema import PARITY_TOLERANCE
from riskspark.sources import records

TREES, DEPTH = 12, 6

EDGE_RECORDS = [
    # the documented request, an unseen label everywhere, NULL labels
    dict(incident_id=900001, country="Australia", year=2024, attack_type="DDoS",
         target_industry="Banking", financial_loss_million=50.0, affected_users=100000,
         attack_source="Hacker Group", vulnerability_type="Social Engineering",
         defense_mechanism="AI-based Detection"),
    dict(incident_id=900002, country=None, year=2020, attack_type=None,
         target_industry=None, financial_loss_million=80.0, affected_users=500000,
         attack_source=None, vulnerability_type=None, defense_mechanism=None),
]


@pytest.fixture(scope="module")
def fitted(spark):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    feats = features.fit_features(features.train_part(cleaned))
    model = resolution.fit_resolution_model(features.train_part(cleaned), feats, TREES, DEPTH)
    path = resolution.save_model(model, catalog.shared_path(spark, "models", "t", unique=True))
    return cleaned, feats, model, path


def test_slot_arithmetic(spark, fitted):
    _, feats, model, _ = fitted
    labels = features.indexed_labels(feats).values()
    assert features.feature_size(feats) == 4 + sum(len(x) + 1 for x in labels)
    assert model.stages[-1].numFeatures == features.feature_size(feats)


def test_unseen_and_null_labels_light_unknown_slot(spark, fitted):
    _, feats, _, _ = fitted
    df = records.records_frame(spark, EDGE_RECORDS)
    slots = features.encoded_features(feats, df).where("incident_id = 900002")
    labels = features.indexed_labels(feats).values()
    offsets, off = [], 4
    for block in labels:
        offsets.append(off + len(block))  # the unknown slot of the block
        off += len(block) + 1
    got = sorted(r["feature_index"] for r in slots.collect() if r["feature_index"] >= 4)
    assert got == offsets


def test_deltas_rebuild_pipeline_features(spark, fitted):
    cleaned, feats, _, _ = fitted
    data = cleaned.select(*[c for c in cleaned.columns]).unionByName(
        records.records_frame(spark, EDGE_RECORDS), allowMissingColumns=True)
    deltas = export.model_deltas(spark, feats)
    rebuilt = forest.features_from_deltas(data, deltas, features.feature_size(feats))
    direct = features.encoded_features(feats, data)
    assert rebuilt.exceptAll(direct).count() == 0
    assert direct.exceptAll(rebuilt).count() == 0


def test_model_nodes_invariants(spark, fitted):
    _, _, model, path = fitted
    nodes = export.model_nodes(spark, export.forest_stage_path(path, model))
    assert nodes.where("node_id = 0").count() == TREES
    internal = nodes.where("NOT is_leaf")
    assert internal.where("left_id IS NULL OR right_id IS NULL OR split_type IS NULL").count() == 0
    # every child id exists in its tree
    children = internal.select("tree_id", F.col("left_id").alias("node_id")).unionByName(
        internal.select("tree_id", F.col("right_id").alias("node_id")))
    assert children.join(nodes, ["tree_id", "node_id"], "left_anti").count() == 0
    assert nodes.count() == sum(t.numNodes for t in model.stages[-1].trees)


@pytest.fixture(scope="module")
def exported(spark, fitted):
    _, _, model, path = fitted
    return export.export_model(spark, model, path, catalog.shared_path(spark, "models", "e", unique=True))


def both_scored(spark, model, exported, data):
    out = model.transform(data).select(*data.columns, F.col("prediction").alias("b"))
    return forest.with_exported_prediction(spark, out, exported, "a")


def test_exported_forest_equals_transform(spark, fitted, exported):
    cleaned, _, model, _ = fitted
    data = cleaned.unionByName(records.records_frame(spark, EDGE_RECORDS), allowMissingColumns=True)
    report = forest.parity(both_scored(spark, model, exported, data), "a", "b", PARITY_TOLERANCE)
    row = report.first()
    assert row["missing"] == 0 and row["compared"] == data.count() and row["max_difference"] == 0.0
    forest.assert_parity(report)


def test_records_without_or_with_repeated_ids_are_scored_one_by_one(spark, fitted, exported):
    cleaned, _, model, _ = fitted
    edge = [dict(r, incident_id=None) for r in EDGE_RECORDS]
    same = [dict(EDGE_RECORDS[0], incident_id=7, affected_users=n) for n in (1, 5000, 10**9)]
    data = records.records_frame(spark, edge + same)
    got = sorted((r.a, r.b) for r in both_scored(spark, model, exported, data).collect())
    assert len(got) == 5 and all(a == b for a, b in got)
    answers = forest.score_exported(spark, data, exported).collect()
    assert sorted(str(r.incident_id) for r in answers) == ["7", "7", "7", "None", "None"]
    assert forest.score_exported(spark, data.drop("incident_id"), exported).count() == 5


def test_service_response_answers_every_record(spark, fitted, exported):
    data = records.records_frame(spark, [EDGE_RECORDS[0], dict(EDGE_RECORDS[0], year=1990)]).drop("loss_per_user")
    good, bad = forest.service_response(spark, data, exported).collect()
    assert good.is_valid and good.predicted_resolution_time_hours > 0 and good.reject_reasons == ""
    assert not bad.is_valid and bad.predicted_resolution_time_hours is None and "year" in bad.reject_reasons


def test_categorical_splits_and_nan(spark):
    """A tree with a category split; NaN fails every test and goes right."""
    from riskspark.schema import MODEL_NODES_SCHEMA
    nodes = spark.createDataFrame(
        [(0, 0, False, 0.0, 1, "categorical", None, [1.0, 3.0], 1, 2, 2.0),
         (0, 1, True, 10.0, None, None, None, None, None, None, 2.0),
         (0, 2, False, 0.0, 0, "continuous", 5.0, None, 3, 4, 2.0),
         (0, 3, True, 20.0, None, None, None, None, None, None, 2.0),
         (0, 4, True, 30.0, None, None, None, None, None, None, 2.0)], MODEL_NODES_SCHEMA)
    assert predicted(spark, nodes, [[0, 1], [0, 3], [5, 2], [6, 2], [np.nan, np.nan], [9, 64.0]], 2) == [
        10.0, 10.0, 20.0, 30.0, 30.0, 30.0]


@pytest.mark.parametrize("gap", [False, True])
def test_sets_without_gaps_are_ranges(spark, gap):
    """Thresholds and runs of categories need no words; a set with a gap brings them back; the answers are the same."""
    from riskspark.schema import MODEL_NODES_SCHEMA
    sets, values = [[0.0], [1.0], [], [2.0, 3.0], [63.0, 64.0, 65.0], [0.0, 1.0]], [
        -2.0, -1.0, -0.5, 0.0, 0.5, 1.0, np.nextafter(2.0, 0.0), 2.0, 3.9, 4.0, 62.9, 63.0, 64.0,
        np.nextafter(66.0, 0.0), 66.0, 3e9, float("inf"), float("-inf"), float("nan")]
    sets = sets + [[1.0, 3.0]] if gap else sets
    tests = [("categorical", None, s) for s in sets] + [("continuous", 2.0, None)]
    rows = []
    for t, test in enumerate(tests):
        rows += [(t, 0, False, 0.0, 0, *test, 1, 2, 1.0),
                 (t, 1, True, float(2 ** t), None, None, None, None, None, None, 1.0),
                 (t, 2, True, 0.0, None, None, None, None, None, None, 1.0)]
    nodes = spark.createDataFrame(rows, MODEL_NODES_SCHEMA)
    assert ("__words" in forest.packed_forest(nodes).columns) == gap
    whole = lambda v: int(v) if np.isfinite(v) and abs(v) < 2 ** 31 else None
    assert predicted(spark, nodes, [[v] for v in values], 1) == [
        sum(2.0 ** t for t, (_, limit, kept) in enumerate(tests) if (v <= limit if kept is None else whole(v) in kept))
        / len(tests) for v in values]


def predicted(spark, nodes, x, depth):
    rows = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "id int, x array<double>")
    out = forest.with_forest_prediction(rows, nodes, F.col("x"), depth, "p")
    return [r.p for r in sorted(out.collect())]


def random_tree(rng, tree, weight, features, depth):
    """Rows of the node table, and the tree as nested tuples."""
    rows = []

    def grow(level):
        node = len(rows)
        rows.append(None)
        if level == depth or rng.random() < 0.15:
            value = rng.random() * 50
            rows[node] = (tree, node, True, value, None, None, None, None, None, None, weight)
            return value
        feature = rng.randrange(features)
        if feature % 2:
            test = sorted(rng.sample(range(150), rng.randrange(0, 40)))
            kind = ("categorical", None, [float(c) for c in test])
        else:
            test = rng.random() * 150
            kind = ("continuous", test, None)
        left = len(rows)
        a = grow(level + 1)
        right = len(rows)
        b = grow(level + 1)
        rows[node] = (tree, node, False, 0.0, feature, *kind, left, right, weight)
        return feature, test, a, b
    return rows, grow(0)


@pytest.mark.parametrize("depth", [1, 5, 9])
def test_walk_equals_nested_trees(spark, depth):
    """Unequal tree weights, category sets of several words, depths of one and more generated methods."""
    import random

    from riskspark.schema import MODEL_NODES_SCHEMA
    rng = random.Random(depth)
    table, trees = [], []
    for t in range(7):
        rows = []
        rows, tree = random_tree(rng, 3 * t, 0.1 + t, 5, depth)
        table += rows
        trees.append((0.1 + t, tree))
    rng.shuffle(table)
    x = [[rng.choice([rng.random() * 150, float("nan")]) if f % 2 == 0 else float(rng.randrange(160)) for f in range(5)]
         for _ in range(300)]

    def walk(tree, row):
        while isinstance(tree, tuple):
            feature, test, a, b = tree
            left = row[feature] in test if isinstance(test, list) else row[feature] <= test
            tree = a if left else b
        return tree
    expected = []
    for row in x:
        total = 0.0
        for weight, tree in trees:
            total += weight * walk(tree, row)
        expected.append(total / sum(w for w, _ in trees))
    nodes = spark.createDataFrame(table, MODEL_NODES_SCHEMA)
    assert predicted(spark, nodes, x, depth) == expected


def test_scoring_has_no_python_worker(spark, fitted, exported):
    cleaned, _, _, _ = fitted
    plan = forest.with_exported_prediction(spark, cleaned, exported)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and len(plan) < 100_000


def test_full_forest_of_one_hot_splits_is_quick(spark):
    """150 trees, most splits on one-hot slots: 10,000 records in seconds, whatever the number of category nodes."""
    import random
    import time

    from riskspark.schema import MODEL_NODES_SCHEMA
    rng = random.Random(150)
    table = []
    for t in range(150):
        table += random_tree(rng, t, 1.0, 46, 8)[0]
    nodes = spark.createDataFrame(table, MODEL_NODES_SCHEMA).cache()
    x = F.transform(F.sequence(F.lit(0), F.lit(45)), lambda i: F.pmod(F.hash("id", i), F.lit(2)).cast("double"))
    start = time.perf_counter()
    out = forest.with_forest_prediction(spark.range(10_000), nodes, x, 8).agg(F.count("prediction")).first()
    assert out[0] == 10_000 and time.perf_counter() - start < 30
    nodes.unpersist()


def test_fits_do_not_depend_on_partitions(spark, fitted):
    cleaned, feats, model, _ = fitted
    train = features.train_part(cleaned)
    again = resolution.fit_resolution_model(train.repartition(7), feats, TREES, DEPTH)
    both = model.transform(cleaned).select(*cleaned.columns, F.col("prediction").alias("a"))
    both = again.transform(both).withColumnRenamed("prediction", "b")
    assert forest.parity(both, "a", "b", 0.0).first()["within_tolerance"]


def test_export_of_one_indexer_per_column(spark, fitted):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    cleaned, feats, _, _ = fitted
    single = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep")
              for c in features.CATEGORICAL_COLUMNS]
    rest = features.feature_pipeline().getStages()[1:]
    other = Pipeline(stages=single + rest).fit(features.train_part(cleaned))
    assert features.indexed_labels(other) == features.indexed_labels(feats)
    assert sorted(export.model_deltas(spark, other).collect(), key=str) == \
        sorted(export.model_deltas(spark, feats).collect(), key=str)


def test_reload_gives_same_predictions(spark, fitted):
    cleaned, _, model, path = fitted
    first = model.transform(cleaned).select(*cleaned.columns, F.col("prediction").alias("a"))
    both = resolution.load_model(path).transform(first).withColumnRenamed("prediction", "b")
    row = forest.parity(both, "a", "b", PARITY_TOLERANCE).first()
    assert row["within_tolerance"] and row["max_difference"] == 0.0


def test_missing_model_folder_raises(spark, scratch):
    with pytest.raises(Exception):
        resolution.load_model(f"{scratch}/no-model")


def test_scores_clipped_rounded_and_complete(spark, fitted):
    cleaned, _, model, _ = fitted
    scored = resolution.score(model, cleaned)
    assert scored.count() == cleaned.count()
    assert scored.where("predicted_resolution_time_hours IS NULL OR "
                        "predicted_resolution_time_hours < 0").count() == 0
    assert scored.where("abs(predicted_resolution_time_hours * 100 - "
                        "round(predicted_resolution_time_hours * 100)) > 1e-6").count() == 0


def test_metrics_of_perfect_prediction(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0)], "resolution_time_hours double, p double")
    row = resolution.regression_metrics(df, "resolution_time_hours", "p").first()
    assert (row["rmse"], row["mae"], row["r2"]) == (0.0, 0.0, 1.0)


def test_parity_reports_missing_and_difference(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None)], "a double, b double")
    row = forest.parity(df, "a", "b", 1e-6).first()
    assert (row["compared"], row["missing"], row["max_difference"]) == (1, 1, 0.5)
    assert not row["within_tolerance"]
    with pytest.raises(RuntimeError):
        forest.assert_parity(forest.parity(df, "a", "b", 1e-6))


def test_node_check_sees_broken_tables(spark, fitted, exported):
    nodes = export.read_export(spark, exported, "model_nodes")
    sound = export.node_check(nodes, 46).first()
    assert (sound.trees, sound.roots) == (TREES, TREES)
    assert (sound.missing_children, sound.orphans, sound.repeated) == (0, 0, 0)
    lost = nodes.where("NOT (tree_id = 1 AND node_id = 1)")
    assert export.node_check(lost, 46).first().missing_children == 1
    assert export.node_check(nodes.where("NOT (tree_id = 1 AND node_id = 0)"), 46).first().orphans == 2
    assert export.node_check(nodes.union(nodes.where("is_leaf").limit(1)), 46).first().repeated == 1
    assert export.node_check(nodes, 1).first().wrong_features > 0


def test_reach_check_sees_cycles(spark, exported):
    nodes = export.read_export(spark, exported, "model_nodes").where("tree_id = 0")
    sound = export.reach_check(nodes, DEPTH).first()
    assert (sound.trees, sound.unreached, sound.depth_within, sound.leaves_reached_again) == (1, 0, True, 0)
    assert export.reach_check(nodes, 1).first().unreached > 0  # deeper than stated
    last = nodes.agg(F.max("node_id")).first()[0]
    # two nodes that are each other's children: every node has a parent, no root reaches them
    cycle = [(0, last + 1, False, 0.0, 0, "continuous", 1.0, None, last + 2, last + 3, 1.0),
             (0, last + 2, False, 0.0, 0, "continuous", 1.0, None, last + 1, last + 4, 1.0),
             *[(0, last + k, True, 0.0, None, None, None, None, None, None, 1.0) for k in (3, 4)]]
    broken = nodes.union(spark.createDataFrame(cycle, nodes.schema))
    assert export.node_check(broken, 46).first().orphans == 0
    assert export.reach_check(broken, DEPTH).first().unreached == 4
    twice = nodes.withColumn("right_id", F.when(F.col("node_id") == 0, F.col("left_id")).otherwise(F.col("right_id")))
    assert export.reach_check(twice, DEPTH).first().leaves_reached_again > 0


def test_leaf_check_sees_a_wrong_forest(spark, fitted, exported):
    cleaned, feats, _, _ = fitted
    train = features.train_part(cleaned)
    nodes = export.read_export(spark, exported, "model_nodes")
    vector = forest.additive_vector(export.model_deltas(spark, feats), features.feature_size(feats))
    row = forest.leaf_check(train, nodes, vector, DEPTH, "resolution_time_hours").first()
    assert tuple(row) == (TREES, TREES * train.count(), 0, 0, 0)
    moved = nodes.withColumn("prediction", F.col("prediction") + F.when(F.col("is_leaf"), 500.0).otherwise(0.0))
    assert forest.leaf_check(train, moved, vector, DEPTH, "resolution_time_hours").first().out_of_range > 0
    swapped = nodes.select(*[F.col({"left_id": "right_id", "right_id": "left_id"}.get(c, c)).alias(c) for c in nodes.columns])
    other = forest.leaf_check(train, swapped, vector, DEPTH, "resolution_time_hours").first()
    assert other.empty_leaves + other.out_of_range > 0 and other.routed == row.routed


def test_metrics_do_not_depend_on_order(spark, scratch):
    import random
    rng = random.Random(3)
    rows = [(rng.random() * 100, rng.random() * 100) for _ in range(500)] + [(1e7 + 0.1, 3.3)]
    kind = "y double, p double"
    seen = {tuple(resolution.regression_metrics(
        spark.createDataFrame(rng.sample(rows, len(rows)), kind).repartition(n), "y", "p").first()) for n in (1, 3, 7)}
    assert len(seen) == 1
    check = resolution.metrics_check(spark.createDataFrame(rows[:500], kind), "y", "p", f"{scratch}/predictions").first()
    assert tuple(check) == (500, 0, True, True, True)


def test_broken_node_tables_are_errors(spark, exported):
    from riskspark.schema import MODEL_NODES_SCHEMA
    with pytest.raises(ValueError):
        forest.packed_forest(spark.createDataFrame([], MODEL_NODES_SCHEMA))
    with pytest.raises(ValueError):
        forest.packed_forest(export.read_export(spark, exported, "model_nodes").where("node_id <> 1"))
