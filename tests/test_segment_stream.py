"""Planted risk profiles get their names; stream scoring equals batch."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskspark.operators import features, resolution, segment
from riskspark.plans import catalog
from riskspark.schema import INCIDENT_SCHEMA, PROFILE_NAMES
from riskspark.streaming import scoring

# (expected name, loss, users, resolution) -- FIXTURES section 3
PLANTED = [
    ("High-Impact Rapid-Response Incidents", 80.0, 800000, 20.0),
    ("Widespread Low-Loss Incidents", 10.0, 800000, 50.0),
    ("High-Impact Long-Resolution Incidents", 80.0, 800000, 80.0),
    ("Concentrated High-Cost Incidents", 80.0, 50000, 50.0),
]


def planted_frame(spark, per_group=40):
    rng = random.Random(7)
    rows, truth = [], []
    for g, (name, loss, users, hours) in enumerate(PLANTED):
        for i in range(per_group):
            jitter = lambda v: v * (1 + rng.uniform(-0.005, 0.005))
            key = g * 1000 + i
            rows.append((key, "C", 2020, "A", "B", jitter(loss), int(jitter(users)),
                         "S", "V", "D", jitter(hours)))
            truth.append((key, name))
    truth_df = spark.createDataFrame(truth, "incident_id long, expected string")
    return spark.createDataFrame(rows, INCIDENT_SCHEMA), truth_df


def test_planted_clusters_are_named(spark):
    df, truth = planted_frame(spark)
    segmented, assignment = segment.segment(df)
    assert segmented.count() == df.count()
    wrong = segmented.join(truth, "incident_id").where(F.col("risk_profile") != F.col("expected"))
    assert wrong.count() == 0
    names = {r["risk_profile"] for r in assignment.collect()}
    assert names == set(PROFILE_NAMES)
    assert all(r["directions_broken"] == 0 for r in assignment.collect())


def test_profile_summary_sizes_add_up(spark):
    df, _ = planted_frame(spark)
    segmented, _ = segment.segment(df)
    summary = segment.profiles_by_count(segmented).collect()
    assert sum(r["incident_count"] for r in summary) == df.count()
    assert len(summary) == 4
    assert segment.profile_count(segmented).first()["risk_profiles"] == 4


def centred(spark, means):
    """Rows whose standardised features are the given means, five for each cluster."""
    from pyspark.ml.linalg import Vectors
    rows = [(k, Vectors.dense([v + d for v in mean])) for k, mean in means.items() for d in (-0.2, -0.1, 0.0, 0.1, 0.2)]
    return spark.createDataFrame(rows, ["cluster_id", segment.SCALED]).withColumn("cluster_id", F.col("cluster_id").cast("int"))


def test_profiles_are_named_one_to_one(spark):
    means = {0: (1.0, 1.0, -1.0), 1: (-1.0, 1.0, 0.0), 2: (1.0, 1.0, 1.0), 3: (1.0, -1.0, 0.0)}
    got = {r.cluster_id: r.risk_profile for r in segment.profile_assignment(centred(spark, means)).collect()}
    assert got == {0: PROFILE_NAMES[0], 1: PROFILE_NAMES[1], 2: PROFILE_NAMES[2], 3: PROFILE_NAMES[3]}


def test_naming_takes_the_best_total(spark):
    """Against every permutation, also where two clusters suit one name best."""
    import itertools
    import math

    from riskspark.schema import PROFILE_DIRECTIONS
    rng = random.Random(5)
    names = sorted(PROFILE_NAMES)
    for _ in range(4):
        means = {k: tuple(rng.uniform(-1, 1) for _ in range(3)) for k in (2, 3, 5, 9)}

        def score(c, n):
            return sum(m * d for m, d in zip(means[c], PROFILE_DIRECTIONS[n])) / math.hypot(*PROFILE_DIRECTIONS[n])
        best = max(itertools.permutations(sorted(means)), key=lambda p: sum(map(score, p, names)))
        rows = segment.profile_assignment(centred(spark, means)).collect()
        assert {r.risk_profile: r.cluster_id for r in rows} == dict(zip(names, best))
        assert all(abs(r.match_score - score(r.cluster_id, r.risk_profile)) < 1e-9 and r.size == 5 for r in rows)


def test_other_numbers_of_clusters_are_errors(spark):
    import pytest
    with pytest.raises(Exception, match="need 4 clusters"):
        segment.profile_assignment(centred(spark, {0: (1.0, 1.0, 1.0), 1: (0.0, 0.0, 0.0)})).collect()


def test_silhouette_sweep_in_range(spark):
    df, _ = planted_frame(spark, per_group=15)
    vectors, _ = segment.scaled(df)
    out = segment.silhouette_by_k(vectors, [2, 3, 4]).collect()
    assert [r["k"] for r in out] == [2, 3, 4]
    assert all(-1.0 <= r["silhouette"] <= 1.0 for r in out)
    assert max(out, key=lambda r: r["silhouette"])["k"] == 4


def test_stream_scoring_equals_batch(spark, scratch):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    train, test = features.train_part(cleaned), features.test_part(cleaned)
    model = resolution.fit_resolution_model(train, trees=5, depth=4)
    arrivals = test.drop("resolution_time_hours", "loss_per_user")
    bad = arrivals.limit(3).withColumn("year", F.lit(1999))  # rejected rows
    source = f"{scratch}/source"
    arrivals.repartition(3).write.json(source)
    bad.withColumn("incident_id", F.col("incident_id") + 10_000_000).write.mode("append").json(source)
    streamed = scoring.run_until_drained(spark, model, source, arrivals.schema,
                                         f"{scratch}/sink", f"{scratch}/ckpt")
    batch = resolution.score(model, test)
    assert streamed.count() == test.count()
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0
    assert streamed.select("batch_id").distinct().count() >= 2
    rejected = spark.read.parquet(f"{scratch}/sink/rejected")
    assert rejected.count() == 3


def test_stream_restart_processes_only_new_files(spark, scratch):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    model = resolution.fit_resolution_model(features.train_part(cleaned), trees=3, depth=3)
    arrivals = features.test_part(cleaned).drop("resolution_time_hours", "loss_per_user")
    first, second = arrivals.where("incident_id % 2 = 0"), arrivals.where("incident_id % 2 = 1")
    source, sink, ckpt = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ckpt"
    first.write.json(f"{source}/a")
    once = scoring.run_until_drained(spark, model, f"{source}/*", arrivals.schema, sink, ckpt)
    assert once.count() == first.count()
    second.write.json(f"{source}/b")  # new files arrive; same checkpoint
    again = scoring.run_until_drained(spark, model, f"{source}/*", arrivals.schema, sink, ckpt)
    assert again.count() == arrivals.count()
    assert again.select("incident_id").distinct().count() == arrivals.count()


def test_replayed_batch_overwrites_its_output(spark, scratch):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    model = resolution.fit_resolution_model(features.train_part(cleaned), trees=3, depth=3)
    batch = features.test_part(cleaned).drop("resolution_time_hours", "loss_per_user")
    handle = scoring._score_batch(model, f"{scratch}/sink")
    handle(batch, 7)
    handle(batch, 7)  # the same micro-batch delivered again after a failure
    out = spark.read.parquet(f"{scratch}/sink/scored")
    assert out.count() == batch.count()


def test_parquet_stream_source(spark, scratch):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    model = resolution.fit_resolution_model(features.train_part(cleaned), trees=3, depth=3)
    arrivals = features.test_part(cleaned).drop("resolution_time_hours", "loss_per_user")
    arrivals.write.parquet(f"{scratch}/src")
    out = scoring.run_until_drained(spark, model, f"{scratch}/src", arrivals.schema,
                                    f"{scratch}/sink", f"{scratch}/ckpt", fmt="parquet",
                                    files_per_batch=None)
    assert out.count() == arrivals.count()


def test_silhouette_and_cluster_means_match_brute_force(spark):
    import numpy as np
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import vector_to_array
    df, _ = planted_frame(spark, per_group=15)
    vectors, _ = segment.scaled(df)
    assigned = segment.kmeans(4).fit(vectors).transform(vectors)
    rows = assigned.select(vector_to_array(segment.SCALED).alias("z"), "cluster_id").collect()
    z = np.array([r["z"] for r in rows])
    c = np.array([r["cluster_id"] for r in rows])
    # standardisation: unit-variance (sample) columns with zero mean
    raw = np.array([[r[f] for f in ("financial_loss_million", "affected_users",
                                    "resolution_time_hours")] for r in df.collect()])
    order = np.argsort([r["incident_id"] for r in df.collect()])
    assert np.allclose(np.sort(z[:, 0]), np.sort((raw[order, 0] - raw[:, 0].mean())
                                                 / raw[:, 0].std(ddof=1)))
    # cluster means of the standardised features
    means = {r["cluster_id"]: r for r in segment.cluster_means(assigned).collect()}
    for k in set(c):
        assert np.allclose(z[c == k].mean(axis=0),
                           [means[k]["z_financial_loss_million"], means[k]["z_affected_users"],
                            means[k]["z_resolution_time_hours"]])
    # silhouette with squared Euclidean distance, own point excluded
    d = ((z[:, None, :] - z[None, :, :]) ** 2).sum(axis=2)
    scores = []
    for i in range(len(z)):
        same = (c == c[i])
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, c == k].mean() for k in set(c) if k != c[i])
        scores.append((b - a) / max(a, b))
    spark_value = ClusteringEvaluator(featuresCol=segment.SCALED, predictionCol="cluster_id",
                                      distanceMeasure="squaredEuclidean").evaluate(assigned)
    assert abs(spark_value - float(np.mean(scores))) < 1e-6
    own = segment.silhouettes(vectors, {4: segment.kmeans(4).fit(vectors)}).first()
    assert abs(own.silhouette - float(np.mean(scores))) < 1e-9


def test_silhouette_of_single_points_and_copies(spark):
    """A point alone in its cluster scores 0; equal points are at distance 0."""
    from pyspark.ml.linalg import Vectors
    rows = [(Vectors.dense(x),) for x in ([0.0, 0, 0], [0.0, 0, 0], [9.0, 9, 9], [5.0, 0, 0], [5.5, 0, 0])]
    vectors = spark.createDataFrame(rows, [segment.SCALED])
    models = segment.fit_sweep(vectors, [2, 3, 4])
    assert all(r.equals_evaluator and r.in_range for r in segment.silhouette_check(vectors, models).collect())


def test_profile_means_do_not_depend_on_order(spark):
    """Halves are ties of exact sums, rounded to even, in any order of rows."""
    base = [(k, "P", v, u, h) for k, (v, u, h) in enumerate([(0.125, 2, 1.005), (0.125, 3, 1.005), (1e9 + 0.125, 5, 0.0)] * 50)]
    kind = "incident_id long, risk_profile string, financial_loss_million double, affected_users long, resolution_time_hours double"
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(base)
        seen.add(tuple(segment.profile_summary(spark.createDataFrame(base, kind).repartition(seed + 1)).first()))
    assert seen == {("P", 150, 333333333.46, 3.0, 0.67)}
