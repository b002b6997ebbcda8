"""Risk-profile segmentation.

Loss, affected users and resolution time are standardised
(``StandardScaler``, mean and deviation) and clustered by ``KMeans``.  The
cluster ids are arbitrary; the four profile names are attached by how well
each cluster's standardised mean matches the stated direction of each
profile:

    score(cluster, profile) = mean_z(cluster) . direction / |direction|

and the one-to-one assignment with the largest total wins (ties: the smaller
clusters for the names in order).  The scores are a table of k x k rows
(k = 4), the assignments its joins over different clusters, and the names are
joined back: nothing is fetched.

The silhouette of squared distances needs, per cluster, only the number of
points, their sum and the sum of their squares, so one pass over the points
gives the moments of the clusters of every k, and one more the scores.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.scalar import EXACT, round_half_even
from riskspark.plans.joins import broadcast_bounded_by_construction
from riskspark.plans.partitioning import partitions_for_rows
from riskspark.schema import (CLUSTER_FEATURES, CLUSTER_K, CLUSTER_SEED,
                              PROFILE_DIRECTIONS, PROFILE_NAMES,
                              SILHOUETTE_K_RANGE)

SCALED = "scaled_features"
# K-Means fits of the silhouette sweep submitted at the same time.
SWEEP_CONCURRENCY = 7


def scaler_pipeline() -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=CLUSTER_FEATURES, outputCol="cluster_input"),
        StandardScaler(inputCol="cluster_input", outputCol=SCALED,
                       withMean=True, withStd=True),
    ])


def scaled(df: DataFrame, scaler: PipelineModel | None = None) -> tuple[DataFrame, PipelineModel]:
    """Standardised vectors (persisted: K-Means and the sweep pass over them).

    Seeds are drawn per partition, so rows with ids are dealt into partitions
    by id and count alone and sorted there.
    """
    if "incident_id" in df.columns:
        df = (df.select("incident_id", *CLUSTER_FEATURES)
              .repartition(partitions_for_rows(df.count()), "incident_id")
              .sortWithinPartitions("incident_id", *CLUSTER_FEATURES))
    scaler = scaler or scaler_pipeline().fit(df)
    vectors = (scaler.transform(df).drop("cluster_input")
               .persist(StorageLevel.MEMORY_AND_DISK))
    return vectors, scaler


def kmeans(k: int = CLUSTER_K, seed: int = CLUSTER_SEED) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=SCALED, predictionCol="cluster_id")


def fit_sweep(vectors: DataFrame, ks: list[int] = SILHOUETTE_K_RANGE,
              fitted: dict[int, KMeansModel] | None = None,
              concurrency: int = SWEEP_CONCURRENCY) -> dict[int, KMeansModel]:
    """A K-Means model for each k.

    The fits are independent jobs over the same persisted vectors; running
    ``concurrency`` at once overlaps their per-iteration scheduling gaps.
    """
    fitted = fitted or {}
    with ThreadPoolExecutor(max_workers=min(concurrency, len(ks))) as pool:
        return dict(zip(ks, pool.map(lambda k: fitted.get(k) or kmeans(k).fit(vectors), ks)))


def silhouettes(vectors: DataFrame, models: dict[int, KMeansModel]) -> DataFrame:
    """(k, silhouette) of every model, squared Euclidean, from two passes over the vectors.

    For a point x and a cluster of n points with sum s and sum of squared
    lengths q, the mean squared distance is |x|^2 + q/n - 2 x.s/n; inside its
    own cluster the point itself is left out (n - 1).  A point alone in its
    cluster scores 0.  The moments are one row per k and cluster.
    """
    # Per k: a struct of k and the point's cluster, by the nearest centre as the model itself finds it.
    assigned = vectors.select(SCALED)
    for k, model in models.items():
        assigned = model.copy({model.predictionCol: f"cluster_{k}"}).transform(assigned)
    every = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"cluster_{k}").alias("cluster")) for k in models])
    points = assigned.select(vector_to_array(SCALED).alias("x"), F.explode(every).alias("at")).select("x", "at.*")
    length = F.aggregate("x", F.lit(0.0), lambda total, v: total + v * v)
    sizes = range(len(CLUSTER_FEATURES))
    moments = points.groupBy("k", "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(length).alias("q"), *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in sizes])
    table = moments.groupBy("k").agg(F.collect_list(F.struct(
        "cluster", "n", "q", F.array(*[F.col(f"s{i}") for i in sizes]).alias("s"))).alias("clusters"))
    placed = points.join(broadcast_bounded_by_construction(table), "k").withColumn("length", length)
    dot = lambda s: sum((F.get("x", F.lit(i)) * F.get(s, F.lit(i)) for i in sizes), F.lit(0.0))
    whole = lambda c: F.col("length") * c["n"] + c["q"] - dot(c["s"]) * 2
    own = F.get(F.filter("clusters", lambda c: c["cluster"] == F.col("cluster")), F.lit(0))
    other = F.array_min(F.transform(F.filter("clusters", lambda c: c["cluster"] != F.col("cluster")),
                                    lambda c: whole(c) / c["n"]))
    far = placed.select("k", own["n"].alias("n"), F.try_divide(whole(own), own["n"] - 1).alias("a"), other.alias("b"))
    score = (F.when(F.col("n") == 1, 0.0).when(F.col("a") < F.col("b"), 1 - F.col("a") / F.col("b"))
             .when(F.col("a") > F.col("b"), F.col("b") / F.col("a") - 1).otherwise(0.0))
    return far.groupBy("k").agg(F.avg(score).alias("silhouette"))


def silhouette_by_k(vectors: DataFrame, ks: list[int] = SILHOUETTE_K_RANGE,
                    fitted: dict[int, KMeansModel] | None = None) -> DataFrame:
    """Silhouette of a K-Means fit for each k; ``fitted`` models are used as they are."""
    return silhouettes(vectors, fit_sweep(vectors, ks, fitted)).orderBy("k")


def silhouette_check(vectors: DataFrame, models: dict[int, KMeansModel]) -> DataFrame:
    """Per k: whether the silhouette equals the one that Spark's evaluator finds, within one in 10^9."""
    evaluator = ClusteringEvaluator(featuresCol=SCALED, predictionCol="cluster_id",
                                    metricName="silhouette", distanceMeasure="squaredEuclidean")
    # One number for each k: parameters of the check, not data.
    known = F.create_map(*[F.lit(x) for k, model in models.items()
                           for x in (k, float(evaluator.evaluate(model.transform(vectors))))])
    return silhouettes(vectors, models).select(
        "k", (F.abs(F.col("silhouette") - F.element_at(known, F.col("k"))) <= 1e-9).alias("equals_evaluator"),
        F.col("silhouette").between(-1, 1).alias("in_range"))


def cluster_means(assigned: DataFrame) -> DataFrame:
    """Per cluster: size and mean of each standardised feature (k rows)."""
    z = vector_to_array(F.col(SCALED))
    return (assigned.groupBy("cluster_id")
            .agg(F.count(F.lit(1)).alias("size"),
                 *[F.avg(z[i]).alias(f"z_{c}") for i, c in enumerate(CLUSTER_FEATURES)]))


def profile_scores(means: DataFrame) -> DataFrame:
    """(cluster_id, risk_profile, match_score, directions_broken, size): every cluster against every profile."""
    def against(name: str):
        direction = PROFILE_DIRECTIONS[name]
        signs = [(F.col(f"z_{c}"), d) for c, d in zip(CLUSTER_FEATURES, direction)]
        total = sum((z * d for z, d in signs), F.lit(0.0)) / math.sqrt(sum(d * d for d in direction))
        broken = sum((F.when((z > 0) == F.lit(d > 0), 0).otherwise(1) for z, d in signs if d), F.lit(0))
        return F.struct(F.lit(name).alias("risk_profile"), total.alias("match_score"), broken.alias("directions_broken"))
    profiles = F.array(*[against(name) for name in PROFILE_NAMES])
    return means.select("cluster_id", "size", F.explode(profiles).alias("p")).select("cluster_id", "p.*", "size")


def profile_assignment(assigned: DataFrame) -> DataFrame:
    """(cluster_id, risk_profile, match_score, directions_broken, size): the one-to-one naming with the best total.

    Joins one name after the other to the clusters not yet taken (k! rows for
    k names, whatever the data).  Any other number of clusters than names is an error.
    """
    means = cluster_means(assigned)
    names = sorted(PROFILE_NAMES)
    found = F.count(F.lit(1)).over(Window.partitionBy())
    scores = profile_scores(means.withColumn("found", found).where(F.when(F.col("found") == len(names), True).otherwise(
        F.raise_error(F.concat(F.lit(f"need {len(names)} clusters to name, got "), F.col("found").cast("string"))))))
    taken = None
    for name in names:
        one = scores.where(F.col("risk_profile") == name).select(
            F.struct("cluster_id", "risk_profile", "match_score", "directions_broken", "size").alias("pick"))
        if taken is None:
            taken = one.select(F.array("pick").alias("picks"))
        else:
            free = ~F.exists("picks", lambda p: p["cluster_id"] == F.col("pick.cluster_id"))
            taken = taken.join(broadcast_bounded_by_construction(one), free).select(
                F.concat("picks", F.array("pick")).alias("picks"))
    total = F.round(F.aggregate("picks", F.lit(0.0), lambda t, p: t + p["match_score"]), 12)
    best = taken.agg(F.min(F.struct((-total).alias("total"), F.transform("picks", lambda p: p["cluster_id"]).alias("order"),
                                    "picks")).alias("best"))
    return best.select(F.explode("best.picks").alias("pick")).select("pick.*")


def name_clusters(assigned: DataFrame, assignment: DataFrame) -> DataFrame:
    """Attach ``risk_profile`` from the k rows of an assignment."""
    names = broadcast_bounded_by_construction(assignment.select("cluster_id", "risk_profile"))
    return assigned.join(names, "cluster_id", "left").select(*assigned.columns, "risk_profile")


def segment(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segmented incidents, profile assignment)."""
    vectors, scaler = scaled(df)
    try:
        return segment_with(df, vectors, scaler, kmeans().fit(vectors))
    finally:
        vectors.unpersist()


def segment_with(df: DataFrame, vectors: DataFrame, scaler: PipelineModel,
                 model: KMeansModel) -> tuple[DataFrame, DataFrame]:
    """(segmented incidents, profile assignment) of fitted models."""
    assigned = model.transform(vectors).withColumn("cluster_id", F.col("cluster_id").cast("int"))
    assignment = profile_assignment(assigned)
    # The result is lazy: scaling and assignment are cheap projections.
    labelled = model.transform(scaler.transform(df)).withColumn(
        "cluster_id", F.col("cluster_id").cast("int"))
    segmented = name_clusters(labelled, assignment).drop(SCALED, "cluster_input")
    return segmented, assignment


def exact_mean(column: str) -> Column:
    """Mean from an exact decimal sum, which does not depend on the order of rows; 12 places are kept of a value."""
    return F.sum(F.col(column).cast(EXACT)) / F.count(column)


def profile_summary(segmented: DataFrame) -> DataFrame:
    """Per profile: size, mean loss (2 places), users (0), resolution (2).

    Means are rounded half-to-even, like a pandas ``Series.round``, from exact
    sums, so that a tie is a tie on any number of tasks.
    """
    rounded = lambda c, places: round_half_even(exact_mean(c), places).cast("double")
    return (segmented.where(F.col("risk_profile").isNotNull())
            .groupBy("risk_profile")
            .agg(F.count(F.lit(1)).alias("incident_count"),
                 rounded("financial_loss_million", 2).alias("average_financial_loss_million"),
                 rounded("affected_users", 0).alias("average_affected_users"),
                 rounded("resolution_time_hours", 2).alias("average_resolution_time_hours")))


def profiles_by_count(segmented: DataFrame) -> DataFrame:
    return profile_summary(segmented).orderBy("incident_count", "risk_profile")


def profile_check(segmented: DataFrame, path: str) -> DataFrame:
    """One row: the summary of profiles and its order against plain SQL over the segmented table written to ``path``."""
    again = segmented.sparkSession.sql(f"""
        SELECT risk_profile, count(*) AS n,
               bround(sum(CAST(financial_loss_million AS {EXACT})) / count(*), 2) AS loss,
               bround(sum(CAST(affected_users AS {EXACT})) / count(*), 0) AS users,
               bround(sum(CAST(resolution_time_hours AS {EXACT})) / count(*), 2) AS hours
        FROM parquet.`{path}` GROUP BY risk_profile""")
    ordered = profiles_by_count(segmented).withColumn("place", F.monotonically_increasing_id())
    before = Window.orderBy("place")  # one row per profile
    ordered = ordered.withColumn("sorted", F.coalesce(
        F.struct("incident_count", "risk_profile") > F.lag(F.struct("incident_count", "risk_profile")).over(before), F.lit(True)))
    same = ((F.col("incident_count") == F.col("n")) & (F.col("average_financial_loss_million") == F.col("loss"))
            & (F.col("average_affected_users") == F.col("users")) & (F.col("average_resolution_time_hours") == F.col("hours")))
    return ordered.join(again, "risk_profile", "full_outer").agg(
        F.count(F.lit(1)).alias("profiles"), F.sum("incident_count").alias("incidents"),
        F.count(F.when(same, 1)).alias("equal"), F.coalesce(F.min("sorted"), F.lit(True)).alias("in_order"))


def sink_check(segmented: DataFrame, written: DataFrame) -> DataFrame:
    """One row: rows written, and rows that only one of the two tables has."""
    columns = segmented.columns
    lost = segmented.exceptAll(written.select(columns)).agg(F.count(F.lit(1)).alias("lost"))
    added = written.select(columns).exceptAll(segmented).agg(F.count(F.lit(1)).alias("added"))
    return (written.agg(F.count(F.lit(1)).alias("incidents"), F.count_distinct("risk_profile").alias("profiles"))
            .join(lost, F.lit(True)).join(added, F.lit(True)))


def profile_count(segmented: DataFrame) -> DataFrame:
    return segmented.agg(F.count_distinct("risk_profile").alias("risk_profiles"))


def segment_check(segmented: DataFrame, assigned: DataFrame, centres: list[list[float]]) -> DataFrame:
    """One row about a segmentation: rows, named rows, profiles, rows that another centre is nearer to,
    and how far the profiles' means, weighted by size, are from the overall means (below one in 10^9)."""
    z = vector_to_array(F.col(SCALED))
    distance = [sum((z[i] - F.lit(c[i])) * (z[i] - F.lit(c[i])) for i in range(len(c))) for c in centres]
    nearest = F.least(*distance)
    own = F.coalesce(*[F.when(F.col("cluster_id") == k, d) for k, d in enumerate(distance)])
    astray = assigned.agg(F.count(F.when(own > nearest + 1e-9, 1)).alias("astray"))
    sums = [F.sum(c).alias(c) for c in CLUSTER_FEATURES]
    parts = segmented.groupBy("risk_profile").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in CLUSTER_FEATURES])
    again = parts.agg(F.sum("n").alias("n"), *[F.sum(F.col(c) * F.col("n")).alias(f"p_{c}") for c in CLUSTER_FEATURES])
    facts = segmented.agg(F.count(F.lit(1)).alias("incidents"), F.count("risk_profile").alias("named"),
                          F.count_distinct("risk_profile").alias("profiles"), *sums)
    off = F.greatest(*[F.abs(F.col(c) - F.col(f"p_{c}")) / F.abs(F.col(c)) for c in CLUSTER_FEATURES])
    return (facts.join(astray, F.lit(True)).join(again, F.lit(True))
            .select("incidents", "named", "profiles", "astray", (off < 1e-9).alias("means_agree")))
