"""Named queries: ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the ``incidents`` view) over
their whole extent.  Shared intermediates (cleaned table, fitted models) are
computed once per application and data folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalar import loss_per_user, postprocess_prediction
from riskspark.operators import (explore, export, features, forest, quality,
                                 resolution, segment)
from riskspark.plans.cache import delete_folder, memoized, release
from riskspark.schema import (CLUSTER_K, FOREST_DEPTH, INCIDENT_SCHEMA, LABEL_COLUMN, PARITY_TOLERANCE,
                              PREDICTION_COLUMN)
from riskspark.session import shared_path
from riskspark.sources import files
from riskspark.sources.incidents import incidents as incidents_view
from riskspark.sources.tables import read_table
from riskspark.streaming import scoring

Query = Callable[[SparkSession, str], DataFrame]

# Country selection used by the filtered dashboard queries.
SELECTED_COUNTRIES = ["NATION_3", "NATION_7", "NATION_12", "NATION_21"]
# Micro-batches the stream-scoring query splits its arrivals into.
STREAM_MICRO_BATCHES = 4
# Means are rounded before comparison with another engine (summation order).
MEAN_PLACES = 6


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents_view(spark, sf_dir)


def cleaned_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table, written once per application (read by all queries).

    Parquet in the shared folder, sorted by id inside the partitions that the
    deduplication leaves: no further shuffle, no cache, and each query reads
    its own columns and pushes its filter into the scan.
    """
    def build() -> DataFrame:
        path = shared_path(spark, "tables", "cleaned", unique=True)
        quality.clean(incidents_view(spark, sf_dir)).sortWithinPartitions("incident_id").write.parquet(path)
        release(spark)  # lets go of the view's plan; the next release deletes its shuffle files
        out = spark.read.schema(files.CLEANED_SCHEMA).parquet(path)
        out.scratch_path = path
        return out
    return memoized(spark, sf_dir, "cleaned_incidents", build,
                    lambda df: delete_folder(spark, df.scratch_path))


def _mean(column: str) -> F.Column:
    return F.round(F.col(column), MEAN_PLACES).alias(column)


# --- sources and quality ----------------------------------------------------

def q_incidents(spark, sf_dir):
    return raw_incidents(spark, sf_dir)


def q_validate_incidents(spark, sf_dir):
    return quality.validate(raw_incidents(spark, sf_dir))


def q_rejected_by_reason(spark, sf_dir):
    return quality.rejected_by_reason(raw_incidents(spark, sf_dir))


def q_clean_incidents(spark, sf_dir):
    return cleaned_incidents(spark, sf_dir)


def q_loss_per_user(spark, sf_dir):
    return raw_incidents(spark, sf_dir).select(
        "incident_id", loss_per_user().alias("loss_per_user"))


# --- exploration ------------------------------------------------------------

def q_overview_kpis(spark, sf_dir):
    return explore.overview_kpis(cleaned_incidents(spark, sf_dir))


def q_filtered_kpis(spark, sf_dir):
    kpis = explore.filtered_kpis(cleaned_incidents(spark, sf_dir), SELECTED_COUNTRIES)
    return kpis.select("matching_incidents", _mean("average_loss_million"),
                       _mean("average_resolution_hours"))


def q_filter_country(spark, sf_dir):
    return explore.filter_countries(cleaned_incidents(spark, sf_dir), SELECTED_COUNTRIES)


def q_filter_country_empty(spark, sf_dir):
    kpis = explore.filtered_kpis(cleaned_incidents(spark, sf_dir), [])
    return kpis.select("matching_incidents", _mean("average_loss_million"),
                       _mean("average_resolution_hours"))


def q_incidents_by_year(spark, sf_dir):
    return explore.incidents_by_year(cleaned_incidents(spark, sf_dir))


def q_attack_distribution(spark, sf_dir):
    return explore.attack_distribution(cleaned_incidents(spark, sf_dir))


def q_avg_loss_by_attack(spark, sf_dir):
    out = explore.average_loss_by_attack(cleaned_incidents(spark, sf_dir))
    return out.select("attack_type", _mean("financial_loss_million"))


def _selected(spark, sf_dir):
    return explore.filter_countries(cleaned_incidents(spark, sf_dir), SELECTED_COUNTRIES)


def q_incidents_by_year_filtered(spark, sf_dir):
    return explore.incidents_by_year(_selected(spark, sf_dir))


def q_attack_distribution_filtered(spark, sf_dir):
    return explore.attack_distribution(_selected(spark, sf_dir))


def q_avg_loss_by_attack_filtered(spark, sf_dir):
    out = explore.average_loss_by_attack(_selected(spark, sf_dir))
    return out.select("attack_type", _mean("financial_loss_million"))


def q_distinct_options(spark, sf_dir):
    return explore.distinct_options(cleaned_incidents(spark, sf_dir))


def q_incident_snapshot(spark, sf_dir):
    return explore.incident_snapshot(cleaned_incidents(spark, sf_dir))


# --- model -------------------------------------------------------------------

def train_incidents(spark, sf_dir):
    return features.train_part(cleaned_incidents(spark, sf_dir))


def test_incidents(spark, sf_dir):
    return features.test_part(cleaned_incidents(spark, sf_dir))


def feature_model(spark, sf_dir):
    return memoized(spark, sf_dir, "feature_model",
                    lambda: features.fit_features(train_incidents(spark, sf_dir)))


def resolution_model(spark, sf_dir):
    return memoized(spark, sf_dir, "resolution_model",
                    lambda: resolution.fit_resolution_model(
                        train_incidents(spark, sf_dir), feature_model(spark, sf_dir)))


def saved_resolution_model(spark, sf_dir) -> str:
    """Folder of the saved model in the shared checkpoint area."""
    return memoized(spark, sf_dir, "saved_resolution_model",
                    lambda: resolution.save_model(
                        resolution_model(spark, sf_dir),
                        shared_path(spark, "models", "resolution", unique=True)))


def exported_model(spark, sf_dir) -> str:
    """Folder of the exported model tables (labels, deltas, nodes)."""
    return memoized(spark, sf_dir, "exported_model",
                    lambda: export.export_model(
                        spark, resolution_model(spark, sf_dir),
                        saved_resolution_model(spark, sf_dir),
                        shared_path(spark, "models", "export", unique=True)))


def forest_nodes(spark, sf_dir):
    return memoized(spark, sf_dir, "forest_nodes",
                    lambda: export.read_export(spark, exported_model(spark, sf_dir), "model_nodes")
                    .persist(StorageLevel.MEMORY_AND_DISK), lambda df: df.unpersist())


def delta_table(spark, sf_dir):
    """The deltas of the feature stages; the forest is not needed for them."""
    return memoized(spark, sf_dir, "model_deltas",
                    lambda: export.model_deltas(spark, feature_model(spark, sf_dir))
                    .persist(StorageLevel.MEMORY_AND_DISK), lambda df: df.unpersist())


def q_label_index(spark, sf_dir):
    return features.model_labels(spark, feature_model(spark, sf_dir))


def q_encoded_features(spark, sf_dir):
    return features.encoded_features(feature_model(spark, sf_dir), cleaned_incidents(spark, sf_dir))


def q_train_test_split(spark, sf_dir):
    out = features.split_summary(cleaned_incidents(spark, sf_dir))
    return out.select("split", "incident_count", _mean("mean_resolution_hours"))


def _rounded_metrics(df):
    return df.select("evaluated_rows", _mean("rmse"), _mean("mae"), _mean("r2"))


def q_mean_baseline_metrics(spark, sf_dir):
    return _rounded_metrics(resolution.mean_baseline_metrics(
        train_incidents(spark, sf_dir), test_incidents(spark, sf_dir)))


def q_model_deltas(spark, sf_dir):
    return delta_table(spark, sf_dir)


def q_features_from_deltas(spark, sf_dir):
    return forest.features_from_deltas(cleaned_incidents(spark, sf_dir), delta_table(spark, sf_dir),
                                       features.feature_size(feature_model(spark, sf_dir)))


def q_score_incidents(spark, sf_dir):
    return resolution.score(resolution_model(spark, sf_dir), cleaned_incidents(spark, sf_dir))


def q_model_metrics(spark, sf_dir):
    scored = resolution_model(spark, sf_dir).transform(test_incidents(spark, sf_dir))
    return _rounded_metrics(resolution.regression_metrics(scored, LABEL_COLUMN, "prediction"))


def q_metrics_check(spark, sf_dir):
    """The hold-out metrics against SQL over the written predictions."""
    scored = resolution_model(spark, sf_dir).transform(test_incidents(spark, sf_dir))
    return resolution.metrics_check(scored, LABEL_COLUMN, "prediction",
                                    shared_path(spark, "tables", "predictions", unique=True))


def _predicted(model, df, name):
    """``df`` with the model's raw prediction, without the stages' columns."""
    return model.transform(df).withColumnRenamed("prediction", name).select(*df.columns, name)


def q_reload_parity(spark, sf_dir):
    reloaded = resolution.load_model(saved_resolution_model(spark, sf_dir))
    data = cleaned_incidents(spark, sf_dir)
    first = _predicted(resolution_model(spark, sf_dir), data, "a")
    return forest.parity(_predicted(reloaded, first, "b"), "a", "b", PARITY_TOLERANCE)


def q_model_nodes(spark, sf_dir):
    return forest_nodes(spark, sf_dir)


def q_model_summary(spark, sf_dir):
    return export.model_summary(forest_nodes(spark, sf_dir),
                                features.feature_size(feature_model(spark, sf_dir)))


def q_forest_score(spark, sf_dir):
    """Raw predictions from the exported tables alone."""
    return forest.with_exported_prediction(spark, cleaned_incidents(spark, sf_dir), exported_model(spark, sf_dir),
                                           keep=["incident_id"])


def q_forest_parity(spark, sf_dir):
    data = _predicted(resolution_model(spark, sf_dir), cleaned_incidents(spark, sf_dir), "b")
    both = forest.with_exported_prediction(spark, data, exported_model(spark, sf_dir), "a", keep=["b"])
    return forest.parity(both, "a", "b", PARITY_TOLERANCE)


def q_exported_service_response(spark, sf_dir):
    """The service's answer to every raw incident, from the export alone."""
    requests = quality.normalize_text(raw_incidents(spark, sf_dir)).drop(LABEL_COLUMN)
    return forest.service_response(spark, requests, exported_model(spark, sf_dir))


def q_score_check(spark, sf_dir):
    """Facts that hold for a right scoring, counted over all answers and the fitted model."""
    answers = _predicted(resolution_model(spark, sf_dir), cleaned_incidents(spark, sf_dir), "raw")
    answers = forest.with_exported_prediction(spark, answers, exported_model(spark, sf_dir), keep=["raw"])
    hours = postprocess_prediction(F.col("prediction"))
    return answers.agg(
        F.count(F.lit(1)).alias("answers"), F.count(F.when(hours.isNull(), 1)).alias("unanswered"),
        F.count(F.when(hours < 0, 1)).alias("negative"),
        F.count(F.when(F.abs(hours * 100 - F.round(hours * 100)) > 1e-6, 1)).alias("over_two_places"),
        F.count(F.when(hours != postprocess_prediction(F.col("raw")), 1)).alias("different_from_model"))


def q_model_check(spark, sf_dir):
    """Facts of a sound node table: one root per tree, no missing child, no orphan."""
    return export.node_check(forest_nodes(spark, sf_dir),
                             features.feature_size(feature_model(spark, sf_dir)))


def q_reach_check(spark, sf_dir):
    """Every node hangs on one path below its root, no deeper than the forest may be."""
    return export.reach_check(forest_nodes(spark, sf_dir), FOREST_DEPTH)


def q_leaf_check(spark, sf_dir):
    """Every training row routed to its leaf in every exported tree."""
    vector = forest.additive_vector(delta_table(spark, sf_dir), features.feature_size(feature_model(spark, sf_dir)))
    return forest.leaf_check(train_incidents(spark, sf_dir), forest_nodes(spark, sf_dir), vector, FOREST_DEPTH, LABEL_COLUMN)


def q_clip_round(spark, sf_dir):
    """Service post-processing (clip at 0, round to 2, cast) on the mean model.

    ``baseline_hours`` is the mean-baseline prediction; ``excess_hours`` is
    how far each incident ran past it (negative differences clip to 0).
    """
    train_mean = train_incidents(spark, sf_dir).agg(F.avg(LABEL_COLUMN)).scalar()
    return cleaned_incidents(spark, sf_dir).select(
        "incident_id",
        postprocess_prediction(train_mean).alias("baseline_hours"),
        postprocess_prediction(F.col(LABEL_COLUMN) - train_mean).alias("excess_hours"))


# --- sources and sinks ------------------------------------------------------

def q_incidents_csv_roundtrip(spark, sf_dir):
    path = files.write_csv(cleaned_incidents(spark, sf_dir),
                           shared_path(spark, "tables", "incidents_csv", unique=True))
    return files.read_incidents_csv(spark, path)


def q_incidents_json_roundtrip(spark, sf_dir):
    path = files.write_json(cleaned_incidents(spark, sf_dir),
                            shared_path(spark, "tables", "incidents_json", unique=True))
    return files.read_incidents_json(spark, path)


# --- segmentation -----------------------------------------------------------

def segment_vectors(spark, sf_dir):
    """(scaled vectors, scaler, the k-means model of k = 4), made once per application."""
    def build():
        vectors, scaler = segment.scaled(cleaned_incidents(spark, sf_dir))
        return vectors, scaler, segment.kmeans().fit(vectors)
    return memoized(spark, sf_dir, "segment_vectors", build, lambda made: made[0].unpersist())


def segmentation(spark, sf_dir):
    """(segmented incidents, profile assignment), fitted once per application."""
    def build():
        segmented, assignment = segment.segment_with(cleaned_incidents(spark, sf_dir),
                                                     *segment_vectors(spark, sf_dir))
        return segmented.persist(StorageLevel.MEMORY_AND_DISK), assignment
    return memoized(spark, sf_dir, "segmentation", build, lambda made: made[0].unpersist())


def q_segment_incidents(spark, sf_dir):
    return segmentation(spark, sf_dir)[0]


def q_profile_assignment(spark, sf_dir):
    return segmentation(spark, sf_dir)[1]


def q_risk_profile_summary(spark, sf_dir):
    return segment.profile_summary(segmentation(spark, sf_dir)[0])


def q_profiles_by_count(spark, sf_dir):
    return segment.profiles_by_count(segmentation(spark, sf_dir)[0])


def q_profile_count(spark, sf_dir):
    return segment.profile_count(segmentation(spark, sf_dir)[0])


def q_segmented_snapshot(spark, sf_dir):
    return explore.incident_snapshot(segmentation(spark, sf_dir)[0],
                                     list(explore.SNAPSHOT_COLUMNS) + ["risk_profile"])


def sweep_models(spark, sf_dir):
    """The K-Means models of the silhouette sweep by k, fitted once per application."""
    vectors, _, model = segment_vectors(spark, sf_dir)
    return memoized(spark, sf_dir, "sweep_models", lambda: segment.fit_sweep(vectors, fitted={CLUSTER_K: model}))


def q_silhouette_by_k(spark, sf_dir):
    return segment.silhouette_by_k(segment_vectors(spark, sf_dir)[0], fitted=sweep_models(spark, sf_dir))


def q_silhouette_check(spark, sf_dir):
    return segment.silhouette_check(segment_vectors(spark, sf_dir)[0], sweep_models(spark, sf_dir))


def q_segment_check(spark, sf_dir):
    """Facts that hold for a right segmentation, whatever centres the fit finds."""
    vectors, _, model = segment_vectors(spark, sf_dir)
    return segment.segment_check(segmentation(spark, sf_dir)[0], model.transform(vectors),
                                 [c.tolist() for c in model.clusterCenters()])


def segmented_sink(spark, sf_dir) -> str:
    """Folder of the segmented table, written once per application."""
    return memoized(spark, sf_dir, "segmented_sink", lambda: files.write_parquet(
        segmentation(spark, sf_dir)[0], shared_path(spark, "tables", "segmented", unique=True),
        partition_by=["risk_profile"]), lambda path: delete_folder(spark, path))


def q_segmented_sink(spark, sf_dir):
    return files.read_parquet(spark, segmented_sink(spark, sf_dir))


def q_sink_check(spark, sf_dir):
    return segment.sink_check(segmentation(spark, sf_dir)[0], q_segmented_sink(spark, sf_dir))


def q_profile_check(spark, sf_dir):
    """Summary and order of the profiles against SQL over the written table."""
    return segment.profile_check(segmentation(spark, sf_dir)[0], segmented_sink(spark, sf_dir))


def q_segmented_csv_roundtrip(spark, sf_dir):
    """Sizes of the profiles of a segmented table that went through CSV, and their loss in cents."""
    path = files.write_csv(segmentation(spark, sf_dir)[0],
                           shared_path(spark, "tables", "segmented_csv", unique=True))
    back = files.read_incidents_csv(spark, path)
    cents = F.sum(F.round(F.col("financial_loss_million") * 100).cast("long")).alias("loss_cents")
    return back.agg(F.count(F.lit(1)).alias("incidents"), F.count_distinct("risk_profile").alias("profiles"),
                    F.count_distinct("cluster_id").alias("clusters"), cents)


# --- streaming --------------------------------------------------------------

def streamed_scores(spark, sf_dir) -> DataFrame:
    """All raw incidents arrive as JSON files and are scored as a stream.

    The arrivals keep the view's own partitioning (one file per partition,
    written in parallel); the stream takes them in about
    ``STREAM_MICRO_BATCHES`` micro-batches.  Rejected rows go to their own sink.
    The files are compressed: as plain text they would be larger than all the tables.
    """
    root = shared_path(spark, "streams", "score", unique=True)
    arrivals = quality.normalize_text(raw_incidents(spark, sf_dir)).drop(LABEL_COLUMN)
    model = resolution_model(spark, sf_dir)
    files.write_json(arrivals, f"{root}/source", compression="gzip")
    per_batch = max(1, math.ceil(len(spark.read.text(f"{root}/source").inputFiles()) / STREAM_MICRO_BATCHES))
    schema = T.StructType([f for f in INCIDENT_SCHEMA.fields if f.name != LABEL_COLUMN])
    release(spark)  # the shuffles of the view
    return scoring.run_until_drained(spark, model, f"{root}/source", schema, f"{root}/sink", f"{root}/checkpoint",
                                     files_per_batch=per_batch)


def stream_sink(spark, sf_dir) -> DataFrame:
    """What the stream has written, run once per application."""
    return memoized(spark, sf_dir, "stream_sink", lambda: streamed_scores(spark, sf_dir))


def q_stream_score(spark, sf_dir):
    return stream_sink(spark, sf_dir)


def q_stream_parity(spark, sf_dir):
    """Streamed answers against the batch answers to the same incidents, by incident."""
    batch = quality.validate(quality.normalize_text(raw_incidents(spark, sf_dir))).where("is_valid")
    batch = resolution.score(resolution_model(spark, sf_dir), batch).withColumnRenamed(PREDICTION_COLUMN, "a")
    stream = stream_sink(spark, sf_dir).select("incident_id", F.col(PREDICTION_COLUMN).alias("b"))
    return forest.parity(batch.join(stream, "incident_id", "full_outer"), "a", "b", PARITY_TOLERANCE)


QUERIES: dict[str, Query] = {
    "incidents": q_incidents,
    "validate_incidents": q_validate_incidents,
    "rejected_by_reason": q_rejected_by_reason,
    "clean_incidents": q_clean_incidents,
    "loss_per_user": q_loss_per_user,
    "overview_kpis": q_overview_kpis,
    "filtered_kpis": q_filtered_kpis,
    "filter_country": q_filter_country,
    "filter_country_empty": q_filter_country_empty,
    "incidents_by_year": q_incidents_by_year,
    "attack_distribution": q_attack_distribution,
    "avg_loss_by_attack": q_avg_loss_by_attack,
    "incidents_by_year_filtered": q_incidents_by_year_filtered,
    "attack_distribution_filtered": q_attack_distribution_filtered,
    "avg_loss_by_attack_filtered": q_avg_loss_by_attack_filtered,
    "distinct_options": q_distinct_options,
    "incident_snapshot": q_incident_snapshot,
    "label_index": q_label_index,
    "encoded_features": q_encoded_features,
    "train_test_split": q_train_test_split,
    "mean_baseline_metrics": q_mean_baseline_metrics,
    "model_deltas": q_model_deltas,
    "features_from_deltas": q_features_from_deltas,
    "score_incidents": q_score_incidents,
    "model_metrics": q_model_metrics,
    "reload_parity": q_reload_parity,
    "model_nodes": q_model_nodes,
    "model_summary": q_model_summary,
    "forest_score": q_forest_score,
    "forest_parity": q_forest_parity,
    "clip_round": q_clip_round,
    "incidents_csv_roundtrip": q_incidents_csv_roundtrip,
    "incidents_json_roundtrip": q_incidents_json_roundtrip,
    "segment_incidents": q_segment_incidents,
    "profile_assignment": q_profile_assignment,
    "risk_profile_summary": q_risk_profile_summary,
    "profiles_by_count": q_profiles_by_count,
    "profile_count": q_profile_count,
    "segmented_snapshot": q_segmented_snapshot,
    "silhouette_by_k": q_silhouette_by_k,
    "segmented_sink": q_segmented_sink,
    "stream_score": q_stream_score,
    "stream_parity": q_stream_parity,
    "exported_service_response": q_exported_service_response,
    "score_check": q_score_check,
    "model_check": q_model_check,
    "segment_check": q_segment_check,
    "segmented_csv_roundtrip": q_segmented_csv_roundtrip,
    "metrics_check": q_metrics_check,
    "reach_check": q_reach_check,
    "leaf_check": q_leaf_check,
    "silhouette_check": q_silhouette_check,
    "profile_check": q_profile_check,
    "sink_check": q_sink_check,
}
