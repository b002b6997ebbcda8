"""Resolution-time model: fit, score, evaluate, save and reload.

The model is the fitted feature stages followed by a random forest
(150 trees, depth 8, seed 42, other settings at Spark's defaults).
Scoring is ``PipelineModel.transform``: the forest is shipped to executors
once and every partition is scored locally, no shuffle.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.scalar import EXACT, postprocess_prediction
from riskspark.operators.features import FEATURES, fit_features
from riskspark.plans.cache import release
from riskspark.plans.partitioning import partitions_for_rows
from riskspark.schema import (FOREST_DEPTH, FOREST_SEED, FOREST_TREES,
                              LABEL_COLUMN, PREDICTION_COLUMN)


#: Rows up to which a fit caches node ids.  Spark holds three generations of them, which took 1.2 KB of disk
#: a row where they did not fit into memory; without them the trees are walked again at each level.
NODE_ID_ROWS = 10_000_000


def forest_estimator(trees: int = FOREST_TREES, depth: int = FOREST_DEPTH,
                     seed: int = FOREST_SEED, rows: int = 0) -> RandomForestRegressor:
    """The forest; other settings at Spark's defaults except ``cacheNodeIds``.

    Caching node ids changes no split (same predictions, checked), saves
    re-walking every tree per row at each level (11.8 s to 8.7 s at sf0.1)
    and checkpoints the cache to the shared folder every 10 iterations.
    More than ``NODE_ID_ROWS`` rows are fitted without: their ids would fill
    the disks.
    """
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=LABEL_COLUMN,
                                 predictionCol="prediction",
                                 numTrees=trees, maxDepth=depth, seed=seed,
                                 cacheNodeIds=rows <= NODE_ID_ROWS)


def fit_resolution_model(train: DataFrame, features: PipelineModel | None = None,
                         trees: int = FOREST_TREES, depth: int = FOREST_DEPTH,
                         partitions: int | None = None) -> PipelineModel:
    """Fit feature stages (unless given) and the forest on ``train``.

    Bootstrap samples are drawn per partition.  Rows are dealt by id into a
    number of partitions that follows from their count alone, and sorted by id
    there: the same rows give the same forest on any number of cores.
    """
    features = features or fit_features(train)
    rows = train.count()
    partitions = partitions or partitions_for_rows(rows)
    prepared = (features.transform(train).select("incident_id", FEATURES, LABEL_COLUMN)
                .repartition(partitions, "incident_id").sortWithinPartitions("incident_id", LABEL_COLUMN)
                .persist(StorageLevel.MEMORY_AND_DISK))
    release(train.sparkSession)  # what made the training rows
    try:
        forest = forest_estimator(trees, depth, rows=rows).fit(prepared)
    finally:
        prepared.unpersist()
        del prepared
        release(train.sparkSession)  # the node statistics of each level
    return PipelineModel(stages=list(features.stages) + [forest])


def raw_predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(incident_id, prediction) straight from the forest."""
    return model.transform(df).select("incident_id", "prediction")


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Clipped and rounded prediction per incident (the service response)."""
    return model.transform(df).select(
        "incident_id",
        postprocess_prediction(F.col("prediction")).alias(PREDICTION_COLUMN))


def regression_metrics(df: DataFrame, label: str, prediction: str | Column) -> DataFrame:
    """RMSE, MAE and R2 in one aggregate (R2 against the evaluated mean).

    Squares, errors and labels are summed as exact decimals, so the digits do
    not depend on the order of rows or on how partial sums are merged.
    """
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    err = F.col(label) - pred
    exact = lambda value: F.sum(F.when(err.isNotNull(), value).cast(EXACT)).cast("double")
    sums = df.agg(F.count(F.lit(1)).alias("evaluated_rows"), F.count(err).alias("n"),
                  exact(err * err).alias("squares"), exact(F.abs(err)).alias("errors"),
                  exact(F.col(label)).alias("labels"), exact(F.col(label) * F.col(label)).alias("label_squares"))
    spread = F.col("label_squares") - F.try_divide(F.col("labels") * F.col("labels"), F.col("n"))
    return sums.select(
        "evaluated_rows", F.sqrt(F.try_divide("squares", "n")).alias("rmse"),
        F.try_divide("errors", "n").alias("mae"), (F.lit(1.0) - F.try_divide(F.col("squares"), spread)).alias("r2"))


def mean_baseline_metrics(train: DataFrame, test: DataFrame) -> DataFrame:
    """Metrics of predicting the training mean for every test row.

    The training mean is a scalar subquery, not a join.
    """
    train_mean = train.agg(F.avg(LABEL_COLUMN)).scalar()
    return regression_metrics(test, LABEL_COLUMN, train_mean)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing folder raises."""
    return PipelineModel.load(path)


def metrics_check(df: DataFrame, label: str, prediction: str, path: str) -> DataFrame:
    """One row: the metrics of ``df`` against those that plain SQL finds in the predictions written to ``path``."""
    found = regression_metrics(df, label, prediction)
    df.select(F.col(label).alias("y"), F.col(prediction).alias("p")).write.parquet(path)
    again = df.sparkSession.sql(f"""
        SELECT count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse_again, avg(abs(y - p)) AS mae_again,
               1 - avg((y - p) * (y - p)) / var_pop(y) AS r2_again
        FROM parquet.`{path}`""")
    agree = lambda c: (F.abs(F.col(c) - F.col(f"{c}_again")) <= 1e-9).alias(f"{c}_agrees")
    return found.join(again, F.lit(True)).select("evaluated_rows", (F.col("n") - F.col("evaluated_rows")).alias("missing"),
                                                 *[agree(c) for c in ("rmse", "mae", "r2")])
