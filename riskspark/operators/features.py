"""Feature stages of the resolution-time model.

Indexing (labels by descending frequency, ties alphabetical, unseen and NULL
kept), one-hot encoding (last slot dropped, unknown kept) and assembly of
the numeric columns followed by the one-hot blocks.  A column with ``n``
labels takes ``n + 1`` slots; an unseen or NULL value lights slot ``n``.

Fitting the indexer is one distributed value count per column; the label
arrays it keeps are bounded by the number of distinct labels.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.schema import (CATEGORICAL_COLUMNS, MODEL_LABELS_SCHEMA,
                              NUMERIC_COLUMNS, TEST_FOLDS)

INDEX_COLUMNS = [f"{c}_index" for c in CATEGORICAL_COLUMNS]
ENCODED_COLUMNS = [f"{c}_encoded" for c in CATEGORICAL_COLUMNS]
FEATURES = "features"


def _held_out() -> Column:
    """The hold-out fold; a row without an id trains."""
    return F.coalesce((F.col("incident_id") % TEST_FOLDS) == 0, F.lit(False))


def with_split(df: DataFrame) -> DataFrame:
    """Add ``is_test``: the hold-out fold, a pure function of the id.

    Independent of partitioning and of the run, unlike ``randomSplit``.
    """
    return df.withColumn("is_test", _held_out())


def train_part(df: DataFrame) -> DataFrame:
    return df.where(~_held_out())


def test_part(df: DataFrame) -> DataFrame:
    return df.where(_held_out())


def split_summary(df: DataFrame, label: str = "resolution_time_hours") -> DataFrame:
    """Rows and mean label of each side of the split."""
    return (with_split(df)
            .groupBy(F.when(F.col("is_test"), "test").otherwise("train").alias("split"))
            .agg(F.count(F.lit(1)).alias("incident_count"),
                 F.avg(label).alias("mean_resolution_hours")))


def feature_pipeline() -> Pipeline:
    return Pipeline(stages=[
        StringIndexer(inputCols=CATEGORICAL_COLUMNS, outputCols=INDEX_COLUMNS,
                      handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=INDEX_COLUMNS, outputCols=ENCODED_COLUMNS,
                      handleInvalid="keep", dropLast=True),
        VectorAssembler(inputCols=NUMERIC_COLUMNS + ENCODED_COLUMNS,
                        outputCol=FEATURES, handleInvalid="keep"),
    ])


def fit_features(train: DataFrame) -> PipelineModel:
    return feature_pipeline().fit(train)


def indexed_labels(model: PipelineModel) -> dict[str, list[str]]:
    """Labels of every indexed column, from one indexer of many columns or one per column."""
    out: dict[str, list[str]] = {}
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            columns = stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
            out.update(zip(columns, map(list, stage.labelsArray)))
    if not out:
        raise ValueError("pipeline has no fitted StringIndexer")
    return out


def model_labels(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(column_name, label, label_index) of every fitted indexer label."""
    rows = [(column, label, index) for column, labels in indexed_labels(model).items()
            for index, label in enumerate(labels)]
    return spark.createDataFrame(rows, MODEL_LABELS_SCHEMA)


def feature_size(model: PipelineModel) -> int:
    """Slots of the assembled vector: numerics plus (labels + 1) per block."""
    return len(NUMERIC_COLUMNS) + sum(len(labels) + 1 for labels in indexed_labels(model).values())


def filled_slots(vector: str = FEATURES) -> Column:
    """The stored entries of a vector column as an array of (feature_index, value).

    A sparse vector is read as it is stored, never widened.
    """
    parts = F.unwrap_udt(vector)
    values = F.coalesce(parts["values"], F.array().cast("array<double>"))
    index = F.when(parts["type"] == 0, parts["indices"]).otherwise(
        F.sequence(F.lit(0), F.size(values) - 1))
    pairs = F.zip_with(index, values, lambda i, v: F.struct(i.cast("int").alias("feature_index"), v.alias("value")))
    return F.filter(pairs, lambda x: x["value"] != 0.0)


def encoded_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Non-zero slots per incident: (incident_id, feature_index, value)."""
    vectors = model.transform(df.select("incident_id", *NUMERIC_COLUMNS, *CATEGORICAL_COLUMNS))
    return (vectors.select("incident_id", F.explode(filled_slots()).alias("slot"))
            .select("incident_id", "slot.*"))
