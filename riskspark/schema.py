"""Column lists, schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the analysed application's) -------------------
# Categorical model columns, in feature order.
CATEGORICAL_COLUMNS = [
    "country",
    "attack_type",
    "target_industry",
    "attack_source",
    "vulnerability_type",
    "defense_mechanism",
]
# Numeric model columns, in feature order (they lead the feature vector).
NUMERIC_COLUMNS = [
    "year",
    "financial_loss_million",
    "affected_users",
    "loss_per_user",
]
LABEL_COLUMN = "resolution_time_hours"
PREDICTION_COLUMN = "predicted_resolution_time_hours"
# Accepted year range of an incident record (inclusive).
YEAR_MIN = 2015
YEAR_MAX = 2030
# Loss is stated in millions of dollars; loss per user is in dollars.
DOLLARS_PER_MILLION = 1_000_000.0
# Columns shown by the overview snapshot, and its row count.
SNAPSHOT_COLUMNS = [
    "country",
    "year",
    "attack_type",
    "target_industry",
    "financial_loss_million",
    "affected_users",
    "resolution_time_hours",
]
SNAPSHOT_ROWS = 12
# Random forest of the resolution-time model.
FOREST_TREES = 150
FOREST_DEPTH = 8
FOREST_SEED = 42
# Placeholder used for an all-unknown probe record.
UNKNOWN_LABEL = "__UNKNOWN__"
# Largest allowed difference between two scorings of the same record.
PARITY_TOLERANCE = 1e-6
# The four risk profiles.
PROFILE_NAMES = [
    "High-Impact Rapid-Response Incidents",
    "Widespread Low-Loss Incidents",
    "High-Impact Long-Resolution Incidents",
    "Concentrated High-Cost Incidents",
]
# Text read as missing by the dashboard's CSV loader (pandas' default list).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# --- end of fixed values -----------------------------------------------------

# Our choices (not stated by the analysed application).
CLUSTER_FEATURES = ["financial_loss_million", "affected_users", LABEL_COLUMN]
CLUSTER_K = 4
CLUSTER_SEED = 42
SILHOUETTE_K_RANGE = list(range(2, 9))
# Expected sign of each profile on (loss, users, resolution); 0 = not stated.
PROFILE_DIRECTIONS = {
    "High-Impact Rapid-Response Incidents": (1, 1, -1),
    "Widespread Low-Loss Incidents": (-1, 1, 0),
    "High-Impact Long-Resolution Incidents": (1, 1, 1),
    "Concentrated High-Cost Incidents": (1, -1, 0),
}
# Train/test rule: an incident is held out when incident_id % TEST_FOLDS == 0.
TEST_FOLDS = 5

STRING_COLUMNS = CATEGORICAL_COLUMNS

INCIDENT_SCHEMA = T.StructType([
    T.StructField("incident_id", T.LongType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("attack_type", T.StringType(), True),
    T.StructField("target_industry", T.StringType(), True),
    T.StructField("financial_loss_million", T.DoubleType(), True),
    T.StructField("affected_users", T.LongType(), True),
    T.StructField("attack_source", T.StringType(), True),
    T.StructField("vulnerability_type", T.StringType(), True),
    T.StructField("defense_mechanism", T.StringType(), True),
    T.StructField("resolution_time_hours", T.DoubleType(), True),
])
INCIDENT_COLUMNS = [f.name for f in INCIDENT_SCHEMA.fields]

# A scoring request: the incident fields without key and label.
RECORD_SCHEMA = T.StructType(
    [f for f in INCIDENT_SCHEMA.fields
     if f.name not in ("incident_id", LABEL_COLUMN)])

MODEL_LABELS_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("label_index", T.IntegerType(), False),
])

MODEL_DELTAS_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType(), False),
    T.StructField("label", T.StringType(), True),
    T.StructField("feature_index", T.IntegerType(), False),
    T.StructField("delta", T.DoubleType(), False),
])

MODEL_NODES_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType(), False),
    T.StructField("node_id", T.IntegerType(), False),
    T.StructField("is_leaf", T.BooleanType(), False),
    T.StructField("prediction", T.DoubleType(), False),
    T.StructField("feature_index", T.IntegerType(), True),
    T.StructField("split_type", T.StringType(), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("left_categories", T.ArrayType(T.DoubleType()), True),
    T.StructField("left_id", T.IntegerType(), True),
    T.StructField("right_id", T.IntegerType(), True),
    T.StructField("tree_weight", T.DoubleType(), False),
])

MODEL_INFO_SCHEMA = T.StructType([
    T.StructField("trees", T.IntegerType(), False),
    T.StructField("max_depth", T.IntegerType(), False),
    T.StructField("feature_count", T.IntegerType(), False),
])

BASELINE_COLUMN_NAME = "__baseline__"
# Raw text of an input record that did not parse against its schema.
CORRUPT_COLUMN = "_corrupt_record"
