"""File sources and sinks for incident tables.

Reads always pass an explicit schema (no inference pass over the data).
A missing path raises at analysis time; it is never silently empty.
CSV follows the dashboard loader's missing-value rules: the usual
missing-value tokens in text and ``NaN`` in numbers load as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalar import loss_per_user
from riskspark.schema import CORRUPT_COLUMN, INCIDENT_SCHEMA
from riskspark.sources.records import read_requests, typed

CLEANED_SCHEMA = T.StructType(
    list(INCIDENT_SCHEMA.fields) + [T.StructField("loss_per_user", T.DoubleType(), True)])


# Columns a stored incident table may have besides the cleaned ones.
OPTIONAL_COLUMNS = T.StructType([
    T.StructField("cluster_id", T.IntegerType(), True),
    T.StructField("risk_profile", T.StringType(), True),
])


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def read_incidents_csv(spark: SparkSession, path: str, schema: T.StructType = CLEANED_SCHEMA,
                       multi_line: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """A CSV incident table, its columns found by the names in the header.

    Quotes are doubled inside quoted fields.  ``multi_line`` allows line ends
    inside quotes; a file is then read by one task, so leave it off for large
    files without such fields.  Missing columns raise, except the key, the
    derived loss per user and ``OPTIONAL_COLUMNS``: the key is NULL without its
    column (``with_generated_ids``), the loss is derived, the others are left
    out.  ``keep_corrupt`` adds ``_corrupt_record``, naming what is no number.
    """
    raw = (spark.read.option("header", True).option("escape", '"')
           .option("multiLine", multi_line).csv(path))
    fields = list(schema.fields) + [f for f in OPTIONAL_COLUMNS.fields if f.name in raw.columns and f.name not in schema.names]
    optional = {"incident_id", "loss_per_user", *OPTIONAL_COLUMNS.names}
    missing = [f.name for f in fields if f.name not in raw.columns and f.name not in optional]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    text = raw.select(*[F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None).cast("string").alias(f.name)
                        for f in fields], F.lit(None).cast("string").alias(CORRUPT_COLUMN))
    out = typed(text, T.StructType(fields), normalize=True)
    if "loss_per_user" in schema.names and "loss_per_user" not in raw.columns:
        out = out.withColumn("loss_per_user", loss_per_user())
    return out if keep_corrupt else out.drop(CORRUPT_COLUMN)


def write_json(df: DataFrame, path: str, compression: str | None = None) -> str:
    df.write.mode("overwrite").json(path, compression=compression)
    return path


def read_incidents_json(spark: SparkSession, path: str,
                        schema: T.StructType = CLEANED_SCHEMA) -> DataFrame:
    """JSON lines, one incident object per line (the scoring request body)."""
    return read_requests(spark, path, "json", schema).drop(CORRUPT_COLUMN)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
