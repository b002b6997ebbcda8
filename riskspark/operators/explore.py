"""Exploration queries of the dashboard over the incidents table.

Each function takes a DataFrame and returns a DataFrame; nothing is fetched
to the driver.  Group-bys aggregate partially before the shuffle; a NULL
group key is left out of group results; ties are ordered by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.schema import CATEGORICAL_COLUMNS, SNAPSHOT_COLUMNS, SNAPSHOT_ROWS


def filter_countries(df: DataFrame, countries: Sequence[str] | None) -> DataFrame:
    """Rows whose country is in the list; an empty or missing list keeps all.

    A plain ``isin`` so Catalyst pushes it into the parquet scan.
    """
    if not countries:
        return df
    return df.where(F.col("country").isin(list(countries)))


def overview_kpis(df: DataFrame) -> DataFrame:
    """Total incidents, distinct countries, distinct attack types."""
    return df.agg(
        F.count(F.lit(1)).alias("total_incidents"),
        F.count_distinct("country").alias("countries"),
        F.count_distinct("attack_type").alias("attack_types"),
    )


def filtered_kpis(df: DataFrame, countries: Sequence[str] | None) -> DataFrame:
    """Matching incidents, mean loss and mean resolution after the filter."""
    return filter_countries(df, countries).agg(
        F.count(F.lit(1)).alias("matching_incidents"),
        F.avg("financial_loss_million").alias("average_loss_million"),
        F.avg("resolution_time_hours").alias("average_resolution_hours"),
    )


def incidents_by_year(df: DataFrame) -> DataFrame:
    return (df.where(F.col("year").isNotNull())
            .groupBy("year").agg(F.count(F.lit(1)).alias("incident_count"))
            .orderBy("year"))


def attack_distribution(df: DataFrame) -> DataFrame:
    """Incidents per attack type, most frequent first."""
    return (df.where(F.col("attack_type").isNotNull())
            .groupBy("attack_type")
            .agg(F.count(F.lit(1)).alias("incident_count"))
            .orderBy(F.desc("incident_count"), F.asc("attack_type")))


def average_loss_by_attack(df: DataFrame) -> DataFrame:
    """Mean loss per attack type, smallest mean first."""
    return (df.where(F.col("attack_type").isNotNull())
            .groupBy("attack_type")
            .agg(F.avg("financial_loss_million").alias("financial_loss_million"))
            .orderBy(F.asc("financial_loss_million"), F.asc("attack_type")))


def distinct_options(df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Sorted distinct non-NULL values of several columns in one pass.

    The columns are unpivoted into (column_name, value) rows, so a single
    partial-then-final aggregate serves all of them.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("option")).select("option.*")
    return (stacked.where(F.col("value").isNotNull()).distinct()
            .orderBy("column_name", "value"))


def incident_snapshot(df: DataFrame, columns: Sequence[str] = SNAPSHOT_COLUMNS,
                      rows: int = SNAPSHOT_ROWS) -> DataFrame:
    """The first rows by incident id (a top-k: ``TakeOrderedAndProject``)."""
    return df.select("incident_id", *columns).orderBy("incident_id").limit(rows)
