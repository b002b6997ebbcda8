"""Validation and cleaning edge cases (FIXTURES section 3)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskspark.operators import quality
from riskspark.schema import INCIDENT_SCHEMA

GOOD = dict(incident_id=1, country="Australia", year=2024, attack_type="DDoS",
            target_industry="Banking", financial_loss_million=50.0, affected_users=100000,
            attack_source="Hacker Group", vulnerability_type="Social Engineering",
            defense_mechanism="AI-based Detection", resolution_time_hours=30.0)


def frame(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = dict(GOOD, incident_id=i + 1)
        row.update(change)
        rows.append(tuple(row[f.name] for f in INCIDENT_SCHEMA.fields))
    return spark.createDataFrame(rows, INCIDENT_SCHEMA)


def reasons(spark, *changes):
    out = quality.validate(frame(spark, *changes)).orderBy("incident_id").collect()
    return [r["reject_reasons"] for r in out]


def test_valid_record_and_loss_per_user(spark):
    row = quality.validate(frame(spark, {})).first()
    assert row["is_valid"] and row["reject_reasons"] == ""
    assert row["loss_per_user"] == 500.0


@pytest.mark.parametrize("year,ok", [(2014, False), (2015, True), (2030, True), (2031, False)])
def test_year_bounds(spark, year, ok):
    assert (reasons(spark, {"year": year})[0] == "") is ok


def test_negative_loss_and_zero_users(spark):
    r = quality.validate(frame(spark, {"financial_loss_million": -1.0},
                               {"affected_users": 0})).orderBy("incident_id").collect()
    assert r[0]["reject_reasons"] == "financial_loss_million is negative"
    assert r[1]["reject_reasons"] == "affected_users is below 1"
    assert r[1]["loss_per_user"] is None  # no division error


def test_empty_and_null_strings(spark):
    got = reasons(spark, {"country": ""}, {"attack_type": None})
    assert got == ["country is empty", "attack_type is missing"]


def test_two_faults_listed_in_column_order(spark):
    got = reasons(spark, {"country": "", "affected_users": 0})
    assert got == ["country is empty;affected_users is below 1"]


def test_null_number_rejected(spark):
    assert reasons(spark, {"year": None}) == ["year is missing"]


def test_clean_normalizes_drops_and_deduplicates(spark):
    df = frame(spark, {"country": "  Malaysia  "}, {"country": "N/A"},
               {"resolution_time_hours": None}, {})
    # a duplicate copy of incident 1 with identical content
    df = df.unionByName(df.where("incident_id = 1"))
    out = quality.clean(df).orderBy("incident_id").collect()
    assert [r["incident_id"] for r in out] == [1, 4]
    assert out[0]["country"] == "Malaysia"
    assert out[0]["loss_per_user"] == 500.0


def test_dedup_keeps_smallest_row_deterministically(spark):
    df = frame(spark, {"country": "B"}, {"country": "A"}).selectExpr(
        "1L AS incident_id", *[c for c in frame(spark, {}).columns if c != "incident_id"])
    out = quality.deduplicate(df).collect()
    assert len(out) == 1 and out[0]["country"] == "A"


def test_rejected_by_reason_counts(spark):
    df = frame(spark, {"country": ""}, {"country": "", "year": 2040}, {})
    out = {r["reason"]: r["rejected_rows"] for r in quality.rejected_by_reason(df).collect()}
    assert out == {"country is missing": 2, "year outside 2015..2030": 1}


def test_split_valid(spark):
    valid, rejected = quality.split_valid(quality.validate(frame(spark, {}, {"year": 1999})))
    assert [r["incident_id"] for r in valid.collect()] == [1]
    assert [r["incident_id"] for r in rejected.collect()] == [2]


def test_every_dropped_row_has_a_reason(spark):
    df = frame(spark, {}, {}, {}, {"country": ""}).withColumn(
        "incident_id", F.when(F.col("incident_id") == 3, F.lit(None)).otherwise(F.col("incident_id")))
    df = df.unionByName(df.where("incident_id = 1")).unionByName(df.where("incident_id = 2").withColumn("year", F.lit(2020)))
    out = {r["reason"]: r["rejected_rows"] for r in quality.rejected_by_reason(df).collect()}
    assert out == {"country is missing": 1, "incident_id is missing": 1, "incident_id is repeated": 2}
    assert quality.clean(df).count() + sum(out.values()) == df.count()


def test_nan_is_missing_or_rejected(spark):
    nan = float("nan")
    assert reasons(spark, {"financial_loss_million": nan}) == ["financial_loss_million is not a number"]
    assert quality.clean(frame(spark, {"resolution_time_hours": nan}, {"financial_loss_million": nan}, {})).count() == 1


def test_generated_ids(spark):
    df = quality.with_generated_ids(frame(spark, {}, {}, {}).drop("incident_id"))
    assert quality.clean(df).count() == 3
