"""Property tests on random records (hypothesis)."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from riskspark.operators import export, features, forest, quality
from riskspark.plans import catalog
from riskspark.schema import INCIDENT_SCHEMA, YEAR_MAX, YEAR_MIN

TEXT = st.sampled_from([None, "", " ", "x", "NATION_3", "N/A", "1-URGENT", "unseen label"])
RECORD = st.fixed_dictionaries({
    "country": TEXT, "attack_type": TEXT, "target_industry": TEXT,
    "attack_source": TEXT, "vulnerability_type": TEXT, "defense_mechanism": TEXT,
    "year": st.one_of(st.none(), st.integers(2010, 2035)),
    "financial_loss_million": st.one_of(st.none(), st.sampled_from([-0.5, 0.0, 0.01, 99.9])),
    "affected_users": st.one_of(st.none(), st.integers(-2, 3), st.just(1_000_000)),
    "resolution_time_hours": st.one_of(st.none(), st.floats(0, 200)),
})
SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def python_reasons(r: dict) -> str:
    """The request rules, stated independently of the Spark code."""
    out = []

    def text(name):
        if r[name] is None:
            out.append(f"{name} is missing")
        elif len(r[name]) < 1:
            out.append(f"{name} is empty")

    def number(name, ok, message):
        if r[name] is None:
            out.append(f"{name} is missing")
        elif not ok(r[name]):
            out.append(f"{name} {message}")
    text("country")
    number("year", lambda v: YEAR_MIN <= v <= YEAR_MAX, f"outside {YEAR_MIN}..{YEAR_MAX}")
    text("attack_type")
    text("target_industry")
    number("financial_loss_million", lambda v: v >= 0, "is negative")
    number("affected_users", lambda v: v >= 1, "is below 1")
    text("attack_source")
    text("vulnerability_type")
    text("defense_mechanism")
    return ";".join(out)


def frame(spark, records):
    rows = [tuple(dict(r, incident_id=i)[f.name] for f in INCIDENT_SCHEMA.fields)
            for i, r in enumerate(records)]
    return spark.createDataFrame(rows, INCIDENT_SCHEMA)


@SETTINGS
@given(records=st.lists(RECORD, min_size=1, max_size=60))
def test_validation_matches_rules(spark, records):
    got = {r["incident_id"]: (r["reject_reasons"], r["is_valid"], r["loss_per_user"])
           for r in quality.validate(frame(spark, records)).collect()}
    for i, r in enumerate(records):
        reasons = python_reasons(r)
        assert got[i][0] == reasons and got[i][1] == (reasons == "")
        users, loss = r["affected_users"], r["financial_loss_million"]
        expected = None if users in (None, 0) or loss is None else loss * 1_000_000 / users
        assert got[i][2] == pytest.approx(expected) if expected is not None else got[i][2] is None


@pytest.fixture(scope="module")
def fitted_features(spark):
    cleaned = catalog.cleaned_incidents(spark, SF_SMALL)
    feats = features.fit_features(features.train_part(cleaned))
    return feats, export.model_deltas(spark, feats).cache()


@SETTINGS
@given(records=st.lists(RECORD, min_size=1, max_size=40))
def test_delta_rebuild_equals_pipeline(spark, fitted_features, records):
    feats, deltas = fitted_features
    df = quality.validate(frame(spark, records))  # adds loss_per_user (NULL for 0 users)
    rebuilt = forest.features_from_deltas(df, deltas, features.feature_size(feats))
    direct = features.encoded_features(feats, df)
    # NaN slots (NULL numbers) compare equal in Spark's set semantics
    assert rebuilt.exceptAll(direct).count() == 0
    assert direct.exceptAll(rebuilt).count() == 0
