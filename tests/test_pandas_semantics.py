"""Dashboard operators equal the pandas semantics they reproduce (random data)."""

from __future__ import annotations

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskspark.operators import explore
from riskspark.schema import INCIDENT_SCHEMA

ROW = st.fixed_dictionaries({
    "country": st.sampled_from([None, "A", "B", "C"]),
    "year": st.one_of(st.none(), st.integers(2015, 2018)),
    "attack_type": st.sampled_from([None, "DDoS", "Malware", "Phishing"]),
    "financial_loss_million": st.one_of(st.none(), st.floats(0, 100, allow_nan=False)),
    "resolution_time_hours": st.one_of(st.none(), st.floats(1, 80, allow_nan=False)),
})
SETTINGS = settings(max_examples=8, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def frames(spark, rows):
    full = [dict(r, incident_id=i, target_industry="X", affected_users=1, attack_source="S",
                 vulnerability_type="V", defense_mechanism="D") for i, r in enumerate(rows)]
    sdf = spark.createDataFrame([tuple(r[f.name] for f in INCIDENT_SCHEMA.fields) for r in full],
                                INCIDENT_SCHEMA)
    pdf = pd.DataFrame(full, columns=[f.name for f in INCIDENT_SCHEMA.fields])
    return sdf, pdf


def same(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a))


@SETTINGS
@given(rows=st.lists(ROW, min_size=1, max_size=40),
       selection=st.lists(st.sampled_from(["A", "B", "Z"]), max_size=2))
def test_dashboard_matches_pandas(spark, rows, selection):
    sdf, pdf = frames(spark, rows)
    # overview: len and nunique (NULLs not counted)
    o = explore.overview_kpis(sdf).first()
    assert o["total_incidents"] == len(pdf)
    assert o["countries"] == pdf["country"].nunique()
    assert o["attack_types"] == pdf["attack_type"].nunique()
    # filter: an empty selection keeps everything; means skip NULLs
    chosen = pdf[pdf["country"].isin(selection)] if selection else pdf
    k = explore.filtered_kpis(sdf, selection).first()
    assert k["matching_incidents"] == len(chosen)
    assert same(k["average_loss_million"], chosen["financial_loss_million"].mean())
    assert same(k["average_resolution_hours"], chosen["resolution_time_hours"].mean())
    # per year: groupby(...).size() drops NULL keys, sorted by key
    by_year = [(r["year"], r["incident_count"]) for r in explore.incidents_by_year(sdf).collect()]
    expected = pdf.groupby("year").size()
    assert by_year == [(int(y), int(n)) for y, n in expected.items()]
    # attack distribution: value_counts (ties: any order there, by key here)
    dist = {r["attack_type"]: r["incident_count"]
            for r in explore.attack_distribution(sdf).collect()}
    assert dist == {k2: int(v) for k2, v in pdf["attack_type"].value_counts().items()}
    # mean loss per attack type
    means = {r["attack_type"]: r["financial_loss_million"]
             for r in explore.average_loss_by_attack(sdf).collect()}
    expected_means = pdf.groupby("attack_type")["financial_loss_million"].mean()
    assert set(means) == set(expected_means.index)
    assert all(same(means[k2], v) for k2, v in expected_means.items())
