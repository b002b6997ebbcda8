from __future__ import annotations

import math
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskspark.session import build_session
    session = build_session("local[4]", app_name="riskspark-tests", shuffle_partitions=8,
                            conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="rs-test-ckpt-")})
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from riskspark.session import shared_path
    return shared_path(spark, "tests", unique=True)


def normalize(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return tuple(normalize(v) for v in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normalize(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
