"""What large fits, streams and walks keep on disk."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from riskspark.operators import features, forest, resolution
from riskspark.plans import catalog


@pytest.fixture(scope="module")
def train(spark):
    return features.train_part(catalog.cleaned_incidents(spark, SF_SMALL))


def test_a_fit_of_many_rows_keeps_no_node_ids(spark, train, monkeypatch):
    """Three generations of ids of every row and tree would fill the disks; the forest is the same without."""
    few = resolution.fit_resolution_model(train, trees=4, depth=5)
    monkeypatch.setattr(resolution, "NODE_ID_ROWS", train.count() - 1)
    many = resolution.fit_resolution_model(train, features.fit_features(train), trees=4, depth=5)
    assert few.stages[-1].getCacheNodeIds() and not many.stages[-1].getCacheNodeIds()
    both = few.transform(train).select(*train.columns, F.col("prediction").alias("a"))
    both = many.transform(both).withColumnRenamed("prediction", "b")
    assert forest.parity(both, "a", "b", 0.0).first()["within_tolerance"]


def test_a_fit_leaves_no_shuffles(spark, train):
    """What dealt the rows and added the statistics is deleted, not left to a chance collection."""
    import glob
    import os
    import time
    local = spark.sparkContext._jvm.org.apache.spark.util.Utils.getConfiguredLocalDirs(spark.sparkContext._jsc.sc().conf())
    def files():
        return {f for d in local for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before = files()
    resolution.fit_resolution_model(train, trees=2, depth=3)
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - before, os.linesep.join(files() - before)


def test_stream_arrivals_are_compressed(spark, train, monkeypatch):
    """The arrivals take less disk than plain text would, and the model is there before they are."""
    import os
    model = resolution.fit_resolution_model(train, trees=2, depth=3)
    order, seen = [], {}
    monkeypatch.setattr(catalog, "resolution_model", lambda *a: order.append("model") or model)
    write, run = catalog.files.write_json, catalog.scoring.run_until_drained

    def written(df, path, **options):
        order.append("arrivals")
        return write(df, path, **options)

    def drained(spark, model, source, *rest, **options):
        seen["source"] = source
        return run(spark, model, source, *rest, **options)
    monkeypatch.setattr(catalog.files, "write_json", written)
    monkeypatch.setattr(catalog.scoring, "run_until_drained", drained)
    scored = catalog.streamed_scores(spark, SF_SMALL)
    assert order == ["model", "arrivals"]
    lines = spark.read.text(seen["source"])
    plain = lines.agg(F.sum(F.length("value") + 1)).first()[0]
    on_disk = sum(os.path.getsize(f.removeprefix("file://")) for f in lines.inputFiles())
    assert on_disk < plain / 5
    assert lines.count() == catalog.raw_incidents(spark, SF_SMALL).count()
    valid = catalog.quality.validate(catalog.quality.normalize_text(catalog.raw_incidents(spark, SF_SMALL))).where("is_valid")
    assert scored.drop("batch_id").exceptAll(resolution.score(model, valid)).count() == 0 and scored.count() == valid.count()
