from __future__ import annotations

import random

import pytest

from riskspark.llm import graph


@pytest.mark.parametrize("last", [0, 1 << 18])
def test_components(spark, monkeypatch, last):
    monkeypatch.setattr(graph, "LAST_EDGES", last)
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (7, None)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] * 2 + [(500, 499), (500, 498)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent)


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


def test_no_scratch_is_left(spark, monkeypatch):
    """Rounds delete what the round before them wrote; ``clear`` deletes the rest, checkpoints too."""
    import glob
    import os

    from riskspark.llm import common, simhash
    from riskspark.session import checkpoint_root
    monkeypatch.setattr(graph, "LAST_EDGES", 4)
    root = checkpoint_root(spark).removeprefix("file:")
    files = lambda: {f for f in glob.glob(f"{root}/**", recursive=True) if os.path.isfile(f)}
    common.clear(spark)
    before = files()
    edges = spark.range(400).selectExpr("id AS u", "id + 1 AS v")
    assert graph.components(edges).agg({"component": "max"}).first()[0] == 0
    assert len({os.path.dirname(f) for f in files() - before}) == 1  # the result alone
    docs = spark.createDataFrame([(i, f"w{i // 2} " * 40) for i in range(40)], "doc_id long, text string")
    simhash.near_duplicates(docs, ["doc_id"]).write.format("noop").mode("overwrite").save()
    common.clear(spark)
    assert files() == before
