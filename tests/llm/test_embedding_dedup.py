from __future__ import annotations

import numpy as np
import pytest

from riskspark.llm import embedding_dedup as ed


def data():
    rng = np.random.default_rng(5)
    rows = [list(map(float, v)) for v in rng.normal(size=(150, 16))]
    for k in range(12):
        base = rng.normal(size=16)
        rows += [list(map(float, base * rng.uniform(0.5, 3) + rng.normal(size=16) * 0.1)) for _ in range(1 + 4 * k)]
    rows += [rows[3]] * 5 + [[2 * x for x in rows[4]]]
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15,
             [1.0, 0.0], [1.0, 0.1], [-0.0] * 16, [1e300] * 16, [1e-300] * 16]
    return rows


def brute(rows, ids, cosine=0.9):
    ok = [r is not None and len(r) > 0 and all(x is not None and np.isfinite(x) for x in r) and any(r) for r in rows]
    unit = [np.array(r) / max(map(abs, r)) if o else None for r, o in zip(rows, ok)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    n = len(rows)
    link = [[i != j and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine
             for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j, x in enumerate(link[todo.pop()]):
                if x and j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((ids[j] for j in seen if ids[j] is not None), default=None)
        out.append((sum(link[i]), least, ids[i] == least if ids[i] is not None else least is None))
    return out


@pytest.mark.parametrize("block", [1024, 7])
def test_equals_brute_force(spark, block):
    rows = data()
    ids = [None if i % 13 == 5 else 5000 - i for i in range(len(rows))]
    ids[2] = ids[1]
    df = spark.createDataFrame([(d, r, i, 1) for i, (d, r) in enumerate(zip(ids, rows))],
                               "vec_id long, embedding array<double>, n long, links int")
    got = [tuple(r) for r in ed.near_duplicates(df, passes=16, neighbours=40, block=block).collect()]
    want = [(d, *w) for d, w in zip(ids, brute(rows, ids))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ranges_meet_at_their_borders(spark, monkeypatch):
    """Small ranges: pairs across borders are found, none below the cosine, recall stays."""
    monkeypatch.setattr(ed, "RANGE_ROWS", 300)
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 24))
    rows = np.concatenate([base + rng.normal(size=base.shape) * 0.12 for _ in range(10)])
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(rows)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in ed.near_duplicates(df, passes=8, neighbours=20).collect()}
    want = brute([list(map(float, np.float32(v))) for v in rows], list(range(len(rows))))
    found, full = sum(r.n_links for r in got.values()), sum(w[0] for w in want)
    assert all(got[i].n_links <= w[0] for i, w in enumerate(want)) and found >= 0.95 * full


def test_borders_reach_over_short_ranges(spark):
    """Ranges of 0 to 30 rows under a window of 20: every pair that stands within the window is found."""
    import random
    rng = random.Random(4)
    vectors = np.random.default_rng(4).normal(size=(400, 3))
    rows, sizes, at = [], [], 0
    while at < len(vectors):
        n = min(rng.choice([0, 0, 1, 2, 5, 19, 20, 21, 30]), len(vectors) - at)
        sizes.append(n)
        rows.append([(int(i >= 250), i, np.array(vectors[i]).tobytes(), len(sizes) - 1, 0, 3) for i in range(at, at + n)])
        at += n
    import pyarrow as pa
    names = ["pass", "cls", "vector", "part", "key", "size"]
    out = []
    for part in rows:
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in part[k:k + 7]]) for k in range(0, len(part), 7)]
        out += [r for b in ed.range_links(20, 0.9)(iter(batches)) for r in b.to_pylist()]
    found = spark.createDataFrame([tuple(r.values()) for r in out], ed.LINKED)
    outer = ed.around_borders(found, 20).groupBy("edge").applyInArrow(ed.border_links(20, 0.9), "u bigint, v bigint")
    got = set()
    for r in found.where("u IS NOT NULL").select("u", "v").union(outer).collect():
        got.add(tuple(sorted(r)))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = [(i, j) for i in range(400) for j in range(i + 1, min(400, i + 21)) if (i >= 250) == (j >= 250) and unit[i] @ unit[j] >= 0.9]

    def groups(links):
        label = list(range(400))
        for _ in range(400):
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        return label
    assert near and groups(got) == groups(near)


def test_empty_table(spark):
    assert ed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_passes_follow_the_count():
    assert ed.passes_for(1_000, 100, 0.9) == ed.PASSES
    assert ed.passes_for(50_000, 100, 0.9) < ed.passes_for(500_000, 100, 0.9) < ed.passes_for(2_000_000, 100, 0.9)


def test_pairs_in_a_dense_group_are_found(spark, monkeypatch):
    """Rows of mutual cosine 0.7, far more than a window, with pairs of cosine 0.92 among them."""
    monkeypatch.setattr(ed, "WHOLE", 700)
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.normal(size=64))

    def around(n):
        x = rng.normal(size=(n, 64))
        return unit(x - (x @ centre)[:, None] * centre)
    own = around(1500)
    other = around(300)
    other = unit(other - (other * own[:300]).sum(axis=1, keepdims=True) * own[:300])
    share = (0.92 - 0.7) / 0.3
    near = share * own[:300] + (1 - share * share) ** 0.5 * other
    rows = 0.7 ** 0.5 * centre + 0.3 ** 0.5 * np.concatenate([own, near])
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ed.near_duplicates(df, neighbours=10).collect()]
    at = rows @ rows.T >= 0.9
    assert {g[0]: g[1] for g in got} == dict(enumerate((at.sum(axis=1) - 1).tolist()))
