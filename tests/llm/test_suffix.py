from __future__ import annotations

import hashlib
import random
from collections import Counter

from riskspark.llm import repeats, suffix


def brute(texts, k):
    docs = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + k] for d in docs for i in range(len(d) - k + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - k + 1):
            if seen[d[i:i + k]] > 1:
                gone[i:i + k] = [True] * k
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)),
                    hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcd é") for _ in range(n))
    passages = [make(rng.randrange(20, 700)) for _ in range(6)]
    texts = [None, "", "x", "a" * 1500, "ab" * 900]
    for _ in range(30):
        text = make(rng.randrange(0, 200))
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                at = rng.randrange(len(p))
                p = p[:at] + "!" + p[at + 1:]
            text += p + make(rng.randrange(0, 60))
        texts.append(text)
    return texts + texts[6:10] + [texts[8]] * 4 + [make(6000)] * 2


def test_equals_brute_force(spark):
    for seed, (window, anchor, shard) in enumerate([(400, 48, 8 << 20), (60, 9, 3000)]):
        texts = corpus(seed)
        docs = spark.createDataFrame([(i if i % 7 else None, t, i, "x") for i, t in enumerate(texts)],
                                     "doc_id long, text string, i long, h string")
        got = {r.row.i: (r.n_units, r.n_removed, r.n_spans, r.kept_sha256) for r in
               suffix.remove_repeats(docs, ["i", "h"], window=window, anchor=anchor, shard_bytes=shard).collect()}
        want = brute(texts, window)
        assert got == dict(enumerate(want))


def hot_corpus(seed, n):
    """One passage, shorter and longer than a window, in very many different surroundings; and some true repeats."""
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice("abcdefgh é") for _ in range(k))
    passage, whole = make(55), make(70)
    texts = [make(rng.randrange(80, 160)) + passage + make(rng.randrange(80, 160)) for _ in range(n)]
    texts += [make(50) + whole + make(50) for _ in range(n // 10)]
    texts += [make(20) + texts[3][60:200] + make(20), passage * 4, texts[5], texts[5]]
    return texts


def test_hot_anchor_is_split(spark):
    texts = hot_corpus(1, 300)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").repartition(4)
    found = {}
    for shard in (400, 4000, 64 << 20):  # split into windows, into parts, and not
        rows = suffix.remove_repeats(docs, ["i"], window=60, anchor=20, shard_bytes=shard)
        found[shard] = {r.row.i: (r.n_units, r.n_removed, r.n_spans, r.kept_sha256) for r in rows.collect()}
    assert found[400] == found[4000] == found[64 << 20] == dict(enumerate(brute(texts, 60)))


def test_parts_agree_on_equal_windows():
    rng = random.Random(2)
    window, anchor = 60, 20
    same = bytes(rng.randrange(97, 100) for _ in range(130))
    one, two = b"xyz" + same, bytes(rng.randrange(97, 100) for _ in range(40)) + same
    keys = []
    for content in (one, two):
        key, _, first, count = suffix.parts_of(content, window, anchor)
        assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all() and first[-1] + count[-1] == len(content) - window + 1
        keys.append({content[f + i:f + i + window]: k for k, f, c in zip(key, first, count) for i in range(c)})
    shared = set(keys[0]) & set(keys[1])
    assert len(shared) >= 71 and all(keys[0][w] == keys[1][w] for w in shared)


def test_shards_stay_small_around_a_hot_anchor(spark):
    """60 MB around one anchor make no shard beyond its size, and what stands alone is not sorted."""
    from pyspark.sql import functions as F
    context = F.concat(*[F.md5(F.concat(F.col("id").cast("string"), F.lit(f"/{k}"))) for k in range(9)])
    # rows as ``different`` gives them: one anchor, 100 bytes, in the middle of 288 different ones
    text = F.concat(context, F.lit("0" * 99 + "1"), F.md5(F.col("id").cast("string")), F.lit("."), context)
    rows = spark.range(90_000).select(F.lit(7).cast("long").alias("h"), F.col("id").alias("s"), F.lit(1).cast("long").alias("n"),
                                      F.lit(311).alias("count"), text.cast("binary").alias("content"))
    assert rows.agg(F.sum(F.octet_length("content"))).first()[0] > 60 << 20
    shards = suffix.sharded(rows, 400, 100, 2 << 20)[0].groupBy("shard").agg(F.sum(F.octet_length("content")).alias("b"))
    assert (shards.agg(F.max("b")).first()[0] or 0) < 4 << 20


def test_long_texts_are_cut_into_segments(spark, monkeypatch):
    rng = random.Random(9)
    base = bytes(rng.randrange(256) for _ in range(900))
    units = repeats.Units(False, 50, 8)
    whole = repeats.stretches(units.codes([base]), units)
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    parts = repeats.stretches(units.codes([base]), units)
    windows = lambda found: sorted((int(h), int(p >> repeats.COUNT_BITS) + k) for p, h in zip(found[1], found[2])
                                   for k in range(int(p) & repeats.MOST))
    assert windows(whole) == windows(parts) and len(windows(whole)) == 851


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(docs, ["doc_id"]).count() == 0
