from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from riskspark.llm import quality_lm as ql


def brute_model(texts, order):
    """Interpolated modified Kneser-Ney from its definition."""
    padded = [ql.START * (order - 1) + (t or "") + ql.END for t in texts]
    counts = {order: Counter(t[i:i + order] for t in padded for i in range(len(t) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    after = {}
    for k, c in counts.items():
        n = [0] + [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = [0] + [min(max(j - (j + 1) * y * n[j + 1] / n[j], 0), j) if n[j] else 0.5 * j for j in (1, 2, 3)]
        sums = defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            sums[g[:-1]][0] += v
            sums[g[:-1]][1] += d[min(v, 3)]
        after[k] = (d, sums)

    def p(gram):
        if not gram:
            return 1 / (len(counts[1]) + 1)
        d, sums = after[len(gram)]
        if gram[:-1] not in sums:
            return p(gram[1:])
        total, taken = sums[gram[:-1]]
        v = counts[len(gram)][gram]
        return max(v - d[min(v, 3)], 0) / total + taken / total * p(gram[1:])

    def log_perplexity(text):
        t = ql.START * (order - 1) + (text or "") + ql.END
        n = len(t) - order + 1
        return -sum(math.log(p(t[i:i + order])) for i in range(n)) / n
    return p, log_perplexity, counts


def corpus():
    rng = random.Random(9)
    good = ["".join(rng.choice(["the ", "on ", "ing ", "é", "x\n", "a"]) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    junk = ["".join(rng.choice("#$%qzjx东🙂") for _ in range(rng.randrange(1, 60))) for _ in range(10)]
    return good + junk + [None, "", "the " * 4000] + good[:3]


def test_equals_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i if i % 17 else None, t, ["en", "fr", None, "zz"][i % 4], 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, n int")
    trusted = [i for i in range(40) if i % 3 and i % 4 != 3 and i % 17]
    labels = spark.createDataFrame([(i, int(i in trusted)) for i in range(50)] + [(None, 1), (trusted[0], 1), (3, None)],
                                   "doc_id long, quality int")
    _, log_perplexity, _ = brute_model([texts[i] for i in trusted], 3)
    got = ql.classify(docs, labels, order=3, low=0.05, high=0.9, chunk_bytes=500).collect()
    key = lambda r: str(r[:3])
    found = sorted([(r.doc_id, r.lang, r.n_chars, r.perplexity) for r in got], key=str)
    want = sorted([(i if i % 17 else None, ["en", "fr", None, "zz"][i % 4], len(t or ""), math.exp(log_perplexity(t)))
                   for i, t in enumerate(texts)], key=str)
    assert [f[:3] for f in sorted(found, key=key)] == [w[:3] for w in sorted(want, key=key)]
    assert [f[3] for f in sorted(found, key=lambda r: (key(r), r[3]))] == pytest.approx(
        [w[3] for w in sorted(want, key=lambda r: (key(r), r[3]))])
    for lang in ("en", "fr", None, "zz"):
        own = sorted(math.floor(log_perplexity(texts[i]) / ql.BIN) for i in trusted if lang == "zz" or ["en", "fr", None, "zz"][i % 4] == lang)
        low = next(v for k, v in enumerate(own, 1) if sum(x <= v for x in own) > 0.05 * len(own))
        high = next(v for v in own if sum(x <= v for x in own) >= 0.9 * len(own))
        for r in got:
            if r.lang == lang:
                assert r.low == pytest.approx(math.exp(low * ql.BIN)) and r.high == pytest.approx(math.exp((high + 1) * ql.BIN))
                assert r.kept == (r.low <= r.perplexity <= r.high)


def test_probabilities_sum_to_one():
    p, _, counts = brute_model(["abracadabra", "cab"], 3)
    for context in ("ab", "ra", "zz"):
        seen = sum(p(context + g) for g in counts[1])
        assert seen + p(context + "?") == pytest.approx(1)


def test_no_trusted_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.kept for r in ql.classify(docs, labels).collect()] == [True]
    assert ql.classify(docs.limit(0), labels).count() == 0


def test_odd_trusted_texts_do_not_set_the_bounds(spark):
    """With the production quantiles an odd trusted text in 200 lets no junk of its kind through."""
    rng = random.Random(2)
    good = [" ".join(rng.choice(["the", "on", "sea", "tide", "moon", "high", "low"]) for _ in range(60)) for _ in range(200)]
    texts = [*good, "zq#" * 90, *["#qz" * (60 + i) for i in range(5)], *["the " * (80 + i) for i in range(5)]]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(201)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in ql.classify(docs, labels, folds=ql.FOLDS, prior=ql.PRIOR).collect()}
    assert len(got) == len(texts) and not any(got[i] for i in range(200, len(texts)))
    assert sum(got[i] for i in range(200)) >= 190


def test_trusted_texts_are_scored_without_their_own_counts(spark):
    texts = corpus()[:40]
    texts += texts[:2]
    docs = spark.createDataFrame([(i, t, None if i % 5 else "fr") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    trusted = [i for i in range(len(texts)) if i % 3]
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
    fold = {r.text: r.f for r in docs.selectExpr("text", "pmod(xxhash64('fold', text), 2) AS f").collect()}
    models = [brute_model([texts[i] for i in trusted if fold[texts[i]] != f], 3)[1] for f in (0, 1)]
    whole = brute_model([texts[i] for i in trusted], 3)[1]
    got = {r.doc_id: r for r in ql.classify(docs, labels, order=3, low=0.2, high=0.8, folds=2, prior=5).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].perplexity == pytest.approx(math.exp((models[fold[t]] if i in trusted else whole)(t)))

    def quantiles(values):
        bins = sorted(math.floor(v / ql.BIN) for v in values)
        low = next(v for v in bins if sum(x <= v for x in bins) > 0.2 * len(bins))
        high = next(v for v in bins if sum(x <= v for x in bins) >= 0.8 * len(bins))
        return low * ql.BIN, (high + 1) * ql.BIN
    own = {i: models[fold[texts[i]]](texts[i]) for i in trusted}
    overall = quantiles(own.values())
    for lang in (0, 1):  # fr, and the rest: the bounds lie between their own and those over all
        mine = [v for i, v in own.items() if (i % 5 > 0) == lang]
        want = [math.exp((len(mine) * a + 5 * b) / (len(mine) + 5)) for a, b in zip(quantiles(mine), overall)]
        for i, r in got.items():
            if (i % 5 > 0) == lang:
                assert (r.low, r.high) == (pytest.approx(want[0]), pytest.approx(want[1]))


@pytest.mark.parametrize("folds", [1, 3])
def test_fold_columns_are_the_counts_without_a_fold(spark, folds):
    texts = corpus()[:45]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    fold = {r.text: r.f for r in docs.select("text", ql.fold_of(docs.text, folds).alias("f")).collect()}
    model = ql.Model(ql.trained_counts(docs, "text", 3, folds), 3)
    for c, left_out in zip(model.names, [None, *range(folds)] if folds > 1 else [None]):
        _, _, counts = brute_model([t for t in texts if fold[t] != left_out], 3)
        for k, table in model.counts.items():
            assert {r.gram: r[c] for r in table.collect() if r[c]} == dict(counts[k])
    model.discard()
