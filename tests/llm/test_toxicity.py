from __future__ import annotations

import random
import zlib

import numpy as np

from riskspark.llm import toxicity as tx

BAD = ["idiot", "scum", "moron"]


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "ti", "sh"]) for _ in range(rng.randrange(1, 4)))
    texts, labels = [], []
    for _ in range(n):
        words = [word() for _ in range(rng.randrange(1, 120))]
        bad = rng.random() < 0.4
        for _ in range(2 if bad else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
        texts.append(" ".join(words))
        labels.append(int(bad))
    return texts, labels


def test_gradients():
    net = tx.Network.fresh({b"a": 1, b"bc": 2}, hidden=3)
    rng = np.random.default_rng(0)
    net.p["attend"] = rng.normal(size=6)
    words = [b"a", b"bc", b"rare", b""]
    ids = rng.integers(0, 4, (5, 6))
    mask = np.arange(6) < np.array([6, 6, 1, 3, 5])[:, None]
    labels = np.array([0, 1, 1, 0, 1.0])
    _, grad = net.gradients(words, ids, mask, labels)
    for name, g in grad.items():
        flat = net.p[name].reshape(-1)
        for k in rng.choice(np.flatnonzero(g) if name in ("word", "char") else flat.size, 5):
            old = flat[k]
            flat[k] = old + 1e-5
            up, _ = net.gradients(words, ids, mask, labels)
            flat[k] = old - 1e-5
            down, _ = net.gradients(words, ids, mask, labels)
            flat[k] = old
            assert abs((up - down) / 2e-5 - g.reshape(-1)[k]) < 1e-6, name


def test_windows_cover_all_words():
    for n in [*range(1, 140), 1000]:
        at = tx.starts(n)
        assert at[0] == 0 and (np.diff(at) <= tx.STRIDE).all() and (np.diff(at) > 0).all()
        assert at[-1] == max(0, n - tx.WINDOW)


def test_held_out_accuracy():
    texts, labels = corpus(500, 1)
    net = tx.train([t.encode() for t in texts], labels)
    more, truth = corpus(300, 2)
    scorer = tx.Scorer(net)
    found = scorer.score([t.encode() for t in more])
    assert ((found >= 0.5) == np.array(truth)).mean() > 0.95
    one = [scorer.score([t.encode()])[0] for t in more[:20]]
    assert np.allclose(one, found[:20], atol=1e-5)
    assert scorer.score([("er on " * 3000 + "scum").encode()])[0] >= 0.5


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(tx, "EPOCHS", 2)
    texts, labels = corpus(200, 3)
    rows = [(i, t, i, 0.5) for i, t in enumerate(texts)] + [(None, None, 0, 0.1), (500, "", 0, 0.1), (3, texts[3], 3, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang long, score double")
    table = spark.createDataFrame([(i, y, 1) for i, y in enumerate(labels)] + [(None, 1, 1), (7, None, 1)],
                                  "doc_id long, toxic int, quality int")
    got = tx.scores(docs, table, epochs=2).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0) for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    sample = tx.training_sample(docs, table, per_class=20)
    assert sum(sample[1]) == 20 and len(sample[1]) == 40
    assert tx.scores(docs.limit(0), table, epochs=1).count() == 0
    assert all(r.score < 0.5 for r in tx.scores(docs, table.limit(0), epochs=1).collect())


def plain_score(net, text):
    """One text, window by window and word by word, in double precision and without batches or masks."""
    p, hidden = net.p, net.p["state"].shape[1]
    words = tx.words_of(text)
    logits = []
    for start in tx.starts(len(words)):
        window = words[start:start + tx.WINDOW]
        states = [[], []]
        for way in (0, 1):
            h, u = np.zeros(hidden), p["state"][way]
            for w in (window, window[::-1])[way]:
                grams = tx.trigrams(w)
                x = np.concatenate([p["word"][net.vocabulary.get(w, 0)], sum(p["char"][g] for g in grams) / len(grams)])
                gates = (x @ p["input"] + p["bias"])[3 * hidden * way:3 * hidden * (way + 1)]
                back = h @ u
                z, r = (1 / (1 + np.exp(-(gates[k * hidden:(k + 1) * hidden] + back[k * hidden:(k + 1) * hidden]))) for k in (0, 1))
                c = np.tanh(gates[2 * hidden:] + r * back[2 * hidden:])
                h = (1 - z) * c + z * h
                states[way].append(h)
        both = [np.concatenate(s) for s in zip(states[0], states[1][::-1])]
        weight = np.exp([s @ p["attend"] for s in both])
        pooled = sum(w * s for w, s in zip(weight / weight.sum(), both))
        logits.append(pooled @ p["out"] + p["constant"][0])
    return 1 / (1 + np.exp(-max(logits)))


def test_scores_equal_plain_loops(spark):
    """The batched, masked scorer in single precision against every window of every text by itself."""
    texts, labels = corpus(200, 4)
    net = tx.train([t.encode() for t in texts], labels, epochs=2)
    rng = random.Random(5)
    more = [b"", b"  \n", b"one", "é ü x".encode(), b"idiot", b"w " * 31, b"w " * 32, b"w " * 33, b"a b " * 400]
    more += [t.encode() for t in corpus(60, 6)[0]] + [" ".join(rng.choice(texts).split()[0] for _ in range(200)).encode()]
    want = np.array([plain_score(net, t) for t in more])
    scorer = tx.Scorer(net)
    assert np.abs(scorer.score(more) - want).max() < 1e-4
    assert np.abs(np.array([tx.Scorer(net).score([t])[0] for t in more]) - want).max() < 1e-4  # alone as in a batch
    # the query itself: the network that ``scores`` trains, applied to whole texts
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, "x " * 3000), (None, "idiot")],
                                 "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    sample = tx.training_sample(docs, marks)
    own = tx.train(*sample, 2)
    got = tx.scores(docs, marks, epochs=2).collect()
    by_id = {i: t.encode() for i, t in enumerate(texts)} | {900: b"", 901: b"x " * 3000, None: b"idiot"}
    assert len(got) == len(by_id)
    for r in got:
        assert abs(r.score - plain_score(own, by_id[r.doc_id])) < 1e-4 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
