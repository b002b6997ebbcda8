from __future__ import annotations

import random

import xxhash

from riskspark.llm import simhash


def brute_print(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def corpus():
    rng = random.Random(4)
    texts = [None, "", "  ", "one", "One", "two words", "É é", "a b c", "A B C", "x " * 500]
    for _ in range(25):
        words = [rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(rng.randrange(30, 400))]
        for _ in range(rng.randrange(1, 5)):
            copy = list(words)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy))
    return texts + texts[12:20]


def brute_groups(ids, prints, bits):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    out = []
    for i in range(len(ids)):
        out.append(min((ids[j] for j in range(len(ids)) if root(j) == root(i) and ids[j] is not None), default=None))
    return out


def test_equals_brute_force(spark):
    texts = corpus()
    ids = [None if i % 9 == 4 else 1000 - i for i in range(len(texts))]
    docs = spark.createDataFrame([(d, t, i, "z", 5) for i, (d, t) in enumerate(zip(ids, texts))],
                                 "doc_id long, text string, i long, fp string, component long")
    prints = [brute_print(t) for t in texts]
    for bits in (3, 7):
        got = {r.row.i: (r.fp % (1 << 64), r.component_id) for r in
               simhash.near_duplicates(docs, ["i"], max_bits=bits).collect()}
        want = brute_groups(ids, prints, bits)
        assert got == {i: (prints[i], want[i]) for i in range(len(texts))}
        kept = simhash.first_of_groups(docs, max_bits=bits).collect()
        assert len(kept) == len({(w, simhash_root) for w, simhash_root in zip(want, brute_labels(prints, bits))})
        assert kept[0].asDict().keys() == {"doc_id", "text", "i", "fp", "component"}
        named = {r.doc_id for r in kept if r.doc_id is not None}
        assert named == {w for w in want if w is not None}


def brute_labels(prints, bits):
    return brute_groups(list(range(len(prints))), prints, bits)


def test_links_are_complete(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {b for x in base for b in [x] + [x ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))) for _ in range(6)]}
    signed = [((f + (1 << 63)) % (1 << 64)) - (1 << 63) for f in {f % (1 << 64) for f in fps} | {0, 1, (1 << 64) - 1}]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    want = {(min(a, b), max(a, b)) for a in signed for b in signed
            if a != b and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert got == want


def test_one_id_on_two_unlinked_texts(spark):
    """A repeated id does not join the groups of its texts."""
    rng = random.Random(6)
    one, two = (" ".join(f"{c}{rng.randrange(1000)}" for _ in range(200)) for c in "ab")
    assert (brute_print(one) ^ brute_print(two)).bit_count() > 3
    docs = spark.createDataFrame([(1, one), (1, two), (2, one), (3, two), (4, two)], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.first_of_groups(docs).collect()) == sorted([(1, one), (1, two)])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs, ["doc_id"]).count() == 0
    assert simhash.first_of_groups(docs).count() == 0
