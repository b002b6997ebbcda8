from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from riskspark.llm import spelling


def edits(a, b):
    """Edit distance by the full matrix."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j - 1] + (x != y), old[j] + 1, row[-1] + 1))
    return row[-1]


def brute_words(rows):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute(words):
    near = {w: [x for x in words if abs(len(w) - len(x)) < 2 and edits(w, x) == 1] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def vocabulary(rng, n):
    out = set()
    while len(out) < n:
        word = "".join(rng.choice("abcé") for _ in range(rng.randrange(7, 11)))
        if rng.random() < 0.5:
            word = "abca" + word[:rng.randrange(4, 8)]
        out |= {word, word[:3] + word[4:] + "ab", word[1:] + "é"}
    return sorted(w for w in out if len(w) >= 7)


@pytest.mark.parametrize("seed", range(5))
def test_scan_equals_matrix(seed):
    words = vocabulary(random.Random(seed), 150)
    found = spelling.PrefixList(words)
    for word in words[::3] + ["abcabca", "zzzzzzz", "abc"]:
        got = [found.words[p] for p in found.near(word, 0, 0)]
        assert got == [w for w in words if edits(word, w) == 1]
        prefixes = spelling.PrefixList([w[:4] for w in words])
        able = {prefixes.words[p] for p in prefixes.near(word, 0, 0, prefixes=True)}
        assert able == {w[:4] for w in words if min(edits(w[:4], word[:k]) for k in range(len(word) + 1)) <= 1}


@pytest.mark.parametrize("bits", [2, 4, 12])
def test_near_words_over_blocks(spark, bits):
    words = vocabulary(random.Random(bits), 400)
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long").repartition(4)
    got = sorted(map(tuple, spelling.near_words(df, block_bits=bits).collect()))
    count = {w: i + 2 for i, w in enumerate(words)}
    assert got == sorted((a, b, count[b]) for a in words for b in words if edits(a, b) == 1)


def corpus(rng):
    common = ["internet", "Université", "rechnungen", "recherche", "búsqueda", "abcdefghij", "aaaaaaaa", "straßen×÷"]
    rows = [(None, None), (1, ""), (2, "short words only"), (3, "Internet INTERNET internet's internét"), (None, "internet " * 40)]
    for doc in range(4, 220):
        words = []
        for _ in range(rng.randrange(1, 120)):
            word = rng.choice(common[:rng.choice([2, 4, 8])])
            if rng.random() < 0.1:
                k = rng.randrange(len(word))
                word = word[:k] + rng.choice(["", "x", word[k] * 2, "É"]) + word[k + 1:]
            words.append(word)
        rows.append((doc, rng.choice([" ", "\n", "1", "_"]).join(words)))
    return rows + rows[10:30] + [rows[40]] * 50


def test_query_equals_brute_force(spark):
    rows = corpus(random.Random(13))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    for bits in (3, 12):
        got = sorted(map(tuple, spelling.spelling_variants(df, block_bits=bits).collect()))
        assert got == brute(brute_words(rows))
    assert any(r[2] != r[1] and r[1] for r in got), "no chain of forms in the fixture"


def test_empty(spark):
    df = spark.createDataFrame([(1, None), (None, " a b ")], "doc_id long, text string")
    assert spelling.spelling_variants(df).count() == 0 and spelling.spelling_variants(df.limit(0)).count() == 0


def test_chain_of_forms(spark):
    words = [("abcdefgh", 2), ("abcdefg", 20), ("abcdefx", 200), ("abcdexx", 2000), ("abcdxxx", 20_000), ("zzzzzzz", 5)]
    df = spark.createDataFrame(words, "word string, n long")
    got = {r["word"]: r["root"] for r in spelling.grouped(df, spelling.near_words(df)).collect()}
    assert got == {w: "abcdxxx" if w[0] == "a" else w for w, _ in words}
