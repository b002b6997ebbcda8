from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from riskspark.llm import induced


def naive(text, cap):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while n < cap and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        lcp.append(n)
    return order, lcp


@pytest.mark.parametrize("memory", [64 << 20, 200])
def test_order_and_prefixes(memory, monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(induced, "BATCH", 7)
    for case in range(200):
        sigma = rng.choice([1, 2, 3, 20])
        body = [rng.randrange(1, sigma + 1) for _ in range(rng.randrange(0, 60))]
        if case % 3 == 0:
            body = body * rng.randrange(1, 5) + [1] * rng.randrange(0, 30)
        text = body + [0]
        order, lcp = naive(text, 1000)
        parts = induced.ordered(np.array(text, np.uint16), sigma + 1, 1000, memory)
        places = np.concatenate([p for p, _ in parts]).tolist()
        assert places == order, text
        assert np.concatenate([c for _, c in parts]).tolist() == lcp, text


def test_recursion(monkeypatch):
    monkeypatch.setattr(induced, "RECURSE_SYMBOLS", 6)
    rng = random.Random(2)
    for _ in range(20):
        text = [rng.randrange(1, 3) for _ in range(400)] * 2 + [0]
        order, lcp = naive(text, 1000)
        parts = induced.ordered(np.array(text, np.uint16), 3, 1000)
        assert np.concatenate([p for p, _ in parts]).tolist() == order
        assert np.concatenate([c for _, c in parts]).tolist() == lcp


def test_repeated_starts():
    rng = random.Random(3)
    for case in range(60):
        base = bytes(rng.randrange(0, 256) for _ in range(50))
        strings = []
        for _ in range(rng.randrange(1, 8)):
            a = rng.randrange(0, 30)
            strings.append(bytes(rng.choice([0, 97, 255]) for _ in range(rng.randrange(0, 12))) + base[a:a + rng.randrange(0, 30)])
        window = rng.choice([1, 3, 8])
        seen = {}
        for s in strings:
            for i in range(len(s) - window + 1):
                seen[s[i:i + window]] = seen.get(s[i:i + window], 0) + 1
        want = [[i for i in range(len(s) - window + 1) if seen[s[i:i + window]] > 1] for s in strings]
        assert [x.tolist() for x in induced.repeated_starts(strings, window, 300)] == want


def test_name_that_fills_its_key():
    """Seven symbols make a key: a name that ends with it is larger than the longer ones that begin like it."""
    rng = random.Random(4)
    for _ in range(50):
        text = [s for _ in range(12) for s in [2, 3, 4, 5, 6, 7, 2] + rng.choice([[], [9], [1], [1, 8], [1, 1, 5]])] + [0]
        order, lcp = naive(text, 1000)
        parts = induced.ordered(np.array(text, np.uint16), 258, 1000)
        assert np.concatenate([p for p, _ in parts]).tolist() == order
        assert np.concatenate([c for _, c in parts]).tolist() == lcp


def test_repeats_of_names_that_fill_their_key():
    rng = random.Random(5)
    for _ in range(30):
        make = lambda n: b"".join(b"bcdefgb" + rng.choice([b"", b"z", b"a", b"ax", b"aae"]) for _ in range(n))
        shared = make(6)
        strings = [make(8) + shared + make(8), make(8), make(8) + shared, make(12)]
        seen = Counter(s[i:i + 40] for s in strings for i in range(len(s) - 39))
        want = [[i for i in range(len(s) - 39) if seen[s[i:i + 40]] > 1] for s in strings]
        assert [x.tolist() for x in induced.repeated_starts(strings, 40)] == want
