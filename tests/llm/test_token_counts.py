from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskspark.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", " ", "  ", "a", "It's we're I'll 're ''re !'s x'", "a  b   c\n\n d \t", "été naïve 東京  x　y",
          "12 345,678", "x<|endoftext|>y", "<|endoftext|><|endoftext|>", "!<|endo", "  <|endoftext|>  a",
          "\x1c\x1f\x85 a​b", "aaaa" * 400, " " * 700, "🙂👍🏽 ok", "  ᠎ q"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    alphabet = "abcdeé ñß'’  \n\t12.,!?<|>東🙂ſ "
    return TRICKY + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(300)] + \
        ["".join(rng.choice(["the ", "er", "on", " tion", "'s", "ing", "\n", "Zürich", " 7"]) for _ in range(rng.randrange(1, 900)))
         for _ in range(20)]


def test_tokens_match_the_library(library):
    bpe = tc.PrefixBpe(PATH)
    for text in texts():
        ids = library.encode(text, add_special_tokens=False)
        n, cut = bpe.measure(text, 5)
        assert n == len(ids.ids), text
        body = text.encode()
        if n <= 5:
            assert cut == len(body)


def test_cut_covers_the_first_tokens(library):
    bpe = tc.PrefixBpe(PATH)
    for text in ["The quick brown fox's thereof", "ab<|endoftext|>cd efg", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa bbb"]:
        ids = library.encode(text, add_special_tokens=False)
        for limit in range(1, len(ids.ids)):
            assert bpe.measure(text, limit)[1] == ids.offsets[limit - 1][1]


def test_every_prefix_is_counted(library):
    bpe = tc.PrefixBpe(PATH)
    for text in [t for t in texts() if len(t) < 120]:
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert bpe.prefix_counts(text).tolist() == want, text


def test_rows(spark, library):
    rows = [(1, "It's <|endoftext|> ok"), (1, "It's <|endoftext|> ok"), (None, None), (2, ""), (3, "word " * 6000)]
    docs = spark.createDataFrame([(i, t, 9, 9, i) for i, t in rows], "doc_id long, text string, n_tokens long, n_bytes long, counts long")
    got = sorted(tc.token_counts(docs, PATH).collect(), key=str)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted([tuple(r)[:3] for r in got], key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert tc.token_counts(docs.limit(0), PATH).count() == 0
    tables = tc.prefix_tables(docs.where("doc_id = 1"), PATH).collect()
    assert len(tables) == 2 and tables[0].counts[-1] == want[0][2]
