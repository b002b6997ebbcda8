from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from riskspark.llm import sentencepiece as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
TRICKY = ["", " ", "  ", "a", " a", "a ", "a   b", "   ", "\n", "a\n b\n\nc", "Zürich été 東京 🙂 \x00\x01", "<s> </s> <unk> <0x41>",
          "x" * 300, "\t\t", "ha" * 200, "­ſ", "             indented"]


def texts():
    rng = random.Random(5)
    return TRICKY + ["".join(rng.choice("abcdeé ñ  \n12.東🙂the") for _ in range(rng.randrange(1, 60))) for _ in range(300)] + \
        ["".join(rng.choice(["the ", "er", "on", " tion", "ing", "\n", "Zürich", " 7", "ab"]) for _ in range(rng.randrange(1, 600)))
         for _ in range(20)]


def test_bpe_model_matches_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), sp.Pieces(PATH)
    for text in texts():
        want = library.encode(text)
        assert own.encode(text).tolist() == want, text
        assert own.decode(want) == library.decode(want) == text


def test_unigram_viterbi_matches_the_library(tmp_path):
    model = proto.ModelProto.FromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = sp.UNIGRAM
    rng = random.Random(1)
    for piece in model.pieces:
        if piece.type == sp.NORMAL:
            piece.score = -rng.randrange(1, 1 << 12) / 64  # sums stay exact
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=str(path)), sp.Pieces(str(path))
    for text in texts():
        got, want = own.encode(text).tolist(), library.encode(text)
        total = lambda ids: sum(own.score[i] for i in ids)
        assert total(got) == total(want) and own.decode(got) == text, text
        if got != want:  # paths of equal score
            assert len(got) > 1


def test_rows(spark):
    rows = [(1, "Hello  world\n"), (1, "Hello  world\n"), (None, None), (2, ""), (3, "word " * 6000), (4, "a▁b")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, token_ids int")
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    coded = sp.encode(docs, PATH)
    got = sorted(((r.doc_id, r.token_ids, r.n_tokens, r.round_trip) for r in coded.collect()), key=str)
    want = [(i, library.encode(t or ""), len(library.encode(t or "")), "▁" not in (t or "")) for i, t in rows]
    assert got == sorted(want, key=str)
    back = sorted((tuple(r) for r in sp.decode(coded, PATH).collect()), key=str)
    assert back == sorted([(i, (t or "").replace("▁", " ")) for i, t in rows], key=str)
    assert sp.encode(docs.limit(0), PATH).count() == 0
