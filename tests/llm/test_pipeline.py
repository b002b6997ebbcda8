"""Every stage of the pipeline against a brute-force version, each on its own input."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as cp
import test_mixing as mixing_brute
import test_quality_rules as rules_brute
import test_simhash as simhash_brute
import test_suffix as suffix_brute
from conftest import SF_SMALL
from riskspark.llm import quality_rules as qr

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = cp.documents(spark, SF_SMALL)
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(cp.materialize(stage(spark, out[-1], SF_SMALL), "test-pipeline"))
    return out


def rows(df):
    return sorted(df.collect(), key=lambda r: str(tuple(r)))


def test_names_and_columns(stages):
    assert len(cp.STAGES) == 5
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_quality_rules(stages):
    docs = rows(stages[0])
    verdicts = rules_brute.brute([(r.source, r.text) for r in docs])
    kept = {r.doc_id: r for r in rows(stages[1])}
    assert sorted(kept) == sorted(r.doc_id for r, v in zip(docs, verdicts) if v[6])
    for r, v in zip(docs, verdicts):
        if v[6] and not v[7]:
            assert kept[r.doc_id] == r
        elif v[6]:
            assert len(kept[r.doc_id].text.split()) == v[0] - v[7]


def test_near_duplicates(stages):
    docs = rows(stages[1])
    groups = simhash_brute.brute_groups([r.doc_id for r in docs], [simhash_brute.brute_print(r.text) for r in docs], 3)
    assert rows(stages[2]) == [r for r, g in zip(docs, groups) if r.doc_id == g]


def test_repeated_strings(stages):
    docs = rows(stages[2])
    want = suffix_brute.brute([r.text for r in docs], cp.REPEATED_BYTES)
    got = {r.doc_id: r for r in rows(stages[3])}
    for r, (n, removed, _, _) in zip(docs, want):
        if not removed:
            assert got[r.doc_id] == r
        elif r.doc_id in got:
            left = len(got[r.doc_id].text.encode())
            assert n - removed - 12 <= left <= n - removed and got[r.doc_id].n_chars == len(got[r.doc_id].text)
        else:
            assert n - removed < 12


def test_mixture(stages):
    docs = rows(stages[3])
    sizes = {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    taken = {}
    for r in rows(stages[4]):
        taken[r.source] = taken.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for source, target in mixing_brute.targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 0.5


def test_tokens(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((str(r.doc_id), library.encode(r.text)) for r in stages[4].collect())
    assert sorted((str(r.doc_id), r.token_ids) for r in stages[5].collect()) == want


def test_run(spark, stages):
    assert cp.run(spark, SF_SMALL).count() == stages[5].count()


def test_messy_documents(spark):
    """NULLs in any column, empty texts, repeated rows and an empty table pass all stages."""
    data = rules_brute.corpus() * 2
    docs = spark.createDataFrame([(i % 90 if i % 5 else None, t, None if i % 3 else "en", h, None if i % 4 else 1)
                                  for i, (h, t) in enumerate(data)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for start in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            start = cp.materialize(stage(spark, start, ""), "test-messy")
        start.count()
    assert qr.MIN_WORDS == 10
