import random

import numpy as np
import pytest

from panelcast.llm import substring_dedup as S
from tests.llm import fixtures as X


def brute(rows, window=20):
    """(doc_id, words, removed, kept) in the order of (id, row)."""
    seen, out = set(), []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ws = (text or "").encode().split()
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(ws), sum(gone), b" ".join(w for w, g in zip(ws, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("chunk", [200, 1_500_000])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK_WORDS", chunk)
    docs = X.with_extra(X.documents(spark), "chunk", "bucket", "hashes", "kind").coalesce(1)
    got = S.deduplicate(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == sorted(brute(X.rows()), key=str)
    for r in got:
        assert sum(x["end"] - x["start"] for x in r.removed) == r.n_removed


def test_few_words_overlapping_windows(spark, monkeypatch):
    """Periodic texts of few words: windows overlap themselves and each other."""
    monkeypatch.setattr(S, "CHUNK_WORDS", 300)
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 90))), "en", "s", 0) for k in range(60)]
    rows += [(100 + k, ("a b c " * 40)[:rng.randint(0, 200)], "en", "s", 0) for k in range(20)]
    df = spark.createDataFrame(rows, X.SCHEMA).coalesce(1)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.deduplicate(df).collect()) == sorted(brute(rows))


def test_empty_table(spark):
    assert S.deduplicate(X.empty(spark)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 20, 31])
def test_rolled_hash_depends_on_the_run_only(size):
    rng = np.random.default_rng(size)
    words = rng.integers(0, 2**63, 50).astype(np.uint64)
    words[30:50] = words[5:25]
    got = S.rolled(words, size)
    assert len(got) == 51 - size
    runs = {}
    for i, h in enumerate(got.tolist()):
        runs.setdefault(tuple(words[i:i + size].tolist()), set()).add(h)
    assert all(len(h) == 1 for h in runs.values()) and len(set.union(*runs.values())) == len(runs)
    assert len(S.rolled(words[:size - 1], size)) == 0
