"""Quality classifier, language identification and language model."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import hmm_lm as H
from panelcast.llm import language_id as L
from panelcast.llm import quality_classifier as C
from tests.llm import fixtures as X

LABELS = "doc_id long, quality int, toxic int"


def two_kinds(spark, n):
    rng = random.Random(n)
    rows, labels = [], []
    for k in range(n):
        text = X.prose(rng, rng.randint(20, 120))
        good = rng.random() < 0.7
        if not good:
            text = rng.choice([text.upper(), " ".join(w + "***" for w in text.split()), " ".join([text.split()[0]] * 50)])
        rows.append((k, text, "en", "s", len(text)))
        labels.append((k, int(good), 0))
    return spark.createDataFrame(rows, X.SCHEMA), spark.createDataFrame(labels, LABELS)


def test_classifier_held_out_accuracy(spark):
    docs, labels = two_kinds(spark, 900)
    weights = C.train(docs.where("doc_id % 3 <> 1"), labels, shards=2)
    got = C.score(docs, weights).join(labels, "doc_id").where("doc_id % 3 = 1").collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_classifier_awkward_rows(spark):
    docs, labels = two_kinds(spark, 60)
    weights = C.train(docs, labels.union(spark.createDataFrame([(None, 1, 0), (3, None, 0), (4, 0, 0), (4, 1, 0)], LABELS)), shards=2)
    got = C.score(X.with_extra(X.documents(spark), "score", "__id", "__text"), weights).collect()
    assert len(got) == len(X.rows()) and all(0 <= r.score <= 1 for r in got)
    none = C.train(X.empty(spark), labels)
    assert not none.any() and {r.score for r in C.score(X.documents(spark), none).collect()} == {0.5}
    assert C.score(X.empty(spark), weights).count() == 0


def test_ftrl_step_is_the_published_rule():
    m = C.Ftrl(3, alpha=0.1, beta=1.0, l1=0.0, l2=0.0)
    m.learn(np.array([0, 2]), np.array([1.0, 2.0]), 1)
    g = np.array([-0.5, -1.0])
    assert np.allclose(m.n[[0, 2]], g ** 2) and np.allclose(m.z[[0, 2]], g) and m.n[1] == 0
    assert np.allclose(m.weights(np.array([0, 2])), -g / ((1.0 + np.abs(g)) / 0.1))


def languages(spark, n):
    rng = random.Random(n)
    rows = []
    for k in range(n):
        lang = rng.choice(["en", "de"])
        text = X.prose(rng, rng.randint(8, 60), X.EN if lang == "en" else X.DE)
        rows.append((k, text, lang if k % 7 else None, "s", len(text)))
    return spark.createDataFrame(rows, X.SCHEMA)


def test_language_held_out_accuracy_and_backoff(spark):
    docs = languages(spark, 500)
    model = L.train(docs.where("doc_id % 4 <> 2"))
    got = L.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 4 = 2 and lang is not null").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    e = L.Evidence(model)
    assert e.predict(["straßen gärten häuser"])[0][0] == "de"  # unknown words, by their n-grams
    assert "straßen" not in model.known


def test_language_awkward_rows(spark):
    model = L.train(languages(spark, 60))
    got = L.predict(X.with_extra(X.documents(spark), "word", "n", "score"), model).collect()
    assert len(got) == len(X.rows())
    by = {r[1]: None for r in X.rows()}
    e = L.Evidence(model)
    for text, (lang, score) in zip(by, e.predict(list(by))):
        assert (lang == "und") == (text is None or not any(c.isalpha() for c in text)) and 0 <= score <= 1
    assert L.train(X.empty(spark)).langs == []
    assert {r.lang_pred for r in L.predict(X.documents(spark), L.train(X.empty(spark))).collect()} == {"und"}
    assert L.predict(X.empty(spark), model).count() == 0
    digits = L.train(spark.createDataFrame([(1, "12 34", "en", "s", 5)], X.SCHEMA))
    assert digits.langs == ["en"] and L.Evidence(digits).predict(["word"]) == [("en", 1.0)]


def test_language_bounds_hold_per_language(spark):
    """A small language keeps its rows, words and n-grams beside a large one; rows without an id are sampled by text."""
    rng = random.Random(8)
    rows = [(None, X.prose(rng, 12), "en", "s", 0) for _ in range(1500)] + [(None, X.prose(rng, 30, X.DE), "de", "s", 0) for _ in range(6)]
    docs = spark.createDataFrame(rows, X.SCHEMA)
    model = L.train(docs, max_rows=100)
    assert model.langs == ["de", "en"]
    assert np.allclose(np.exp(model.prior), [6 / 1506, 1500 / 1506])
    seen = L.SMOOTH / np.exp(model.base[0])  # words, and SMOOTH for each distinct one
    assert 6 * 30 < seen[0] and 12 * 50 < seen[1] < 12 * 300
    for lang, other in ((X.DE, X.EN), (X.EN, X.DE)):
        assert len(set(model.known) & set(lang) - set(other)) >= 5
    assert L.Evidence(model).predict(["straße abend nicht"])[0][0] == "de"


def plain_scores(train, texts, least):
    """Posterior of the best language by the module's rules, word by word, from plain counts."""
    langs = sorted({x for _, x in train})
    word, gram = {x: Counter() for x in langs}, {x: Counter() for x in langs}
    for text, x in train:
        word[x].update(L.words(text))
    for x in langs:
        for w, n in word[x].items():
            for at in range(0, len(w), L.LONGEST_WORD):
                for size in range(1, L.MAX_GRAM + 1):
                    for g in L.grams(w[at:at + L.LONGEST_WORD], size):
                        gram[x][g] += n
    known = {w for c in word.values() for w, n in c.items() if n >= least}
    spelled = {g for c in gram.values() for g, n in c.items() if n >= least}

    def log(c, size, entry):
        mine = [(e, n) for x in langs for e, n in c[x].items() if size == 0 or len(e) == size]
        out = []
        for x in langs:
            total = sum(n for e, n in c[x].items() if size == 0 or len(e) == size)
            out.append(math.log((c[x][entry] + L.SMOOTH) / (total + L.SMOOTH * len(mine))))
        return out

    found = []
    for text in texts:
        total = [math.log(sum(y == x for _, y in train) / len(train)) for x in langs]
        ws = L.words(text)
        for w in ws:
            rows = [log(word, 0, w)] if w in known else []
            for at in range(0, len(w), L.LONGEST_WORD) if not rows else ():
                marked = f"^{w[at:at + L.LONGEST_WORD]}$"
                for end in range(2, len(marked) + 1):
                    size = next((n for n in range(min(L.MAX_GRAM, end), 0, -1) if marked[end - n:end] in spelled), None)
                    rows += [log(gram, size, marked[end - size:end])] if size else []
            total = [t + sum(r[k] for r in rows) / max(1, len(rows)) for k, t in enumerate(total)]
        best = max(range(len(langs)), key=lambda k: (total[k], -k))
        found.append((langs[best], 1 / sum(math.exp(t - total[best]) for t in total)) if ws else ("und", 0.0))
    return found


def test_language_scores_are_those_of_a_plain_scorer(spark):
    docs = languages(spark, 40)
    train = [(r.text, r.lang) for r in docs.where("lang is not null").collect()]
    texts = ["the straße", "unbekanntes wort", "x" * 150 + " river", "日本 naïve", "12", None, "", *[t for t, _ in train[:6]]]
    got = L.Evidence(L.train(docs)).predict(texts)
    want = plain_scores(train, texts, 3)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-9)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("chunk", [100, 2_000_000])
def test_counts_and_base_scores(spark, monkeypatch, chunk):
    monkeypatch.setattr(H, "CHUNK_TOKENS", chunk)
    docs = X.with_extra(X.documents(spark), "chunk", "tokens", "training", "score")
    got = H.score(docs, F.coalesce(F.col("doc_id") % 5 != 1, F.lit(True)), states=3, rounds=2).collect()
    toks = [(r[0], lower(r[1]).encode().split() + [b""]) for r in X.rows()]
    c = Counter(w for d, ws in toks if d is None or d % 5 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((d, len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 5))
                   for d, ws in toks), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=str) == want
    assert all(np.isfinite(r.score) for r in got)


def test_forward_is_the_exact_likelihood_and_counts_are_posterior():
    """Against the sum over all state paths."""
    from itertools import product

    rng = np.random.default_rng(1)
    norm = lambda a: a / a.sum(axis=-1, keepdims=True)
    m = H.Hmm(norm(rng.random(2)), norm(rng.random((2, 2))), norm(rng.random((2, 4))))
    docs = [[0, 1, 3], [2, 2, 1, 0, 3], [3]]
    flat, lengths = np.concatenate(docs), np.array([len(d) for d in docs])
    order, classes, first = H.by_position(flat, lengths)
    like, start, moves, emit = [], np.zeros(2), np.zeros((2, 2)), np.zeros((2, 4))
    for d in docs:
        total, parts = 0.0, []
        for path in product(range(2), repeat=len(d)):
            p = m.start[path[0]] * m.emit[path[0], d[0]]
            for a, b, o in zip(path, path[1:], d[1:]):
                p *= m.moves[a, b] * m.emit[b, o]
            total += p
            parts.append((path, p))
        like.append(math.log(total))
        for path, p in parts:
            start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for s, o in zip(path, d):
                emit[s, o] += p / total
    assert np.allclose(H.forward(m, classes, first, False)[0], np.array(like)[order])
    counts, total = H.expected(m, classes, first)
    assert np.allclose(counts, np.concatenate((start, moves.ravel(), emit.ravel())), rtol=1e-4)
    assert abs(total - sum(like)) < 1e-6


def test_model_beats_the_base_on_held_out_text(spark):
    docs = languages(spark, 400)
    got = H.score(docs, F.col("doc_id") % 5 != 1, states=4, rounds=6).where("not training").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_language_model_empty_tables(spark):
    assert H.score(X.empty(spark), F.lit(True)).count() == 0
    got = H.score(X.documents(spark).limit(3), F.lit(False)).collect()
    assert {r.train_tokens for r in got} == {0} and all(abs(r.score - r.base_score) < 1e-6 * r.n_tokens for r in got)


def test_emissions_are_learned_per_token():
    """A state's emissions add up to one, and tokens differ however many there are."""
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 50, 5000).astype("<u8")
    shares = rng.dirichlet(np.ones(4), 5000)
    part = (counts[:, None] * shares).sum(axis=0) / counts.sum()
    model = H.Chain(np.full(4, 0.25), np.full((4, 4), 0.25), part).over(np.append(counts, 0), np.vstack((shares, np.zeros(4))))
    base = (np.append(counts, 0) + 0.5) / (counts.sum() + 0.5 * 5001)
    assert model.emit.shape == (4, 5001) and np.allclose(model.emit @ base, 1.0) and np.allclose(model.emit[:, -1], 1.0)
    assert len(np.unique(model.emit[0])) > 4500


def test_many_tokens_with_two_contexts(spark):
    """Two vocabularies of 3,000 words that never mix: states tell them apart, word by word."""
    rng = random.Random(4)
    rows = []
    for k in range(700):
        side = "ab"[k % 2]
        rows.append((k, " ".join(f"{side}{rng.randint(1, 3000)}" for _ in range(60)), "en", "s", 0))
    docs = spark.createDataFrame(rows, X.SCHEMA)
    got = H.score(docs, F.col("doc_id") % 5 != 1, states=2, rounds=8).where("not training").collect()
    gain = sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got)
    assert gain > 0.2  # log10 2 = 0.30 is what knowing the side is worth
