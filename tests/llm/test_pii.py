import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import pii
from tests.llm import fixtures as X


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="01 29.+-@a_%()é", max_size=60))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_of_documents():
    for r in X.rows():
        if r[1] is not None and len(r[1]) < 20_000:
            assert pii.base_spans(r[1]) == brute(r[1])
    assert pii.base_spans(None) == [] and pii.base_spans("") == []


def personal(n):
    """Texts with planted data and what else has digits."""
    import random

    rng = random.Random(n)
    out = []
    for k in range(n):
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        out.append(" ".join([X.prose(rng, 6), rng.choice([
            f'token = "{secret}"', f"{rng.randint(1, 254)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(1, 254)},",
            f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}", f"x{k}@mail.example.com,", f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}",
            f"in {rng.randint(1800, 2025)}", "4539148803436467."]), X.prose(rng, 6)]))
    return out


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(personal(600))], X.SCHEMA)
    return pii.train(docs, shards=2)


def test_model_adds_secrets_and_leaves_other_numbers(model):
    hits = others = 0
    for text in personal(200):
        base, spans = pii.all_spans(text, model)
        assert [s for s in spans if s in base] == base
        added = [s for s in spans if s not in base]
        if "token" in text:
            want = re.search('"([0-9a-f]{40})"', text).span(1)
            hits += ("secret", *want) in added
            others += len(added) > 1
        else:
            others += len(added)
    assert hits == sum("token" in t for t in personal(200)) and others == 0


def test_two_cards_in_a_row_are_found_by_the_model(model):
    text = "pay 4539148803436467 4539148803436467 now"
    assert pii.base_spans(text) == []
    assert [s for s in pii.all_spans(text, model)[1]] == [("card", 4, 20), ("card", 21, 37)]


def test_decoding_is_the_best_segmentation():
    """Dynamic programming against all segmentations of short regions."""
    import numpy as np

    rng = np.random.default_rng(0)
    model = pii.Model(rng.normal(size=(pii.BUCKETS, len(pii.KINDS))), rng.normal(size=(len(pii.KINDS) + 1, len(pii.KINDS))))
    text = "see 12-3 (45) 6789 10 a1b2 now"
    region = pii.regions(text)[0]
    ends = pii.segments(text, region)

    def best(j, label):  # best score of words before j whose last label is `label`
        if j == 0:
            return 0.0 if label == 0 else -np.inf
        if label == 0:
            return max(best(j - 1, p) for p in range(len(pii.KINDS) + 1))
        return max([best(i, p) + model.moves[p, label - 1] + model.weights[f].sum(axis=0)[label - 1]
                    for i, _, f in ends[j] for p in range(len(pii.KINDS) + 1)], default=-np.inf)

    want = max(best(len(region), label) for label in range(len(pii.KINDS) + 1))
    got, at, prev = 0.0, 0, 0
    spans = model.decode(text, region)
    for kind, a, b in spans:
        j = next(j for j in range(len(region) + 1) for i, s, _ in ends[j] if s == (a, b))
        i, f = next((i, f) for i, s, f in ends[j] if s == (a, b))
        prev = 0 if i > at else prev
        k = pii.KINDS.index(kind)
        got += model.moves[prev, k] + model.weights[f].sum(axis=0)[k]
        at, prev = j, k + 1
    assert abs(got - want) < 1e-9


def test_gradient_raises_the_likelihood_of_gold():
    import numpy as np

    text = "from 10.0.0.25 to 7 we"
    region = pii.regions(text)[0]
    model, seen = pii.Model(), np.zeros((pii.BUCKETS, len(pii.KINDS)))
    gold = pii.gold_of(text, region)
    assert gold == {(0, 1): pii.KINDS.index("ip")}
    for _ in range(30):
        model.gradient_step(pii.segments(text, region), gold, 0.3, seen)
    assert model.decode(text, region) == [("ip", 5, 14)]


def test_find_and_redact(spark, model):
    docs = X.with_extra(X.documents(spark), "spans", "base", "kind")
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert len(found) == len({r[0] for r in X.rows()})
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert len(rows) == len(X.rows())
    for r in rows:
        assert (r.text is None) == (r.n_chars is None) and (r.text is None or len(r.text) == r.n_chars)
        if r.text is not None and len(r.text) < 20_000:
            assert not [s for s in pii.base_spans(r.text)]
    assert pii.find(X.empty(spark), model).count() == 0 and pii.redact(X.empty(spark), model).count() == 0


def test_without_training_rows(spark):
    m = pii.train(X.empty(spark))
    assert not m.weights.any() and pii.all_spans("token = 908038b7daaf91e730d2f908038b7d", m) == ([], [])


def test_glued_long_and_letters_only_secrets(spark):
    import random

    rng = random.Random(9)
    mixed, letters = "abcdefghkmpqrstuvwxyz23456789", "abcdefghkmpqrstuvwxyzABCDEFGH"

    def some(n, least=24, most=40):
        for k in range(n):
            secret = "".join(rng.choice(letters if k % 2 else mixed) for _ in range(rng.randint(least, most)))
            yield secret, X.prose(rng, 6) + " " + rng.choice([f"password={secret}", f'token="{secret}"', f'{{"key":"{secret}"}}',
                                                              f"secret = {secret}"]) + " " + X.prose(rng, 6)

    texts = [t for _, t in some(300)] + [t for _, t in some(60, 300, 600)] + personal(600)
    model = pii.train(spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], X.SCHEMA), shards=2)
    for secret, text in [*some(80), *some(20, 300, 2000)]:
        at = text.index(secret)
        assert pii.all_spans(text, model) == ([], [("secret", at, at + len(secret))]), text


def test_candidates_and_regions_are_linear():
    for text in ("x" * 200_000, "a1" * 100_000, "a:1=" * 30_000, "key=" * 30_000, "=" * 100_000 + "1"):
        for region in pii.regions(text):
            assert sum(map(len, pii.candidates(text, region))) <= 4 * pii.MAX_WORDS * len(region)
    assert [text[a:b] for text in ['say key="abcdef" now'] for a, b in pii.regions(text)[0]] == ['key="', 'abcdef"']


def test_many_base_spans_are_linear():
    """Base and model spans side by side: twice the text takes about twice the time, not four times."""
    import time

    text = "mail jo.doe@mail.example.com key = 908038b7daaf91e730d2f908038b7daaf91e730d next "

    class Proposes(pii.Model):
        def decode(self, text, region):
            return [("secret", region[0][0], region[-1][1])]

    took = []
    for n in (6_000, 12_000):
        t = time.perf_counter()
        base, spans = pii.all_spans(text * n, Proposes())
        took.append(time.perf_counter() - t)
        assert len(base) == n and len(spans) >= n
    assert took[1] < 3 * took[0]
