"""The Jaccard join against comparing all pairs of texts."""

import random
import re

import numpy as np
import pytest

from panelcast.llm import jaccard_join as J
from tests.llm import fixtures as X


def shingles_of(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if len(words) > size else frozenset([tuple(words)])


def brute(rows, size=4, percent=85):
    sets = [shingles_of(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(least.get(find(k), d), d)
    return sorted(((d, len(s), least.get(find(k)) if s else d) for k, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = J.jaccard_components(X.with_extra(docs, "node", "key", "root", "comp", "hub"), **how)
    return X.as_set(out, "doc_id", "n_shingles", "component_id")


def varied(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.6:
            out[k] = f"w{rng.randrange(10 ** 6)}"
        elif kind < 0.8:
            out.insert(k, f"w{rng.randrange(10 ** 6)}")
        elif len(out) > 2:
            out.pop(k)
    return out


def near_rows(seed, families=25, most=12, lengths=(5, 400)):
    """Families of texts around the limit, chained variants, a passage that many share."""
    rng = random.Random(seed)
    rows = []
    passage = [f"p{k}" for k in range(60)]
    for f in range(families):
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(*lengths))]
        if f % 3 == 0:
            base = base[:len(base) // 2] + passage + base[len(base) // 2:]
        for _ in range(rng.randint(1, most)):
            rows.append(" ".join(varied(rng, base, rng.randint(0, max(1, len(base) // 45)))))
            if rng.random() < 0.3:
                base = rows[-1].split()
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    rows = near_rows(seed)
    want = brute(rows)
    assert 10 < len({c for _, _, c in want}) < len(rows) - 20
    assert got(spark, rows) == want


def test_short_texts_and_other_limits(spark):
    rows = near_rows(5, families=40, most=8, lengths=(1, 30))
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, shingle=1, percent=60) == brute(rows, 1, 60)
    assert got(spark, rows, shingle=2, percent=100) == brute(rows, 2, 100)


def test_awkward_rows(spark):
    rows = [(d, t) for d, t, *_ in X.rows()]
    rows += [(None, X.rows()[2][1] + " more"), (None, "alone here without any id at all"), (None, None), (3, rows[12][1]), rows[4], (800, "ONE"), (801, " one ")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_large_groups_are_tiled(spark, monkeypatch):
    """Strays around one large component, and many components under one key, in tiles of 16."""
    monkeypatch.setattr(J, "TILE_BYTES", 1)  # no family fits: stars and cut keys
    rng = random.Random(9)
    base = [f"b{k}" for k in range(120)]
    texts = [" ".join(varied(rng, base, 1)) for _ in range(70)] + [" ".join(varied(rng, base, e)) for e in (3, 4, 4, 5, 5, 6, 7, 8, 9) for _ in range(9)]
    rows = list(enumerate(texts))
    assert got(spark, rows) == brute(rows)


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(1)
    for n in [6, 7, 8, 9, 12, 20, 40, 100, 400, 1500]:
        for _ in range(60):
            a = np.unique(rng.integers(0, 2 ** 63, n).astype("<u8") * np.uint64(2))
            take, add = int(rng.integers(0, n // 6 + 1)), int(rng.integers(0, n // 6 + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[take:], rng.integers(0, 2 ** 63, add).astype("<u8")]))
            if len(b) and J.linked(a, b, 85) and len(np.setxor1d(a, b)):
                assert len(np.intersect1d(J.keys_of(a, 85), J.keys_of(b, 85)))


def test_bit_counts_bound_the_intersection_from_above():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2 ** 63, 200).astype("<u8")
    sets = [np.unique(rng.choice(pool, int(rng.integers(60, 400)))) for _ in range(50)]
    bits = J.width_for(max(map(len, sets)))
    maps, sizes = np.array([J.bitmap(s, bits) for s in sets]), np.array([len(s) for s in sets])
    opened = {(i, int(j)) for i, js in J.open_pairs(maps, sizes, len(sets), 50) for j in js}
    linked = {(i, j) for i in range(50) for j in range(i + 1, 50) if J.linked(sets[i], sets[j], 50)}
    assert linked and linked <= opened and len(opened) < 50 * 49 / 2
