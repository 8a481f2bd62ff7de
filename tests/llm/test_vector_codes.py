"""Vector codes against plain exact k-means."""

import hashlib
import math
import random

import numpy as np
import pytest

from panelcast.llm import vector_codes as V
from tests.llm import fixtures as X

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, scale=256, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, digest) of every kept row, by comparing all with all."""
    kept = [(i, [math.floor(scale * x) for x in v], c) for i, v, c in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = {}
            for c in cut:
                mine.setdefault(nearest(c[p], book)[1], []).append(c[p])
            for k, points in mine.items():
                book[k] = tuple(sum(col) // len(points) for col in zip(*points))
    best = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in b) for b in best]
    per = {}
    for (_, _, c), e in zip(kept, errors):
        per[c] = per.get(c, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in b), e, per[c], digest) for (i, _, c), b, e in zip(kept, best, errors)), key=str)


def got(spark, rows, schema=SCHEMA, **how):
    out = V.encode(X.with_extra(spark.createDataFrame(rows, schema), "part", "error", "code", "dim"), **how)
    return X.as_set(out, "vec_id", "code", "error", "label_error", "codebooks_sha256")


def vectors(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(7)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([1, 2, 2, None])) for i in range(n)]


def single(rows):
    """Components as 32-bit floats, as the table holds them."""
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]


def test_same_as_brute_force_with_awkward_rows(spark):
    rows = vectors(700, 32, 1)
    rows += [(1000, None, 1), (1001, [], 1), (1002, [1.0] * 31 + [None], 1), (1003, [float("nan")] + [0.0] * 31, 1),
             (1004, [float("inf")] * 32, None), (None, [0.25] * 32, 2), (3, [0.5] * 32, 1), rows[5], rows[5],
             *[(2000 + k, [-0.001] * 32, 9) for k in range(90)],  # equal vectors, floors below zero
             *[(-5 - k, rows[9][1], 4) for k in range(6)]]  # equal entries in the first codebook
    rows = single(rows)
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("n,dim,how", [(40, 16, {}), (300, 8, {"parts": 2, "entries": 5, "rounds": 3, "scale": 3}),
                                       (200, 12, {"parts": 1, "entries": 256, "rounds": 1})])
def test_other_shapes(spark, n, dim, how):
    rows = single(vectors(n, dim, n, 0.3))
    assert got(spark, rows, **how) == brute(rows, **how)


def test_ties_go_to_the_lower_index():
    points = np.array([[0, 0], [2, 0], [1, 0], [1, 5], [-1, 0]] * 40)
    book = np.array([[2, 0], [0, 0], [0, 0], [2, 0]])
    codes, _ = V.descend(V.Tree(points).packed(), points, book, codes=True)
    want = [min((((p - b) ** 2).sum(), k) for k, b in enumerate(book))[1] for p in points]
    assert codes.tolist() == want


def test_balls_hold_their_points_and_sums():
    points = np.random.default_rng(3).integers(-300, 300, (2000, 4))
    tree = V.Tree(points)
    packed = tree.packed()
    order, span = np.frombuffer(packed["order"], "<i4"), np.frombuffer(packed["span"], "<i4").reshape(-1, 2)
    assert sorted(order) == list(range(2000))
    for k, (a, b) in enumerate(span):
        mine = points[order[a:b]]
        assert (mine.sum(axis=0) == tree.total[k]).all()
        assert np.sqrt(((mine - tree.pivot[k]) ** 2).sum(axis=1)).max() <= tree.radius[k] + 1e-9


def test_whole_balls_are_owned_without_looking_at_their_points():
    rng = np.random.default_rng(4)
    centres = rng.integers(-5000, 5000, (20, 4))
    points = centres[rng.integers(0, 20, 4000)] + rng.integers(-20, 21, (4000, 4))
    (count, total), compared = V.descend(V.Tree(points).packed(), points, centres)
    near = ((points[:, None] - centres) ** 2).sum(axis=-1).argmin(axis=1)
    assert compared < 4000 * 20 / 20
    assert count.tolist() == np.bincount(near, minlength=20).tolist()
    assert (total == np.array([points[near == k].sum(axis=0) for k in range(20)])).all()


def test_empty_table_and_unfit_vectors(spark):
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []
    for bad in ([(1, [0.0] * 16, 1), (2, [0.0] * 32, 1)], [(1, [0.0] * 17, 1)], [(1, [3e9] * 16, 1)]):
        with pytest.raises(Exception, match="vectors must be equally long|components so large"):
            got(spark, bad)
