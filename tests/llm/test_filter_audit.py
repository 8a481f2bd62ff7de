"""The filter audit against applying the filters order by order."""

import re
from collections import Counter
from itertools import permutations

from panelcast.llm import filter_audit as A
from tests.llm import fixtures as X

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Applies each order to each document, one by one."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    docs = [(d, t or "", s or "") for d, t, _, s, _ in rows]
    fails = []
    for d, t, _ in docs:
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        f |= {"A"} if len(ws) < 50 else set()
        f |= {"B"} if 100 * len(set(ws)) < 65 * len(ws) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        f |= {"E"} if d is not None and any(e is not None and e < d and u == t for e, u, _ in docs) else set()
        fails.append(f)
    out = {}
    for part in {s for _, _, s in docs}:
        mine = [(d, f) for (d, _, s), f in zip(docs, fails) if s == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in left if letter in f]
                redundant = sum(letter in f for _, f in mine) - len(gone)
                left = [(d, f) for d, f in left if letter not in f]
                shapley[letter] += len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(f == {letter} for _, f in mine),
                                          sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def got(spark, docs, labels):
    return {(r[0], r[1], r[2]): list(r[3:]) for r in A.audit(docs, spark.createDataFrame(labels, LABELS)).collect()}


def test_intervals_are_the_removal_steps_of_all_masks():
    found = {}
    for mask, step, a, b in A.intervals():
        for rank in range(a, b):
            assert (mask, rank) not in found
            found[mask, rank] = step
    for rank, order in enumerate(A.orders()):
        assert A.lehmer_start(order) == rank
        for mask in range(1, 32):
            want = min(order.index(f) + 1 for k, f in enumerate("ABCDE") if mask >> k & 1)
            assert found[mask, rank] == want


def test_same_as_brute_force(spark):
    rows = [(d, t, g, None if k % 9 == 0 else "" if k % 9 == 1 else f"src{k % 3}", n) for k, (d, t, g, _, n) in enumerate(X.rows())]
    rows += [rows[5], (900, rows[6][1], "en", "src1", 1), (901, None, "en", None, None), (902, "", "en", "src0", 0)]
    labels = [(k, int(k % 2), int(k % 5 == 0)) for k in range(0, 70, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (7, None, None)]
    docs = X.with_extra(spark.createDataFrame(rows, X.SCHEMA), "mask", "part", "n", "rank", "digest")
    want = brute(rows, labels)
    assert len(want) % 600 == 0 and got(spark, docs, labels) == want


def test_empty_tables(spark):
    assert got(spark, X.empty(spark), []) == {}
    out = A.audit(X.documents(spark), spark.createDataFrame([], LABELS))
    assert {tuple(r) for r in out.select("good_lost", "toxic_lost").distinct().collect()} == {(0, 0)}
