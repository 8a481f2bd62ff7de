import random

import numpy as np
import pytest
import xxhash

from panelcast.llm import components as C
from panelcast.llm import simhash_dedup as S
from panelcast.llm.common import LOWER_AZ
from tests.llm import fixtures as X


def print_of(text, size=3):
    words = (text or "").encode().translate(LOWER_AZ).split()
    runs = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(prints, radius):
    """Smallest member's index per component, by brute force."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7])
def test_bit_sliced_distances(radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(60)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for p in prints for _ in range(3)]
    near = S.links_within(np.array(prints, dtype="<u8"), radius)
    rows = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little", count=len(prints))
    assert rows.tolist() == [[int((a ^ b).bit_count() <= radius) for b in prints] for a in prints]


def test_documents(spark):
    docs = X.with_extra(X.documents(spark), "fp", "node", "component_id", "t", "key")
    got = {(r.doc_id, r.fp & (1 << 64) - 1): r.component_id for r in S.near_duplicates(docs).collect()}
    rows = [r for r in X.rows() if r[0] is not None]
    prints = [print_of(r[1]) for r in rows]
    names = [min(rows[j][0] for j, x in enumerate(closed(prints, 2)) if x == c) for c in closed(prints, 2)]
    for (doc_id, *_), p, name in zip(rows, prints, names):
        assert got[doc_id, p] == name
    assert got[None, print_of(X.rows()[0][1])] == 0
    assert S.near_duplicates(docs).count() == len(X.rows())


@pytest.mark.parametrize("block", [16, 4096])
def test_links_of_clusters_and_hot_keys(spark, monkeypatch, block):
    """Chains of near fingerprints, one key with more members than a block holds."""
    monkeypatch.setattr(S, "BLOCK", block)
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(40)}
    hub = rng.getrandbits(64)
    prints |= {hub ^ (1 << a) ^ (1 << b) for a in range(10) for b in range(10)}
    p = hub
    for _ in range(30):
        p ^= sum(1 << b for b in rng.sample(range(64), 2))
        prints.add(p)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(k, x - (1 << 64) if x >> 63 else x) for k, x in enumerate(prints)], "node long, fp long")
    roots = {r.node: r.root for r in C.components(S.candidate_links(nodes, radius=2)).collect()}
    assert [roots.get(k, k) for k in range(len(prints))] == closed(prints, 2)


def test_components_of_chain_star_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{k: 100 for k in range(101, 180)}, 201: 200}


def test_keep_one_and_empty(spark):
    kept = [r.doc_id for r in S.keep_one(X.with_extra(X.documents(spark), "count", "component_id")).collect()]
    first = {r.component_id for r in S.near_duplicates(X.documents(spark)).collect()}
    assert sorted(k for k in kept if k is not None) == sorted(first) and kept.count(None) == 1
    assert S.near_duplicates(X.empty(spark)).count() == 0 and S.keep_one(X.empty(spark)).count() == 0


def test_one_id_with_several_texts_and_rows_without_id(spark, monkeypatch):
    """Ids name rows, fingerprints name nodes: (1, 0) and (2, 1) are linked although id 1 has another text too; a
    fingerprint that only a row without id has bridges two others."""
    rows = [(1, 11, 0), (1, 12, -1), (2, 13, 1), (3, 14, -2), (None, 15, 0b111 << 20), (8, 16, 0b1 << 20), (9, 17, 0b11111 << 20)]
    monkeypatch.setattr(S, "fingerprints", lambda docs, shingle: spark.createDataFrame(rows, "doc_id long, text_hash long, fp long"))
    got = {(r.doc_id, r.fp): r.component_id for r in S.near_duplicates(None).collect()}
    # 0 - 1, -1 - -2, and 0b1 << 20 within one bit of 0, two bits of 0b111 << 20, which is two bits from 0b11111 << 20
    assert got == {(1, 0): 1, (2, 1): 1, (8, 1 << 20): 1, (None, 7 << 20): 1, (9, 31 << 20): 1, (1, -1): 1, (3, -2): 1}


def test_two_texts_of_one_id_both_stay(spark):
    a, b = (X.prose(random.Random(k), 60) for k in (1, 2))
    rows = [(1, a), (1, b), (2, a), (3, b + " more"), (1, a), (None, a)]
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept if r.doc_id is not None and r.doc_id != 3)) == sorted([(1, a), (1, b)])
    assert [r.text for r in kept if r.doc_id is None] == [a]
