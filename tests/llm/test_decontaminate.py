import random
from collections import Counter

from panelcast.llm import decontaminate as D
from tests.llm import fixtures as X


def case(spark):
    rng = random.Random(3)
    items = [(k, X.prose(rng, n)) for k, n in enumerate([15, 22, 31, 40, 59])]
    items += [(90, items[0][1]), (91, "too short"), (92, None), (93, ""), (None, X.prose(rng, 25))]
    docs = X.rows()

    def changed(text, at):
        ws = text.split()
        for a in at:
            ws[a] = "other"
        return " ".join(ws)

    texts = [X.prose(rng, 30) + " " + items[2][1] + "\n" + X.prose(rng, 30), items[0][1],
             "| " + " | ".join(items[1][1].split()) + " |", items[3][1].upper(), changed(items[4][1], [0]), changed(items[4][1], [58]),
             changed(items[4][1], [10, 30]), changed(items[3][1], [3, 13, 23, 33]), items[2][1] + " " + items[3][1], items[9][1]]
    docs += [(1000 + k, t, "en", "src1", len(t)) for k, t in enumerate(texts)]
    return (spark.createDataFrame(docs, X.SCHEMA), spark.createDataFrame(items, "item_id long, text string"), docs, items)


def brute(docs, items):
    found = set()
    for doc_id, text, *_ in docs:
        ws = D.words(text)
        for item_id, item in items:
            iw = D.words(item)
            if len(iw) < 5 or len(ws) < 5:
                continue
            n = min(len(iw), len(ws))
            grams = lambda w: Counter(b" ".join(w[i:i + 5]) for i in range(len(w) - 4))
            want = grams(iw)
            if not set(want) & set(grams(ws)):
                continue
            if any(D.similarity(grams(ws[i:i + n]), want) >= 0.8 for i in range(len(ws) - n + 1)):
                found.add((doc_id, item_id))
    return found


def test_against_brute_force(spark):
    df, bench, docs, items = case(spark)
    got = D.contaminations(X.with_extra(df, "item_id", "similarity"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    assert all(r.similarity >= 0.8 and r.distance <= D.RADIUS for r in got)


def test_blocks_of_items_give_the_same(spark):
    df, bench, *_ = case(spark)
    parts = list(D.blocks_of(bench, 300))
    assert len(parts) > 2 and sum(map(len, parts)) == 9
    every = {(r.doc_id, r.item_id) for r in D.contaminations(df, bench).collect()}
    rows = X.as_set(df, "doc_id", "text")
    assert {(d, m[0]) for p in parts for b in [D.Benchmark(p)] for d, t in rows for m in b.matches(t)} == every


def test_clean_keeps_the_rest(spark):
    df, bench, docs, items = case(spark)
    bad = {d for d, _ in brute(docs, items)}
    kept = X.with_extra(df, "mask").transform(lambda x: D.clean(x, bench))
    assert kept.columns == [*df.columns, "mask"]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(d[0]) for d in docs if d[0] not in bad)


def test_empty_tables(spark):
    df, bench, *_ = case(spark)
    assert D.contaminations(X.empty(spark), bench).count() == 0
    assert D.contaminations(df, bench.limit(0)).count() == 0
    assert D.clean(df, bench.limit(0)).count() == df.count()


def test_index_misses_nothing_within_the_radius():
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(200)]
    index = D.HammingIndex(prints, 12)
    for _ in range(200):
        p = rng.choice(prints) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 14)))
        assert index.within(p) == [(k, (q ^ p).bit_count()) for k, q in enumerate(prints) if (q ^ p).bit_count() <= 12]
