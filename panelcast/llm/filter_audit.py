"""Filter interaction audit: what each filter removes in every order of the filters.

1. One pass over the texts gives each document its *mask*: the set of filters it
   fails (``TEXT_FILTERS`` on the text alone, the last filter by comparing texts
   across the table). Documents are counted per part and mask; all further work
   is on those counts, at most 32 rows a part.
2. The permutations of the filters, in lexicographic order, have Lehmer ranks
   0 to 119. A mask's documents leave at step ``s`` of exactly those orders whose
   first ``s - 1`` letters lie outside the mask and whose ``s``-th lies in it. Orders
   with a common prefix of ``s`` letters are one interval of (5 - s)! ranks, so
   every mask and step is a short list of rank intervals (``intervals``, at
   most 32 masks: a fixed table, whatever the data).
3. Each mask adds its counts at its intervals' starts and takes them off at their
   ends: a difference array per part and step, summed over the masks. A running
   sum along the ranks gives the removed documents of all 120 orders at once.
4. ``kept`` is a running sum along the steps. Whoever fails a filter has left by
   that filter's step, so ``redundant`` is its failures less what it removes itself.

Edge cases: a NULL text is the empty text; a NULL source is the empty string.
Equal texts are found by SHA-256 and the smallest ``doc_id``; a row without a
``doc_id`` neither repeats nor is repeated, and repeated rows of the smallest
``doc_id`` are no repeats of each other. A document labelled more than once counts
as good (toxic) if any of its labels says so, and once only. An empty table
gives no rows. Columns other than ``doc_id, text, source`` are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import map_slices

#: The filters' letters; the symbols of filter D.
FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
REPEAT = 1 << FILTERS.index("E")


def text_mask(text: str) -> int:
    """Bits of the filters that a text fails by itself (A to D)."""
    raw = text.encode()
    words = raw.split()
    fails = (len(words) < 50,
             100 * len(set(words)) < 65 * len(words),
             100 * (len(raw) - len(raw.translate(None, CAPITALS))) > 5 * len(text),
             len(raw) != len(raw.translate(None, SYMBOLS)))
    return sum(1 << k for k, f in enumerate(fails) if f)


def facts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic``: one row per document."""
    def make():
        def of_slice(cols):
            texts = [t or "" for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "part": cols["part"], "mask": [text_mask(t) for t in texts],
                    "digest": [hashlib.sha256(t.encode()).digest() for t in texts]}
        return of_slice

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    own = map_slices(read, make, "doc_id long, part string, mask int, digest binary")
    # The rows that come first for their text: as many as different texts, joined by id, so no text is a hot key.
    first = (own.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("is_first", F.lit(True)))
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    repeated = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    return (own.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
            .select("part", (F.col("mask") + F.when(repeated, REPEAT).otherwise(0)).alias("mask"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def orders() -> list[str]:
    """All orders of the filters; an order's place in the list is its Lehmer rank."""
    return ["".join(p) for p in permutations(FILTERS)]


def lehmer_start(prefix: str) -> int:
    """Rank of the first order that begins with ``prefix``: its Lehmer digits in the factorial base."""
    left, rank = list(FILTERS), 0
    for letter in prefix:
        digit = left.index(letter)
        rank += digit * factorial(len(left) - 1)
        left.pop(digit)
    return rank


def intervals() -> list[tuple[int, int, int, int]]:
    """``mask, step, first rank, rank after the last`` of every removal, neighbouring intervals joined."""
    out = []
    for mask in range(1, 1 << len(FILTERS)):
        inside = {f for k, f in enumerate(FILTERS) if mask >> k & 1}
        for step in range(1, len(FILTERS) + 1):
            runs: list[list[int]] = []
            for prefix in permutations(FILTERS, step):
                if inside & set(prefix[:-1]) or prefix[-1] not in inside:
                    continue
                start = lehmer_start("".join(prefix))
                end = start + factorial(len(FILTERS) - step)
                if runs and runs[-1][1] == start:
                    runs[-1][1] = end
                else:
                    runs.append([start, end])
            out.extend((mask, step, a, b) for a, b in runs)
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``."""
    spark = docs.sparkSession
    counts = (facts(docs, labels).groupBy("part", "mask")
              .agg(F.count("*").alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic")))
    # From here on every step is by part: one exchange of at most 32 rows a part.
    tallied = (counts.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"), F.sum("n").alias("total"))
        .select("part", "total", F.explode("masks").alias("m")).select("part", "total", "m.*"))
    moves = F.broadcast(spark.createDataFrame(  # a fixed table of a few hundred rows
        [(m, s, at, sign) for m, s, a, b in intervals() for at, sign in ((a, 1), (b, -1))],
        "mask int, step int, rank int, sign int"))
    steps = F.broadcast(spark.createDataFrame(
        [(o, r, s + 1, f) for r, o in enumerate(orders()) for s, f in enumerate(o)],
        "filter_order string, rank int, step int, letter string"))
    measures = ("n", "good", "toxic")
    ends = (tallied.join(moves, "mask").groupBy("part", "step", "rank")
            .agg(*[F.sum(F.col(c) * F.col("sign")).alias(c) for c in measures]))
    per_filter = tallied.groupBy("part").agg(
        F.max("total").alias("total"),
        *[F.sum(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("n")).otherwise(0)).alias(f"fails_{f}") for k, f in enumerate(FILTERS)],
        *[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)).alias(f"only_{f}") for k, f in enumerate(FILTERS)])
    along = Window.partitionBy("part", "step").orderBy("rank")
    through = Window.partitionBy("part", "filter_order").orderBy("step")
    grid = (per_filter.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(len(FILTERS)) - 1))))
            .join(steps, "rank"))  # a part's 600 output rows
    removed = (grid.join(ends, ["part", "step", "rank"], "left")
               .select("part", "filter_order", "step", "rank", "letter", "total",
                       *[F.sum(F.coalesce(c, F.lit(0))).over(along).alias(c) for c in measures],
                       *[F.coalesce(*[F.when(F.col("letter") == f, F.col(f"{kind}_{f}")) for f in FILTERS]).alias(kind)
                         for kind in ("fails", "only")]))
    return removed.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("n").over(through)).alias("kept"), F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"), F.col("only").alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"))
