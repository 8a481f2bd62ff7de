"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every document gets a few metrics (share of symbols, repeated lines, repeated
three-word windows, capitals, exclamation marks). Two fixed base rules reject
very short and very repetitive texts. The other rules compare a metric with a
cutoff, and the cutoffs are chosen on labelled documents so that the share of
good documents that a rule rejects is limited *in every stratum*:

* per stratum and rule, each cutoff of a grid is tested: with ``n`` good
  documents of which ``k`` are rejected, the exact binomial tail
  ``P(Bin(n, risk / rules) <= k)`` is the p-value of "the rule rejects more
  than its share of the risk";
* along the grid, from lenient to strict, the tests form a fixed sequence
  (``k`` only grows), so the grid needs no further correction; over rules and
  strata the level is divided by their number (Bonferroni). With probability
  ``1 - level`` no rule exceeds its share in any stratum, hence all rules
  together reject at most ``risk`` of a stratum's good documents;
* of the admissible cutoffs the one with the greatest gain is taken, the most
  lenient one on ties; the gain is the number of bad documents rejected less
  ``cost`` times that of good ones. A rule without an admissible cutoff of
  positive gain stays off in that stratum.

Edge cases: NULL and empty texts have no words and fail the base rule. A NULL
stratum is the stratum ``'und'``. Strata without labels get no rule beyond
the base rules. Documents without a (non-NULL) label take no part in the
choice. Repeated rows are judged alike, each on its own. Columns of the input
that clash with metric names are kept out of the metrics' way by a prefix.
Without labels at all only the base rules act.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import let, words_column, written

#: The symbols and the limits of the two base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"
#: Below this many labelled strata the cutoffs are a small table that every task may hold.
MAX_BROADCAST_STRATA = 10_000

#: Bad documents that one falsely rejected good document outweighs.
COST = 5

#: rule -> grid of cutoffs from lenient to strict; a document fails above the cutoff.
GRID = [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02]
RULES = ("symbol_share", "bang_share", "capital_share", "dup_line_share", "repeat_share")


def metrics(text: Column) -> Column:
    """Struct of counts of one text (see the module text)."""
    text = F.coalesce(text, F.lit(""))

    def removed(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")

    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            removed(SYMBOLS).alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeated_words(ws).alias("n_repeat_words"),
            let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
            removed(CAPITALS).alias("n_capitals"),
            removed("!").alias("n_bangs"),
        )

    return let(words_column(text), of_words)


def _repeated_words(ws: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are compared by 64-bit hash. A text without a repeated window
    (the usual case) costs one hash set; otherwise the windows are sorted by
    hash, so the work is n log n however repetitive the text is."""
    n = F.size(ws)
    hashes = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(ws[i], ws[i + 1], ws[i + 2])))

    def covered(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            return F.sort_array(F.transform(
                F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"]))
                         | ((j + 1 < F.size(s)) & (F.get(s, j + 1)["h"] == x["h"]))),
                lambda x: x["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda p, j: F.when(j + 1 < F.size(at), F.least(F.lit(3), F.get(at, j + 1) - p))
                                .otherwise(F.lit(3)).cast("long"))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(
            let(ordered, lambda s: let(positions(s), total)))

    return let(hashes, covered)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def shares(m: Column) -> dict[str, Column]:
    """Metrics of the adjustable rules, each in proportion to the text."""
    def of(a: str, b: str) -> Column:
        return F.coalesce(m[a] / F.when(m[b] > 0, m[b]), F.lit(0.0))

    return {
        "symbol_share": of("n_symbols", "word_chars"), "bang_share": of("n_bangs", "n_words"),
        "capital_share": of("n_capitals", "word_chars"), "dup_line_share": of("n_dup_lines", "n_lines"),
        "repeat_share": of("n_repeat_words", "n_words"),
    }


def binomial_tail(n: Column, k: Column, p: Column) -> Column:
    """P(Bin(n, p) <= k), summed exactly in log space; 1 where k >= n p, which
    no level below a half could accept."""
    step = F.log(p / (1 - p))
    zero = n * F.log(1 - p)
    acc = F.aggregate(
        F.when(k < 1, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("long"), k)),
        F.struct(zero.alias("t"), zero.alias("s")),
        lambda a, j: let(a["t"] + F.log((n - j + 1) / j) + step,
                         lambda t: F.struct(t.alias("t"), (F.greatest(a["s"], t) + F.log1p(F.exp(-F.abs(a["s"] - t)))).alias("s"))))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(acc["s"]))


def calibrate(measured: DataFrame, labels: DataFrame, *, risk: float = 0.05, level: float = 0.05,
              cost: int = COST) -> DataFrame:
    """Cutoffs per stratum: ``stratum, cutoffs map<rule, cutoff>``.

    ``measured`` has ``doc_id, stratum, m`` (the metrics struct), ``labels``
    ``doc_id, quality``. Only aggregates of strata x rules x grid leave the
    labelled rows, so nothing here grows with the corpus but one join of the
    labels. Documents failing the base rules are left out on both sides: they
    are rejected whatever the cutoffs say."""
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    rows = measured.where(~base_failed(F.col("m"))).join(known, "doc_id")
    tested = F.array(*[F.struct(F.lit(r).alias("rule"), v.alias("v")) for r, v in shares(F.col("m")).items()])
    grid = F.array(*[F.lit(c) for c in GRID])
    counts = (
        rows.select("stratum", "quality", F.explode(tested).alias("t"))
        .select("stratum", "quality", "t.rule", F.explode(F.transform(grid, lambda c: F.struct(
            c.alias("cutoff"), (F.col("t.v") > c).cast("long").alias("hit")))).alias("g"))
        .groupBy("stratum", "rule", "g.cutoff")
        .agg(F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).cast("long").alias("n"),
             F.sum(F.when(F.col("quality") == 1, F.col("g.hit")).otherwise(0)).cast("long").alias("k"),
             F.sum(F.when(F.col("quality") == 0, F.col("g.hit")).otherwise(0)).cast("long").alias("caught")))
    counts = written(counts, "cutoff-counts")
    tests = max(1, counts.select("stratum").distinct().count()) * len(RULES)
    allowed = (
        counts.withColumn("gain", F.col("caught") - cost * F.col("k")).where((F.col("gain") > 0) & (F.col("n") > 0))
        .withColumn("p", binomial_tail(F.col("n"), F.col("k"), F.lit(risk / len(RULES))))
        .where(F.col("p") <= level / tests))
    best = allowed.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def passes(m: Column, cutoffs: Column) -> Column:
    """Verdict on one metrics struct with the cutoffs of its stratum (NULL: base rules only)."""
    fails = base_failed(m)
    for rule, value in shares(m).items():
        fails = fails | F.coalesce(value > cutoffs[rule], F.lit(False))
    return ~fails


def with_cutoffs(rows: DataFrame, cutoffs: DataFrame, stratum: Column, name: str = "cutoffs") -> DataFrame:
    """Adds the cutoffs of each row's stratum; broadcast while there are few strata."""
    few = cutoffs.limit(MAX_BROADCAST_STRATA + 1).count() <= MAX_BROADCAST_STRATA
    limits = cutoffs.select(F.col("stratum").alias("__stratum"), F.col("cutoffs").alias(name))
    return rows.join(F.broadcast(limits) if few else limits, stratum == F.col("__stratum"), "left").drop("__stratum")


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows with ``stratum`` and ``m``."""
    joined = with_cutoffs(measured, cutoffs, F.col("stratum"))
    return joined.withColumn("base_failed", base_failed(F.col("m"))).withColumn(
        "kept", passes(F.col("m"), F.col("cutoffs"))).drop("cutoffs")


def keep(docs: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The documents that pass, all columns; each text is measured once, in the filter itself."""
    joined = with_cutoffs(docs, cutoffs, stratum_of(F.col("lang")), "__cutoffs")
    return joined.where(let(metrics(F.col("text")), lambda m: passes(m, F.col("__cutoffs")))).select(*docs.columns)


def stratum_of(lang: Column) -> Column:
    return F.coalesce(lang, F.lit("und"))
