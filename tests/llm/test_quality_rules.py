import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from panelcast.llm import quality_rules as Q
from tests.llm import fixtures as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    covered = set()
    for i, g in enumerate(zip(ws, ws[1:], ws[2:])):
        if grams[g] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_metrics_against_brute_force(spark):
    rng = random.Random(0)
    rows = X.rows() + [(5000 + k, "".join(rng.choice("ab \n\t#|<") for _ in range(rng.randint(0, 120))), "en", "s", 0) for k in range(300)]
    df = X.with_extra(spark.createDataFrame(rows, X.SCHEMA), "h", "i", "ws")
    got = df.select("doc_id", "text", Q.metrics(F.col("text")).alias("m")).collect()
    for r in got:
        assert (r.m.n_words, r.m.word_chars, r.m.n_symbols, r.m.n_dup_lines, r.m.n_repeat_words) == brute(r.text), r.text


def test_binomial_tail(spark):
    cases = [(10, 0, 0.3), (100, 3, 0.1), (2000, 5, 0.01), (50_000, 400, 0.01), (7, 7, 0.5), (100, 30, 0.1), (1, 0, 0.01)]
    df = spark.createDataFrame(cases, "n long, k long, p double")
    for r in df.withColumn("t", Q.binomial_tail(F.col("n"), F.col("k"), F.col("p"))).collect():
        if r.k >= r.n * r.p:
            want = 1.0
        else:
            want = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1)
                                + j * math.log(r.p) + (r.n - j) * math.log1p(-r.p)) for j in range(r.k + 1))
        assert abs(r.t - want) <= 1e-9 + 1e-7 * want


def labelled(spark, n, bad_rate, extra_rate=0.0):
    """Texts of 60 words; bad ones are decorated, and so is a share of the good ones."""
    rng = random.Random(n)
    rows, labels = [], []
    for k in range(n):
        bad = rng.random() < bad_rate
        text = X.prose(rng, 60)
        if bad or rng.random() < extra_rate:
            text = " ".join(w + "###" for w in text.split())
        rows.append((k, text, rng.choice(["en", "de"]) if k % 50 else None, "s", len(text)))
        labels.append((k, int(not bad), 0))
    return spark.createDataFrame(rows, X.SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def judged(docs, labels, **kw):
    measured = docs.select("doc_id", Q.stratum_of(F.col("lang")).alias("stratum"), Q.metrics(F.col("text")).alias("m")).cache()
    cutoffs = Q.calibrate(measured, labels, **kw)
    return Q.judge(measured, cutoffs), cutoffs


def test_cutoffs_reject_bad_documents_and_limit_false_rejections(spark):
    docs, labels = labelled(spark, 2600, 0.15)
    got, cutoffs = judged(docs, labels)
    assert {r.stratum for r in cutoffs.collect()} == {"en", "de"}  # too few labels without a language
    rows = got.join(labels, "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert not any(r.kept for r in rows if r.quality == 0 and r.stratum != "und")


def test_good_documents_are_not_rejected_beyond_the_risk(spark):
    """A third of the good documents look like the bad ones: cutoffs that would take them are refused."""
    docs, labels = labelled(spark, 2600, 0.15, extra_rate=0.3)
    got, _ = judged(docs, labels)
    for stratum in ("en", "de"):
        good = got.join(labels, "doc_id").where((F.col("stratum") == stratum) & (F.col("quality") == 1))
        assert good.where("not kept").count() <= 0.05 * good.count()


def test_awkward_rows_and_missing_labels(spark):
    docs = X.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = judged(docs, none)[0].collect()
    assert len(rows) == len(X.rows()) and all(r.kept == (not r.base_failed) for r in rows)
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 1, None), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert judged(docs, odd)[0].count() == len(X.rows())
    assert judged(X.empty(spark), none)[0].count() == 0


def test_no_python_in_the_plan(spark):
    docs, labels = labelled(spark, 200, 0.2)
    plan = judged(docs, labels)[0]._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
