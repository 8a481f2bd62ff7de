"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Words become tokens of their form: the letters' own hash and the hash of the
word's shape (letter runs and other marks, capitals told apart), so that
decorated or shouted words share features even where the words are rare. Runs
of one and two tokens (twice the same word also as "the same again") are hashed into ``2 ** BITS`` weights; a text's feature
values are its n-gram counts over the square root of their squared sum, so
length does not decide. A score is one sparse dot product through the logistic function.

Training: documents with a label, none of them held out by the caller, at most
about ``max_rows`` of them chosen by hash (the documented bound). They are dealt
to a fixed number of shards; each runs FTRL-proximal (per-coordinate rates, L1
and L2) over its rows, and the shards' weights are averaged, weighted by
rows. A shard returns one weight vector, so what reaches the driver and
what is broadcast has a fixed size (``shards`` and one times 2 ** BITS floats).

Edge cases: NULL and empty texts have no features and score by the intercept.
Rows with a NULL label, or several labels that disagree, do not train.
Repeated rows are scored each. Without usable labels every score is one half.
Only ``text`` is read for a score; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import map_arrow, map_slices

BITS = 18
INTERCEPT = 1 << BITS
CACHE_LIMIT = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(64 - BITS)

_LOWER = re.compile("[a-zß-öø-ÿ]+")
_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]+")
_DIGIT = re.compile("[0-9]+")


class Forms(dict):
    """Word to the pair of 32-bit hashes (word, shape) as one integer; bounded."""

    def __missing__(self, word: str) -> int:
        shape = _DIGIT.sub("9", _UPPER.sub("A", _LOWER.sub("a", word)))[:24]
        found = (xxhash.xxh32_intdigest(word.lower()) << 32) | xxhash.xxh32_intdigest(shape, 7)
        self[word] = found
        return found


def features(text: str | None, forms: Forms) -> tuple[np.ndarray, np.ndarray]:
    """Weight positions and values of a text, the intercept last."""
    if len(forms) > CACHE_LIMIT:
        forms.clear()
    words = np.array([*map(forms.__getitem__, text.split())], dtype=np.uint64) if text else np.zeros(0, np.uint64)
    if not len(words):
        return np.array([INTERCEPT]), np.ones(1)
    shapes = words & np.uint64(0xFFFFFFFF)
    grams = [words >> np.uint64(32), shapes + np.uint64(1 << 40)]
    if len(words) > 1:
        grams.append((shapes[:-1] * np.uint64(31) + shapes[1:] + np.uint64(1 << 41)) * MIX)
        pair = (words >> np.uint64(32)) * np.uint64(31)
        # a two-gram of twice the same word also counts as such, whatever the word
        grams.append(np.full(int((words[1:] == words[:-1]).sum()), 1 << 43, dtype=np.uint64))
        grams.append((pair[:-1] + (words[1:] >> np.uint64(32)) + np.uint64(1 << 42)) * MIX)
    at = (np.concatenate(grams) * MIX) >> SHIFT
    where, count = np.unique(at.astype(np.int64), return_counts=True)
    value = np.sqrt(count)
    return np.append(where, INTERCEPT), np.append(value / np.sqrt((value ** 2).sum()), 1.0)


class Ftrl:
    """FTRL-proximal logistic regression."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (logistic(float(w @ x)) - label) * x
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = grown


def logistic(score: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(score, -500.0), 500.0)))


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 24_000, shards: int = 8, epochs: int = 4,
          alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 1.0) -> np.ndarray:
    """Averaged weights. ``docs``: ``doc_id, text`` of rows that may train; ``labels``: ``doc_id, quality``.

    Labels are thinned by hash before the documents are joined, so the join moves about ``max_rows`` texts."""
    known = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("__most"))
             .where("quality = __most").select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("__label")))
    eligible = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("__id"))
    many = known.join(eligible, "__id", "left_semi").count()
    million = 1_000_000
    share = million if many <= max_rows else max(1, max_rows * million // many)

    def chosen(df: DataFrame) -> DataFrame:
        return df.where(F.pmod(F.xxhash64("__id"), F.lit(million)) < share)

    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("__id"),
                                                    F.col("text").cast("string").alias("__text"))
    rows = chosen(texts).join(chosen(known), "__id").select("__id", "__text", "__label")
    dealt = (rows.withColumn("__order", F.xxhash64("__id", F.lit(1))).repartition(shards, F.pmod("__order", F.lit(shards)))
             .sortWithinPartitions("__order", "__text").select("__text", "__label"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms, seen = Forms(), []
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, x = features(text, forms)
                seen.append((at.astype(np.int32), x.astype(np.float32), label))
        if seen:
            model = Ftrl(INTERCEPT + 1, alpha, beta, l1, l2)
            for _ in range(epochs):
                for at, x, label in seen:
                    model.learn(at, x, label)
            yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype("<f4").tobytes()], pa.binary()),
                                              pa.array([len(seen)], pa.int64())], names=["weights", "n"])

    parts = sorted(map_arrow(dealt, learn, "weights binary, n long").collect(), key=lambda p: p.weights)  # one row a shard
    total = sum(p.n for p in parts)
    if not total:
        return np.zeros(INTERCEPT + 1)
    return sum(np.frombuffer(p.weights, "<f4").astype(float) * p.n for p in parts) / total


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` (probability of label 1) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype("<f4"))

    def make():
        w, forms = shared.value.astype(float), Forms()

        def of_slice(cols):
            out = []
            for text in cols["text"]:
                at, x = features(text, forms)
                out.append(float(logistic(float(w[at] @ x))))
            return {"doc_id": cols["doc_id"], "score": out}

        return of_slice

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                      make, "doc_id long, score double")
