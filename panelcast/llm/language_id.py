"""Language identification, words first.

A text's words (runs of letters, lower case) are looked up in a table of known
words with their log frequency in each language. A word that is not known
backs off to characters: at each place of the word, with marks at its ends,
the longest known n-gram that ends there counts, from ``MAX_GRAM`` characters
down to one, and the word's evidence is their mean. The evidence of all words
and the languages' prior are summed; the score is the posterior probability of the best language.

Training counts words and n-grams per language over labelled documents: all of
a language with up to ``max_rows`` of them, else about as many chosen by a hash of id and text
(documented bound). The tables hold every word and n-gram that some language has ``least`` times or more,
with its counts in every language: one rule at every size, and no language pushes out
another's; the model grows with the number of languages only. The prior counts all documents. Scoring reads every whole text.

A slice's new words are scored together: their characters are one array, each place looks
up its n-grams as 64-bit codes in sorted tables, longest first, and the evidence is summed per word.
A worker keeps the evidence of the words it has met (bounded).

Edge cases: a NULL text or one without a letter is ``'und'`` with score 0, as
is every text when nothing was learned. A NULL language does not train. Ties go
to the alphabetically first language. Repeated rows are scored each. Only
``text`` is read for a prediction; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import SLICE, map_arrow, map_slices, written

MAX_GRAM = 4
LETTERS = re.compile(r"[^\W\d_]+")
CACHE_LIMIT = 600_000
#: A count that every language has of every entry.
SMOOTH = 0.5
#: Letters of a word that n-grams are made of; longer runs of letters are cut into such parts.
LONGEST_WORD = 64
#: Hash values are told apart by so many parts when a share of them is taken.
PARTS = 1 << 40


def words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies per language of known words and n-grams.

    base: (0 for words or length of n-gram, language) log frequency of an entry never seen there. Entry e
    gains gain[k] in language at[k] for k from first[e] up to first[e + 1]."""

    def __init__(self, langs: list[str], prior: list[float], known: dict[str, int], gram: dict[str, int], base: np.ndarray,
                 first: np.ndarray, at: np.ndarray, gain: np.ndarray):
        self.langs, self.prior = langs, np.array(prior)
        self.known, self.gram = known, gram
        self.base, self.first, self.at, self.gain = base, first, at, gain
        self.tables = {}
        for n in range(1, MAX_GRAM + 1):
            spelled = [g for g in gram if len(g) == n]
            codes = _codes(np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4"), n)[n - 1::n]
            order = np.argsort(codes, kind="stable")
            self.tables[n] = (codes[order], np.array([gram[g] for g in spelled], dtype=np.int64)[order])

    def flat(self) -> tuple:
        return self.langs, self.prior, self.known, self.gram, self.base, self.first, self.at, self.gain

    def _gained(self, entries: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
        """(owners, languages): the gains of all entries added up per owner."""
        size = self.first[entries + 1] - self.first[entries]
        own = np.arange(size.sum()) + np.repeat(self.first[entries] - np.cumsum(size) + size, size)
        place = np.repeat(owner, size) * len(self.langs) + self.at[own]
        return np.bincount(place, weights=self.gain[own], minlength=owners * len(self.langs)).reshape(owners, -1)

    def evidence(self, new: list[str]) -> np.ndarray:
        """(words, languages): a known word's log frequency, else the mean over a word's places of the longest
        known n-gram ending there."""
        out = np.zeros((len(new), len(self.langs)))
        entry = np.array([self.known.get(w, -1) for w in new], dtype=np.int64)
        known = np.flatnonzero(entry >= 0)
        if len(known):
            out[known] = self.base[0] + self._gained(entry[known], np.arange(len(known)), len(known))
        rest = np.flatnonzero(entry < 0)
        if not len(rest):
            return out
        parts = [(k, f"^{new[w][at:at + LONGEST_WORD]}$") for k, w in enumerate(rest) for at in range(0, len(new[w]), LONGEST_WORD)]
        length = np.array([len(p) for _, p in parts])
        chars = np.frombuffer("".join(p for _, p in parts).encode("utf-32-le"), "<u4")
        owner = np.repeat([k for k, _ in parts], length)
        inside = np.arange(len(chars)) - np.repeat(np.cumsum(length) - length, length)
        left = np.flatnonzero(inside > 0)
        sums, places = np.zeros((len(rest), len(self.langs))), np.zeros(len(rest))
        for n in range(MAX_GRAM, 0, -1):
            codes, entries = self.tables[n]
            if not len(codes) or not len(left):
                continue
            fits = left[inside[left] >= n - 1]
            code = _codes(chars, n)[fits]
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            hit = codes[at] == code
            mine = owner[fits[hit]]
            count = np.bincount(mine, minlength=len(rest))
            sums += count[:, None] * self.base[n] + self._gained(entries[at[hit]], mine, len(rest))
            places += count
            open_ = np.ones(len(chars), dtype=bool)
            open_[fits[hit]] = False
            left = left[open_[left]]
        out[rest] = sums / np.maximum(places, 1)[:, None]
        return out


def _codes(chars: np.ndarray, n: int) -> np.ndarray:
    """At each place the code of the ``n`` characters ending there (meaningless for the first n - 1 places).

    Up to three characters are spelled out in 21 bits each; a fourth is mixed in by multiplication."""
    c = chars.astype("<u8")
    out = c.copy()
    for back in range(1, n):
        shifted = np.concatenate([np.zeros(back, dtype="<u8"), c[:-back]]) if back < len(c) else np.zeros(len(c), dtype="<u8")
        out += shifted << np.uint64(21 * back) if back < 3 else shifted * np.uint64(0x9E3779B97F4A7C15)
    return out


class Evidence(dict):
    """Word to its row of a growing matrix; bounded."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.rows = np.zeros((1 << 16, len(model.langs)))

    def learn(self, new: list[str]) -> None:
        end = len(self) + len(new)
        while end > len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        for at in range(0, len(new), SLICE * SLICE):
            some = new[at:at + SLICE * SLICE]
            self.rows[len(self):len(self) + len(some)] = self.model.evidence(some)
            self.update(zip(some, range(len(self), len(self) + len(some))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        each = [words(t) for t in texts]
        if not self.model.langs:
            return [("und", 0.0)] * len(texts)
        if len(self) > CACHE_LIMIT:
            self.clear()
        self.learn(list(dict.fromkeys(w for ws in each for w in ws if w not in self)))
        return [self._best(ws) if ws else ("und", 0.0) for ws in each]

    def _best(self, ws: list[str]) -> tuple[str, float]:
        at = np.fromiter(map(self.__getitem__, ws), dtype=np.int64, count=len(ws))
        total = self.rows[at].sum(axis=0) + self.model.prior
        best = int(total.argmax())
        return self.model.langs[best], float(1.0 / np.exp(total - total[best]).sum())


_loaded: dict[str, Evidence] = {}


def loaded(token: str, shared) -> Evidence:
    """The process's evidence for a broadcast model, so that later tasks of a worker find it warm."""
    if token not in _loaded:
        _loaded.clear()
        _loaded[token] = Evidence(Model(*shared.value))
    return _loaded[token]


def train(docs: DataFrame, *, max_rows: int = 20_000, least: int = 3) -> Model:
    """Learns from ``text`` and non-NULL ``lang`` of ``docs``."""
    source = docs.where("lang is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    documents = {r.lang: r.n for r in source.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    langs = sorted(documents)
    if not langs:
        none = np.zeros(0, dtype=np.int64)
        return Model([], [], {}, {}, np.zeros((MAX_GRAM + 1, 0)), none, none, np.zeros(0))
    shares = docs.sparkSession.createDataFrame([(x, PARTS if n <= max_rows else max_rows * PARTS // n) for x, n in documents.items()],
                                               "lang string, share long")
    chosen = source.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)) < F.col("share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                seen: dict[str, Counter] = {}
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    seen.setdefault(lang, Counter()).update(words(text))
                rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                                  enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

    counted = written(map_arrow(chosen.select("text", "lang"), count, "lang string, word string, n long")
                      .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, w, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = seen.setdefault(lang, Counter())
                for at in range(0, len(w), LONGEST_WORD):
                    for size in range(1, MAX_GRAM + 1):
                        for g in grams(w[at:at + LONGEST_WORD], size):
                            own[g] += n
            rows = [(lang, g, n) for lang, c in seen.items() for g, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                              enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

    spelled = written(map_arrow(counted, spell, "lang string, word string, n long")
                      .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-grams")
    total = sum(documents.values())
    prior = [float(np.log(documents[x] / total)) for x in langs]
    known, *own = _table(counted, langs, least)
    gram, *more = _table(spelled, langs, least, by_size=True)
    base = np.concatenate((own[0][:1], more[0][1:]))
    first, at, gain = (np.concatenate(x) for x in zip(own[1:], more[1:]))
    return Model(langs, prior, {w: k for k, w in enumerate(known)}, {g: k + len(known) for k, g in enumerate(gram)},
                 base, np.concatenate(([0], np.cumsum(first))), at, gain)


def _table(counted: DataFrame, langs: list[str], least: int, *, by_size: bool = False) -> tuple:
    """(entries, base, languages per entry, their places, gains) of the entries that a language has ``least`` times
    or more; n-grams count among those of their length."""
    kind = F.length("word") if by_size else F.lit(0)
    place = {x: k for k, x in enumerate(langs)}
    sums, kinds = np.zeros((MAX_GRAM + 1, len(langs))), np.zeros(MAX_GRAM + 1)
    for r in counted.groupBy(kind.alias("kind"), "lang").agg(F.sum("n").alias("n"), F.count("*").alias("d")).collect():
        sums[r.kind, place[r.lang]] = r.n
        kinds[r.kind] += r.d
    base = np.log(SMOOTH) - np.log(np.maximum(sums + SMOOTH * kinds[:, None], SMOOTH))
    found = (counted.groupBy("word").agg(F.max("n").alias("most"), F.sort_array(F.collect_list(F.struct("lang", "n"))).alias("by"))
             .where(F.col("most") >= least).select("word", "by").toArrow())
    by = found["by"].combine_chunks()
    each = by.flatten()
    at = np.array([place[x] for x in each.field("lang").to_pylist()], dtype=np.int64)
    gain = np.log1p(np.asarray(each.field("n"), dtype=float) / SMOOTH)
    return found["word"].to_pylist(), base, np.array([len(x) for x in by], dtype=np.int64), at, gain


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model.flat())
    token = uuid.uuid4().hex

    def make():
        own = loaded(token, shared)

        def of_slice(cols):
            found = own.predict(cols["text"])
            return {"doc_id": cols["doc_id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return of_slice

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                      make, "doc_id long, lang_pred string, score double")
