"""Benchmark decontamination: documents that contain (nearly) a benchmark item.

Words are runs of anything but white space and ASCII punctuation, lower case.
A document is compared with an item of n words through *windows of n words*
(documents shorter than the item: the whole document). Window and item each
have a SimHash over their five-word shingles, weighted by how often each occurs.

* Only windows that hold enough of some item's shingles are looked at. That
  loses nothing: a weighted Jaccard similarity of ``threshold`` needs at least
  that share of the item's shingles in the window.
* A multi-index finds the items near a window's fingerprint: 64 bits are
  cut into ``radius + 1`` blocks, and two fingerprints within ``radius`` bits
  agree on one block at least, so looking up every block misses none.
* Candidates are verified by the exact weighted Jaccard similarity of their
  shingle multisets, at ``threshold`` or more.

The items are read in blocks of bounded bytes; each block is one broadcast
and one pass over the documents, so a benchmark of any size works and no task
holds more than a block.

Edge cases: NULL and empty texts contain nothing. Items with fewer than five
words have no shingle and match nothing. Items that repeat each match. Rows with
a NULL id or repeated ids are judged each by its own text. An empty benchmark
removes nothing. Other columns pass through ``clean`` unchanged.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import SLICE, map_arrow, map_slices

SHINGLE = 5
THRESHOLD = 0.8
#: Half the bits that unrelated fingerprints differ in is 32; a similarity of 0.8 flips about 10 of 64.
RADIUS = 20
BLOCK_BYTES = 16 << 20

#: ASCII punctuation separates words, capitals are lowered.
SEPARATE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(SEPARATE).split() if text else []


def vote_rows(shingles: list[bytes]) -> np.ndarray:
    """+1 / -1 votes of each shingle's 64 hash bits."""
    h = np.array([xxhash.xxh64_intdigest(s) for s in shingles], dtype="<u8")
    return 2 * np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) - 1


def pack_bits(votes: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of summed votes."""
    return np.ascontiguousarray(np.packbits(votes > 0, axis=1, bitorder="little")).view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: shared weight over joint weight."""
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class HammingIndex:
    """Fingerprints by each of ``radius + 1`` bit blocks."""

    def __init__(self, prints: list[int], radius: int):
        self.prints, self.radius = prints, radius
        bounds = np.linspace(0, 64, radius + 2).astype(int).tolist()
        self.blocks = [(a, (1 << (b - a)) - 1) for a, b in zip(bounds, bounds[1:])]
        self.tables = [defaultdict(list) for _ in self.blocks]
        for k, p in enumerate(prints):
            for (shift, mask), table in zip(self.blocks, self.tables):
                table[p >> shift & mask].append(k)

    def within(self, print_: int) -> list[tuple[int, int]]:
        """(position, distance) of every fingerprint within the radius."""
        found = set()
        for (shift, mask), table in zip(self.blocks, self.tables):
            found.update(table.get(print_ >> shift & mask, ()))
        near = ((k, (self.prints[k] ^ print_).bit_count()) for k in sorted(found))
        return [(k, d) for k, d in near if d <= self.radius]


class Benchmark:
    """One block of items, ready for matching."""

    def __init__(self, items: list[tuple[int | None, str]], radius: int = RADIUS, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.items = []  # (item_id, size, shingle counts)
        by_size: dict[int, list[int]] = defaultdict(list)
        prints = []
        self.vocabulary: dict[bytes, int] = {}
        self.holders: dict[tuple, list[int]] = defaultdict(list)
        for item_id, text in items:
            ws = words(text)
            if len(ws) < SHINGLE:
                continue
            runs = [b" ".join(ws[i:i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)]
            k = len(self.items)
            self.items.append((item_id, len(ws), Counter(runs)))
            prints.append(int(pack_bits(vote_rows(runs).sum(axis=0, keepdims=True))[0]))
            by_size[len(ws)].append(k)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]
            for key in {tuple(ids[i:i + SHINGLE]) for i in range(len(ids) - SHINGLE + 1)}:
                self.holders[key].append(k)
        self.by_size = {n: (ks, HammingIndex([prints[k] for k in ks], radius)) for n, ks in by_size.items()}

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, int, float]]:
        """(item_id, first word, words, distance, similarity) of the best window of every item found."""
        ws = words(text)
        if len(ws) < SHINGLE or not self.items:
            return []
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in ws])
        known = ids > 0
        if np.count_nonzero(known) < SHINGLE:
            return []
        run = known[:len(ws) - SHINGLE + 1].copy()
        for j in range(1, SHINGLE):
            run &= known[j:len(ws) - SHINGLE + 1 + j]
        hits = defaultdict(list)
        for p in np.flatnonzero(run).tolist():
            for k in self.holders.get(tuple(ids[p:p + SHINGLE].tolist()), ()):
                hits[k].append(p)
        starts: dict[int, set] = defaultdict(set)
        for k, at in hits.items():
            size = self.items[k][1]
            need = self.threshold * (size - SHINGLE + 1)
            if len(at) < need - 1e-9:
                continue
            span = min(size, len(ws))
            lo, hi = max(0, at[0] - span + SHINGLE), min(at[-1], len(ws) - span)
            s = np.arange(lo, hi + 1)
            held = np.searchsorted(at, s + span - SHINGLE, "right") - np.searchsorted(at, s, "left")
            starts[size].update(s[held >= need - 1e-9].tolist())
        best = {}
        for size, at in starts.items():
            if at:
                self._compare(ws, size, sorted(at), best)
        return [(self.items[k][0], *v[1:], -v[0][0]) for k, v in sorted(best.items())]

    def _compare(self, ws, size, starts, best) -> None:
        span = min(size, len(ws))
        per = span - SHINGLE + 1
        ks, index = self.by_size[size]
        for group in _runs(starts, per):
            a, b = group[0], group[-1] + span
            runs = [b" ".join(ws[i:i + SHINGLE]) for i in range(a, b - SHINGLE + 1)]
            total = np.concatenate((np.zeros((1, 64), dtype=np.int32), np.cumsum(vote_rows(runs), axis=0, dtype=np.int32)))
            at = np.array(group) - a
            for s, print_ in zip(group, pack_bits(total[at + per] - total[at]).tolist()):
                for k, distance in index.within(print_):
                    found = similarity(Counter(runs[s - a:s - a + per]), self.items[ks[k]][2])
                    if found >= self.threshold:
                        rank = (-found, s)
                        if ks[k] not in best or rank < best[ks[k]][0]:
                            best[ks[k]] = (rank, s, span, distance)


def _runs(starts: list[int], gap: int) -> Iterator[list[int]]:
    """Starts cut where windows no longer overlap, and every few thousand, so that a repetitive document needs no large table."""
    now = [starts[0]]
    for s in starts[1:]:
        if s - now[-1] > gap or len(now) >= 4096:
            yield now
            now = []
        now.append(s)
    yield now


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of about ``block_bytes`` of text."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    for b in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b)
        yield [(r.item_id, r.text) for r in part.sort("item_id", "text").collect()]


def contaminations(docs: DataFrame, benchmark: DataFrame, *, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, distance, similarity``: per document and item the best window."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, first_word long, n_words long, distance long, similarity double"
    names = ["item_id", "first_word", "n_words", "distance", "similarity"]
    found = None
    for items in blocks_of(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            block = Benchmark(shared.value, radius, threshold)

            def of_slice(cols):
                rows = [(d, *m) for d, t in zip(cols["doc_id"], cols["text"]) for m in block.matches(t)]
                return {n: list(c) for n, c in zip(["doc_id", *names], zip(*rows))} if rows else None

            return of_slice

        part = map_slices(source, make, schema)
        found = part if found is None else found.union(part)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, *, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without a contamination, all columns; no shuffle and no join."""
    kept = docs
    schema = docs.schema
    place = docs.columns.index("text")
    for items in blocks_of(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Benchmark(shared.value, radius, threshold)
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    mask = [not block.matches(t) for t in part.column(place).to_pylist()]
                    yield part.filter(pa.array(mask, pa.bool_()))

        kept = map_arrow(kept, run, schema)
    return kept
