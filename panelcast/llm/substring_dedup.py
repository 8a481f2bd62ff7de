"""Substring deduplication with repeated-phrase automata.

A *window* is ``WINDOW`` consecutive words of one document. A word goes if a
window over it occurs earlier: in a document with a smaller id, or earlier in the same one.

1. Documents are packed once into *chunks* of some million words (a numbered
   vocabulary and word numbers), stored by chunk in a bucketed table, so that the
   passes below never move the texts again.
2. Every window names one of its ``PHRASE``-word phrases, that of the smallest hash.
   Equal windows name equal phrases, so a window can only recur if its phrase does.
   Chunks send the hashes of their named phrases, packed by hash bucket; a
   bucket confirms those that occur twice or more in the corpus.
3. Each chunk is a shard: it compiles an Aho-Corasick automaton of its confirmed
   phrases (over word numbers) and streams its documents through it, which locates
   every occurrence. Windows whose phrase was located are candidates.
4. Chunks send each distinct candidate window once, with its first document; a bucket tells
   every chunk whether the window's first occurrence in the corpus is its own.
5. All other occurrences are removed, overlaps joined, and the rest is put together.

A phrase or window costs one packed entry per chunk however often it occurs, so
copies that hold a third of the corpus weigh no more on one bucket than
others. Windows are told apart by 64-bit hashes of 64-bit word hashes.

Edge cases: NULL and empty texts have no words and keep an empty text. Texts shorter than
a window lose nothing. A NULL id counts as smaller than any other; of rows with the same id the one
read first counts as earlier. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import map_arrow, scratch_path, words_of, written
from panelcast.llm.hmm_lm import Numbering

WINDOW = 20
PHRASE = 5
CHUNK_WORDS = 1_500_000
BASE = 0x9E3779B97F4A7C15


# --- arrays of one chunk --------------------------------------------------------


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on: a polynomial in BASE, put together
    from runs of 1, 2, 4 ... words; as many places as there are whole runs."""
    run, length, out, done = words, 1, words[:0], 0
    while length <= size:
        if size & length:
            part = run[done:]
            out = out[:len(part)] + np.uint64(pow(BASE, done, 1 << 64)) * part if done else part
            done += length
        run = run[:-length] + np.uint64(pow(BASE, length, 1 << 64)) * run[length:]
        length *= 2
    out = out ^ (out >> np.uint64(29))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class Chunk:
    """Word numbers of documents one after the other, with what the passes need."""

    def __init__(self, vocabulary: list[bytes], numbers: np.ndarray, lengths: np.ndarray):
        self.vocabulary, self.numbers, self.lengths = vocabulary, numbers, lengths.astype(np.int64)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), dtype=np.uint64, count=len(vocabulary))
        self.words = hashes[numbers]
        self.ends = np.cumsum(self.lengths)
        full = self.lengths >= WINDOW
        marks = np.zeros(len(numbers) + 1, dtype=np.int8)
        begin = (self.ends - self.lengths)[full]
        marks[begin] = 1
        marks[begin + self.lengths[full] - WINDOW + 1] -= 1
        self.starts = np.flatnonzero(np.cumsum(marks[:-1], dtype=np.int8))  # of whole windows

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the phrase at each place, place of the phrase that each window names: the first smallest)."""
        per = WINDOW - PHRASE + 1
        hashes = rolled(self.words, PHRASE)
        if not len(self.starts):
            return hashes, self.starts
        least, span = hashes, 1
        while span * 2 <= per:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < per:
            least = np.minimum(least[:len(least) - (per - span)], least[per - span:])
        low = least[self.starts]
        named = self.starts + per - 1
        for j in range(per - 2, -1, -1):
            at = self.starts + j
            named = np.where(hashes[at] == low, at, named)
        return hashes, named


def distinct(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes by bucket and value, number of each given hash, first index of each bucket)."""
    values, where = np.unique(hashes, return_inverse=True)
    bucket = values % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return values[order], rank[where], np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags, bitorder="little").tobytes()


def flags_of(raw: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little", count=count).astype(bool)


# --- passes -----------------------------------------------------------------------


def chunks_of(docs: DataFrame, buckets: int) -> DataFrame:
    """The bucketed chunk table: ``chunk, ids, missing, lengths, numbers, vocabulary``."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() * (1 << 24)
        rows, held, number = [], 0, Numbering()

        def flush():
            rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))  # places then stand in the order of "earlier"
            cells = [chunk, np.array([r[0] or 0 for r in rows], "<i8").tobytes(), bits(np.array([r[0] is None for r in rows])),
                     np.array([len(r[1]) for r in rows], "<u4").tobytes(), b"".join([r[1].tobytes() for r in rows]),
                     b" ".join(number)]
            types = [pa.int64(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)],
                                              names=["chunk", "ids", "missing", "lengths", "numbers", "vocabulary"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    words = words_of(text)
                    rows.append((doc_id, np.fromiter(map(number.__getitem__, words), dtype="<u4", count=len(words))))
                    held += len(words) + 1
                    if held >= CHUNK_WORDS:
                        yield flush()
                        chunk += 1
                        rows, held, number = [], 0, Numbering()
        if rows:
            yield flush()

    packed = map_arrow(source, run, "chunk long, ids binary, missing binary, lengths binary, numbers binary, vocabulary binary")
    spark, name = docs.sparkSession, f"llm_chunks_{uuid.uuid4().hex}"
    (packed.write.option("compression", "zstd").option("path", scratch_path(spark, "chunks")).bucketBy(buckets, "chunk")
     .saveAsTable(name))
    return spark.table(name)


def _chunk(batch: pa.RecordBatch, i: int) -> tuple[int, Chunk]:
    """Columns: chunk, lengths, numbers, vocabulary."""
    cell = lambda k, t: np.frombuffer(batch.column(k)[i].as_buffer(), t)
    return batch.column(0)[i].as_py(), Chunk(batch.column(3)[i].as_py().split(b" "), cell(2, "<u4"), cell(1, "<u4"))


def phrase_questions(chunks: DataFrame, buckets: int) -> DataFrame:
    """``chunk, bucket, hashes, repeated``: the named phrases of each chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, own = _chunk(batch, i)
                hashes, named = own.phrases()
                values, where, edges = distinct(hashes[np.unique(named)], buckets)
                repeated = np.bincount(where, minlength=len(values)) > 1
                rows = [(chunk, b, values[a:z].astype("<u8").tobytes(), bits(repeated[a:z]))
                        for b, (a, z) in enumerate(zip(edges, edges[1:])) if z > a]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                        names=["chunk", "bucket", "hashes", "repeated"])

    return map_arrow(chunks.select("chunk", "lengths", "numbers", "vocabulary"), run,
                     "chunk long, bucket int, hashes binary, repeated binary")


def _answer(questions: DataFrame, buckets: int, decide, column: str) -> DataFrame:
    """``chunk, answers``: ``decide`` gets the rows of a bucket and gives flags for each row's hashes."""
    dealt = questions.select("bucket", "chunk", "hashes", column).repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(bucket, rows):
            flags = decide(rows)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int32()),
                                               pa.array([bits(f) for f in flags], pa.binary())], names=["chunk", "bucket", "flags"])

        now, rows = None, []
        for batch in batches:
            for bucket, chunk, hashes, more in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now and rows:
                    yield answer(now, rows)
                    rows = []
                now = bucket
                rows.append((chunk, np.frombuffer(hashes, "<u8"), more))
        if rows:
            yield answer(now, rows)

    flags = map_arrow(dealt, run, "chunk long, bucket int, flags binary")
    return flags.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "flags"))).alias("answers"))


def recurring(rows: list) -> list[np.ndarray]:
    """Phrases that occur twice or more: repeated in a chunk, or held by two."""
    every = np.concatenate([h for _, h, _ in rows])
    _, where, count = np.unique(every, return_inverse=True, return_counts=True)
    many = (count > 1) | (np.bincount(where, weights=np.concatenate([flags_of(r, len(h)) for _, h, r in rows])) > 0)
    return np.split(many[where], np.cumsum([len(h) for _, h, _ in rows])[:-1])


def owned(rows: list) -> list[np.ndarray]:
    """Windows whose first occurrence in the corpus is the chunk's: smallest document, then the first chunk (rows ascend by chunk)."""
    every = np.concatenate([h for _, h, _ in rows])
    docs = np.concatenate([np.frombuffer(d, "<i8") for _, _, d in rows])
    order = np.lexsort((docs, every))  # stable, so chunks ascend on ties
    new = np.ones(len(order), dtype=bool)
    new[1:] = every[order][1:] != every[order][:-1]
    first = np.zeros(len(order), dtype=bool)
    first[order[new]] = True
    return np.split(first, np.cumsum([len(h) for _, h, _ in rows])[:-1])


def joined_flags(answers: list, edges: np.ndarray) -> np.ndarray:
    """Flags of all buckets one after the other."""
    by_bucket = {a["bucket"]: a["flags"] for a in answers or ()}
    parts = [flags_of(by_bucket[b], z - a) for b, (a, z) in enumerate(zip(edges.tolist(), edges[1:].tolist())) if z > a]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=bool)


def located(own: Chunk, hashes: np.ndarray, named: np.ndarray, confirmed: np.ndarray) -> np.ndarray:
    """Places where a confirmed phrase occurs, found by the chunk's automaton.

    ``confirmed``: per window, whether the phrase it names was confirmed."""
    at = np.zeros(len(own.numbers), dtype=bool)
    _, first = np.unique(hashes[named[confirmed]], return_index=True)
    if not len(first):
        return at
    text, width = spelled(own.numbers, len(own.vocabulary))
    automaton = ahocorasick.Automaton()
    for place in named[confirmed][first].tolist():
        automaton.add_word(text[place * width:(place + PHRASE) * width], PHRASE)
    automaton.make_automaton()
    # one stream over the chunk: a match across two documents is no window's phrase, so it marks nothing that is read
    ends = np.fromiter((end for end, _ in automaton.iter(text)), dtype=np.int64)
    at[(ends + 1) // width - PHRASE] = True
    return at


def spelled(numbers: np.ndarray, vocabulary: int) -> tuple[str, int]:
    """Word numbers as text of a fixed number of letters each.

    The automaton looks through a node's children one by one, so an alphabet of
    128 is fast where one letter per word would be slow. A word's first letter comes
    from an alphabet of its own: matches begin at words only."""
    width = 1
    while 128 ** width < vocabulary:
        width += 1
    letters = np.empty((len(numbers), width), dtype=np.uint8)
    for k in range(width):
        letters[:, k] = numbers.astype(np.int64) >> 7 * (width - 1 - k) & 127
    letters[:, 0] += 128
    return letters.tobytes().decode("latin-1"), width


def window_questions(chunks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """``kind = 'window'``: ``chunk, bucket, hashes, docs`` of the distinct candidates;
    ``kind = 'mask'``: ``chunk`` and, in ``hashes``, one bit per window of the chunk (candidate or not)."""
    together = chunks.join(answers.hint("shuffle_hash"), "chunk", "left").select(
        "chunk", "lengths", "numbers", "vocabulary", "ids", "missing", "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, own = _chunk(batch, i)
                ids = np.frombuffer(batch.column(4)[i].as_buffer(), "<i8").copy()
                ids[flags_of(batch.column(5)[i].as_py(), len(ids))] = np.iinfo(np.int64).min
                hashes, named = own.phrases()
                places, back = np.unique(named, return_inverse=True)
                _, where, edges = distinct(hashes[places], buckets)
                confirmed = joined_flags(batch.column(6)[i].as_py(), edges)[where][back] if len(named) else np.zeros(0, bool)
                candidate = located(own, hashes, named, confirmed)[named]
                at = own.starts[candidate]
                values, where, edges = distinct(rolled(own.words, WINDOW)[at], buckets)
                first = np.full(len(values), len(own.numbers), dtype=np.int64)
                np.minimum.at(first, where, at)
                doc = ids[np.searchsorted(own.ends, first, "right")]
                rows = [("window", chunk, b, values[a:z].astype("<u8").tobytes(), doc[a:z].astype("<i8").tobytes())
                        for b, (a, z) in enumerate(zip(edges, edges[1:])) if z > a]
                rows.append(("mask", chunk, -1, bits(candidate), None))
                types = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["kind", "chunk", "bucket", "hashes", "docs"])

    return map_arrow(together, run, "kind string, chunk long, bucket int, hashes binary, docs binary")


def deduplicated(chunks: DataFrame, masks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    small = masks.select("chunk", F.col("hashes").alias("mask")).join(answers, "chunk", "left")
    together = chunks.join(small.hint("shuffle_hash"), "chunk").select(
        "chunk", "lengths", "numbers", "vocabulary", "ids", "missing", "mask", "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, own = _chunk(batch, i)
                candidate = flags_of(batch.column(6)[i].as_py(), len(own.starts))
                at = own.starts[candidate]
                values, where, edges = distinct(rolled(own.words, WINDOW)[at], buckets)
                mine = joined_flags(batch.column(7)[i].as_py(), edges)
                first = np.full(len(values), len(own.numbers), dtype=np.int64)
                np.minimum.at(first, where, at)
                gone = at[~(mine[where] & (first[where] == at))]
                step = np.zeros(len(own.numbers) + 1, dtype=np.int32)
                np.add.at(step, gone, 1)
                np.add.at(step, gone + WINDOW, -1)
                covered = np.cumsum(step[:-1]) > 0
                missing = flags_of(batch.column(5)[i].as_py(), len(own.lengths))
                yield from _texts(own, np.frombuffer(batch.column(4)[i].as_buffer(), "<i8"), missing, covered)

    return map_arrow(together, run, "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>")


def _texts(own: Chunk, ids: np.ndarray, missing: np.ndarray, covered: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Kept texts and removed ranges (words, end exclusive) of the chunk's documents, some at a time."""
    word = own.vocabulary.__getitem__
    ranges = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for lo in range(0, len(ids), 256):
        out = {"n_removed": [], "kept": [], "removed": []}
        for d in range(lo, min(lo + 256, len(ids))):
            a, z = int(own.ends[d] - own.lengths[d]), int(own.ends[d])
            gone = covered[a:z]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            out["n_removed"].append(int(gone.sum()))
            out["kept"].append(b" ".join(map(word, own.numbers[a:z][~gone].tolist())).decode())
            out["removed"].append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
        hi = lo + len(out["kept"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[lo:hi], pa.int64(), mask=missing[lo:hi]), pa.array(own.lengths[lo:hi], pa.int64()),
             pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string()), pa.array(out["removed"], ranges)],
            names=["doc_id", "n_words", "n_removed", "kept", "removed"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, removed`` for every row: the kept words joined by one
    space, and the removed ranges of words."""
    spark = docs.sparkSession
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = chunks_of(docs, buckets)
    confirmed = written(_answer(phrase_questions(chunks, buckets), buckets, recurring, "repeated"), "phrase-answers")
    asked = written(window_questions(chunks, confirmed, buckets), "window-questions", "kind")
    first = written(_answer(asked.where("kind = 'window'"), buckets, owned, "docs"), "window-answers")
    return deduplicated(chunks, asked.where("kind = 'mask'"), first, buckets)
