"""SimHash near-duplicates by bit-sliced comparison.

1. Every text gets a 64-bit fingerprint of its word shingles (XXH64, seed 42;
   a bit is set if it is set in over half the hashes).
2. Equal fingerprints are one node, named by the fingerprint itself.
3. Fingerprints within ``radius`` bits agree on at least ``blocks - radius``
   of ``blocks`` bit blocks, so every link shares one of the
   C(blocks, radius) keys made of the other blocks' bits. Only keys with two
   or more fingerprints go on.
4. The members of the keys are laid out in key order in blocks of a few
   thousand. A block's fingerprints are stored *vertically*: plane ``b`` holds
   bit ``b`` of all of them, 64 to a machine word. The distances to a query
   advance together, one plane at a time, in carry-save counters; words in which
   every distance has passed the radius are abandoned. A key with more
   members than a block holds is cut into parts, and every pair of parts
   becomes a block of its own, on any task: all pairs are compared, none is
   emitted. A block emits a spanning forest of its links, never the pairs.
5. Connected components of the forests' edges (``components``).

Edge cases: a NULL or empty text has fingerprint zero and is linked like any
other. A text of fewer words than a shingle is one shingle. Rows with a NULL
``doc_id`` take part with their fingerprint, and bridge like any other, but can name no component: theirs
is NULL when no other member has an id. Rows of one ``doc_id`` with different texts
are different nodes. Repeated rows are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import LOWER_AZ, map_arrow, map_slices, written
from panelcast.llm.components import components

BLOCK = 4096
CHUNK = 64


def shingle_hashes(words: list[bytes], size: int, seed: int = 42) -> list[int]:
    """XXH64 of each space-joined run of ``size`` words, repeats included;
    fewer words: of the whole sequence; none: nothing."""
    if not words:
        return []
    joined, n = b" ".join(words), len(words)
    h = xxhash.xxh64_intdigest
    if n <= size:
        return [h(joined, seed)]
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    return [h(joined[a:b - 1], seed) for a, b in zip(starts, starts[size:])]


def fingerprint(hashes: list[int]) -> int:
    """Signed 64-bit majority of the hashes' bits (strictly over half)."""
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones.astype(np.int64) > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` for every row of ``docs``."""
    def make():
        def of_slice(cols):
            return {"doc_id": cols["doc_id"], "text_hash": cols["text_hash"], "fp": [
                fingerprint(shingle_hashes(t.encode().translate(LOWER_AZ).split(), shingle)) if t else 0
                for t in cols["text"]]}
        return of_slice

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                  _text_hash().alias("text_hash")), make, "doc_id long, text_hash long, fp long")


def _text_hash():
    """Tells the texts of one ``doc_id`` apart."""
    return F.xxhash64(F.col("text").cast("string"))


def links_within(fps: np.ndarray, radius: int) -> np.ndarray:
    """Bit-sliced neighbours: row i has bit j set if fps i and j differ in at most ``radius`` bits.

    Result: (n, ceil(n / 64)) little-endian uint64 words."""
    n = len(fps)
    width = -(-n // 64)
    padded = np.zeros(width * 64, dtype="<u8")
    padded[:n] = fps.view("<u8")
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # (items, 64)
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")  # (64, width)
    counters = max(1, int(radius).bit_length())
    start = (1 << counters) - 1 - radius  # a carry out of the counters means "beyond the radius"
    full = ~np.uint64(0)
    out = np.zeros((n, width), dtype="<u8")
    for at in range(0, n, CHUNK):
        query = np.where(bits[at:min(at + CHUNK, n)] > 0, full, np.uint64(0))  # (q, 64)
        cols = np.arange(width)
        count = [np.full((len(query), width), full if start >> c & 1 else 0, dtype="<u8") for c in range(counters)]
        over = np.zeros((len(query), width), dtype="<u8")
        for b in range(64):
            carry = planes[b, cols] ^ query[:, b:b + 1]
            for c in range(counters):
                count[c], carry = count[c] ^ carry, count[c] & carry
            over |= carry
            if b % 8 == 7:  # abandon the words whose 64 distances are all beyond the radius, for every query of the chunk
                alive = (over != full).any(axis=0)
                if not alive.any():
                    break
                if alive.sum() * 4 <= 3 * len(cols):
                    cols, over, count = cols[alive], over[:, alive], [x[:, alive] for x in count]
        out[at:at + CHUNK, cols] = ~over
    if n % 64:
        out[:, -1] &= np.uint64((1 << (n % 64)) - 1)
    return out


def forest(ids: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (id, smallest id of its component) of the links within one block."""
    near = links_within(fps, radius)
    n = len(fps)
    seen, edges = np.zeros(n, dtype=bool), []
    alone = np.bitwise_count(near).sum(axis=1) == 1
    for i in np.flatnonzero(~alone):
        if seen[i]:
            continue
        seen[i], todo, group = True, [i], [i]
        while todo:
            row = np.unpackbits(near[todo.pop()].view(np.uint8), bitorder="little", count=n).view(bool)
            new = np.flatnonzero(row & ~seen)
            seen[new] = True
            todo.extend(new)
            group.extend(new)
        root = int(ids[group].min())
        edges.extend((int(x), root) for x in ids[group] if x != root)
    return edges


def candidate_links(nodes: DataFrame, *, radius: int = 2, blocks: int = 4) -> DataFrame:
    """Edges ``a, b`` (a > b) spanning the links between distinct fingerprints.

    ``nodes``: ``node, fp``, distinct in both."""
    bounds = np.linspace(0, 64, blocks + 1).astype(int)
    masks = []
    for left_out in combinations(range(blocks), radius):
        bits = 0
        for k in set(range(blocks)) - set(left_out):
            bits |= ((1 << int(bounds[k + 1])) - 1) ^ ((1 << int(bounds[k])) - 1)
        masks.append(bits - (1 << 64) if bits >> 63 else bits)
    keyed = nodes.select("node", "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                         .alias("t", "key"))
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("members")).where("members > 1")
    half = BLOCK // 2
    parts = F.when(F.col("members") <= BLOCK, 1).otherwise(F.ceil(F.col("members") / half)).cast("int")
    mine = F.pmod(F.xxhash64("fp", "t"), F.col("parts")).cast("int")
    dealt = (keyed.join(shared, ["t", "key"]).withColumn("parts", parts).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("node", "fp", "t", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi")))
    spread = dealt.repartition("t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups in key order; small ones share a block."""
        rest: list[pa.RecordBatch] = []

        def columns(parts):
            table = pa.Table.from_batches(parts).combine_chunks()
            return [table.column(k).to_numpy() for k in ("node", "fp", "t", "key", "lo", "hi")]

        def emit(cols, last):
            node, fp, *group = cols
            new = np.zeros(len(node), dtype=bool)
            for g in group:
                new[1:] |= g[1:] != g[:-1]
            cuts = [*np.flatnonzero(new), *([len(node)] if last else [])]
            at, found = 0, []
            for k, cut in enumerate(cuts):
                if k + 1 < len(cuts) and cuts[k + 1] - at <= BLOCK:
                    continue
                ids, first = np.unique(node[at:cut], return_index=True)
                found.extend(forest(ids, fp[at:cut][first], radius))
                at = cut
            return found, at

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()),
                                               pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

        held = 0
        for batch in batches:
            rest.append(batch)
            held += batch.num_rows
            if held >= 4 * BLOCK:
                found, at = emit(columns(rest), False)
                rest = [b for b in pa.Table.from_batches(rest).slice(at).to_batches()]
                held = sum(b.num_rows for b in rest)
                yield batch_of(found)
        if held:
            yield batch_of(emit(columns(rest), True)[0])

    return map_arrow(spread, compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 2, blocks: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    return _placed(docs, shingle, radius, blocks).select("doc_id", "fp", "component_id")


def _placed(docs: DataFrame, shingle: int, radius: int, blocks: int) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id``: the root is a fingerprint."""
    fps = written(fingerprints(docs, shingle=shingle), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    roots = components(candidate_links(nodes.select(F.col("fp").alias("node"), "fp"), radius=radius, blocks=blocks))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return fps.join(named, "fp")


def keep_one(docs: DataFrame, *, shingle: int = 3, radius: int = 2, blocks: int = 4) -> DataFrame:
    """One row of every component: that of its smallest ``doc_id``; if several texts of the component share that
    id, the one with the smallest hash, and of equal rows one. Texts of one id in different components all stay.
    Rows with a NULL ``doc_id`` stay: they cannot be told apart."""
    placed = _placed(docs, shingle, radius, blocks)
    first = (placed.where("doc_id is not null").groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
             .select(F.col("f.doc_id").alias("__first"), F.col("f.text_hash").alias("__hash")).distinct())
    known = docs.where("doc_id is not null")
    mine = (F.col("doc_id") == F.col("__first")) & (_text_hash() == F.col("__hash"))
    kept = known.join(first, mine, "left_semi")
    repeated = (known.groupBy("doc_id", _text_hash().alias("__hash")).count().where("count > 1")
                .select(F.col("doc_id").alias("__first"), "__hash"))
    single = kept.join(repeated, mine, "left_anti")
    once = kept.join(repeated, mine, "left_semi").withColumn("__hash", _text_hash()).dropDuplicates(["doc_id", "__hash"]).drop("__hash")
    return single.unionByName(once).unionByName(docs.where("doc_id is null"))
