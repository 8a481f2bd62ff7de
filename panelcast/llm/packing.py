"""Best-fit packing of documents into sequences, online and in bounded space.

Documents become pieces of at most ``length`` tokens; only longer documents are
cut, into full pieces behind a first piece that may be shorter. Pieces go to
groups of about ``GROUP`` by hash, each packed by one task as a stream, long
pieces first: a piece goes into the open sequence with the least room that still holds
it. Open sequences are found in a bitset whose bit ``f`` says that some open
sequence has ``f`` tokens free. At most ``open_bins`` are open; when one more
is needed, the fullest closes first. State is bounded by ``open_bins``, whatever
the group holds. Groups are sized by a count of the pieces, so a task's work
does not grow with the corpus.

Edge cases: NULL and empty texts are documents of the end id alone. A NULL
``doc_id`` is packed like any other. Repeated rows are packed each. An empty table
gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import map_arrow, map_slices, written
from panelcast.llm.tokenize import encoder

LENGTH = 2048
OPEN_BINS = 16_384
GROUP = 32_768
#: Sequence numbers: group * this + number in the group.
GROUP_STRIDE = 1 << 32


def pieces(docs: DataFrame, *, tokenizer: str, cut: str | None, end_id: int, length: int = LENGTH,
           with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``
    (binary little-endian u32) per piece."""
    def make():
        enc = encoder(tokenizer, cut)

        def of_slice(cols):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                ids = np.append(enc.ids(text).astype("<u4"), np.uint32(end_id)).astype("<u4")
                bounds = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    raw = ids[a:b].tobytes()
                    for name, value in zip(out, (doc_id, k, a, b - a, zlib.crc32(raw), raw if with_ids else None)):
                        out[name].append(value)
            return out

        return of_slice

    found = map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                       make, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


class Packer:
    """Open sequences of one group."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.open_bins = length, open_bins
        self.free = 0  # the bitset
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.open = self.made = 0

    def place(self, n: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of n tokens."""
        fits = self.free >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            sequence = self._take(room)
        else:
            if self.open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            room, sequence = self.length, self.made
            self.made += 1
        left = room - n
        if left:
            self.by_free[left].append(sequence)
            self.free |= 1 << left
            self.open += 1
        return sequence, self.length - room

    def _take(self, room: int) -> int:
        sequence = self.by_free[room].pop()
        if not self.by_free[room]:
            self.free &= ~(1 << room)
        self.open -= 1
        return sequence


def pack(pieces: DataFrame, *, length: int = LENGTH, open_bins: int = OPEN_BINS, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id, offset`` to rows with ``doc_id, piece, length`` (1 to ``length``).

    ``pieces`` should be a written table: it is counted first."""
    groups = max(1, -(-pieces.count() // group))
    # repeated rows differ in nothing, so they may share a group; any order of them gives the same rows
    dealt = (pieces.withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(groups)))
             .repartition(groups, "__group").sortWithinPartitions("__group", F.desc("length"), "doc_id", "piece"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, now = None, None
        for batch in batches:
            names = batch.schema.names
            own, sizes = batch.column(names.index("__group")).to_pylist(), batch.column(names.index("length")).to_pylist()
            sequences, offsets = [], []
            for g, n in zip(own, sizes):
                if g != now:
                    packer, now = Packer(length, open_bins), g
                s, o = packer.place(n)
                sequences.append(g * GROUP_STRIDE + s)
                offsets.append(o)
            kept = [i for i, x in enumerate(names) if x != "__group"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=[names[i] for i in kept] + ["sequence_id", "offset"])

    return map_arrow(dealt, run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, *, tokenizer: str, cut: str | None, end_id: int, length: int = LENGTH,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places."""
    return pack(written(pieces(docs, tokenizer=tokenizer, cut=cut, end_id=end_id, length=length, with_ids=with_ids),
                        "pieces"), length=length)
