"""Token-id files: one zstandard frame per document, a seek table at the end.

Layout of a file (all integers little-endian):

* per document one independent zstandard frame of its ids, as 16-bit
  integers where the vocabulary allows it, else 32-bit;
* a skippable frame (magic 0x184D2A5E) that holds the seek table: one entry per
  document ``flag u8, doc_id i64, offset u64, packed u32, ids u32, crc32 u32``
  (flag 1: the id is NULL), then a footer ``documents u64, id bytes u32, magic
  "SEEKTOK1"``. The checksum is that of the ids as unsigned 32-bit integers;
* an empty skippable frame (``SEPARATOR``) stands behind every write of the
  writer, also behind the seek table.

Any zstandard tool can decode such a file as a whole; a reader that can seek
takes the footer, the table and then only the frames of the documents it
wants (``TokenFile``), and checks each one's checksum.

Spark's own text writer writes the bytes: it runs on any store that Spark can
write, and its commit protocol makes a retried or lost task harmless. The
separator above is its line separator. Documents are dealt by range of
``doc_id``, so files and the documents in them ascend.

Edge cases: NULL and empty texts have the end id only. A NULL ``doc_id`` is
stored with its flag and comes first. Repeated ids stay, ordered by text. An
empty table gives files without documents. Other columns are ignored.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import SLICE, map_arrow, scratch_path, written
from panelcast.llm.tokenize import encoder

#: An empty skippable zstandard frame; plain ASCII, so that it can be a line separator.
SEPARATOR = b"P*M\x18\x00\x00\x00\x00"
TABLE_MAGIC = 0x184D2A5E
FOOTER = "<QI8s"
FOOTER_SIZE = struct.calcsize(FOOTER)
FOOTER_MAGIC = b"SEEKTOK1"
ENTRY = np.dtype([("flag", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("packed", "<u4"), ("ids", "<u4"), ("crc", "<u4")])
ROW_BYTES = 1 << 20
#: Text of a file, about.
FILE_BYTES = 1 << 28
LEVEL = 3


def write_token_files(docs: DataFrame, path: str, *, tokenizer: str, cut: str | None, end_id: int) -> None:
    """Encodes every text, appends ``end_id`` and writes the files under ``path``.

    The texts are measured first: where the session's shuffle partitions would give files of more than about
    ``FILE_BYTES`` of text, there are more ranges, so a file stays readable as one row whatever the corpus."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    needed = -(-(read.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES)
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = read.repartitionByRange(needed, "doc_id") if needed > usual else read.repartitionByRange("doc_id")
    ranged = ranged.sortWithinPartitions("doc_id", "text")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, cut)
        packer = zstandard.ZstdCompressor(level=LEVEL)
        tail = np.array([end_id], dtype=enc.width)
        entries, held, held_bytes, offset = [], [], 0, 0

        def row(parts):
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["frame"])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.concatenate((enc.ids(text), tail))
                    frame = packer.compress(ids.tobytes())
                    entries.append((doc_id is None, doc_id or 0, offset + held_bytes, len(frame), len(ids),
                                    zlib.crc32(ids.astype("<u4").tobytes())))
                    held.append(frame)
                    held_bytes += len(frame)
                    if held_bytes >= ROW_BYTES:
                        yield row(held)
                        offset += held_bytes + len(SEPARATOR)
                        held, held_bytes = [], 0
        if entries:
            if held:
                yield row(held)
            table = np.array(entries, dtype=ENTRY).tobytes() + struct.pack(FOOTER, len(entries), enc.size, FOOTER_MAGIC)
            yield row([struct.pack("<II", TABLE_MAGIC, len(table)), table])

    rows = map_arrow(ranged, frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
    rows.write.text(path, lineSep=SEPARATOR.decode("ascii"))


class TokenFile:
    """Random access to one file: any object with ``seek`` and ``read``."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, io.SEEK_END)
        self.table = np.zeros(0, dtype=ENTRY)
        if size == 0:
            return
        file.seek(size - len(SEPARATOR) - FOOTER_SIZE)
        count, self.id_bytes, magic = struct.unpack(FOOTER, file.read(FOOTER_SIZE))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        file.seek(size - len(SEPARATOR) - FOOTER_SIZE - count * ENTRY.itemsize)
        self.table = np.frombuffer(file.read(count * ENTRY.itemsize), dtype=ENTRY)
        self._places = [self.table[k].tolist() for k in ("offset", "packed", "ids", "crc")]
        self._unpack = zstandard.ZstdDecompressor()

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document, as unsigned 32-bit integers; only its frame is read."""
        offset, packed, count, crc = (column[k] for column in self._places)
        self.file.seek(offset)
        ids = np.frombuffer(self._unpack.decompress(self.file.read(packed)), dtype=f"<u{self.id_bytes}").astype("<u4")
        if len(ids) != count or zlib.crc32(ids) != crc:
            raise ValueError(f"checksum of document {self.table['doc_id'][k]} does not match")
        return ids


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``file, place, doc_id, start_in_file, n_tokens, ids`` (ids as binary
    little-endian u32) of all documents, or of the wanted ids only; frames of other documents are not decompressed."""
    wanted = None if doc_ids is None else frozenset(doc_ids)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    schema = "file string, place long, doc_id long, start_in_file long, n_tokens long, ids binary"
    names = ["file", "place", "doc_id", "start_in_file", "n_tokens", "ids"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                file = TokenFile(pa.BufferReader(batch.column(1)[i].as_buffer()))
                starts = (np.cumsum(file.table["ids"], dtype=np.int64) - file.table["ids"]).tolist()
                missing, ids, counts = (file.table[k].tolist() for k in ("flag", "doc_id", "ids"))
                chosen = [k for k in range(len(ids)) if wanted is None or (not missing[k] and ids[k] in wanted)]
                for at in range(0, len(chosen), SLICE):
                    ks = chosen[at:at + SLICE]
                    cols = [[name] * len(ks), ks, [None if missing[k] else ids[k] for k in ks], [starts[k] for k in ks],
                            [counts[k] for k in ks], [file.ids(k).tobytes() for k in ks]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return map_arrow(files, unpack, schema)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` adds the totals of the files before; a file is one row there."""
    rows = read_token_files(spark, path)
    digest = written(rows.select("file", "place", "doc_id", "start_in_file", "n_tokens", F.crc32("ids").alias("ids_crc32")),
                     "token-digest")
    totals = digest.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("first"))
    order = Window.orderBy(F.col("first").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("before"))
    return digest.join(before, "file").select(
        "doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")


def scratch_files(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
