import io
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import zstandard
from tokenizers import Tokenizer

from panelcast.llm import packing, token_output
from panelcast.llm.tokenize import Encoder
from tests.llm import fixtures as X

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


def plain(path, text):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,cut", [(WORD, "space_free"), (BYTE, "space_led"), (WORD, None)])
def test_cached_encoding_is_the_tokenizers(path, cut):
    enc = Encoder(path, cut)
    odd = ["a  b", "a   b\n\n  c", " x ", "x\n y", "foo,,. bar's he'll!!", "É!! ÈRE## é", "ª º µ", "Á é", "foo*** 3rd",
           "\ta \t b c", "İstanbul ΣΑΣ. ﬁ", "a b", "x\x1cy"]
    for text in odd + [r[1] for r in X.rows() if r[1] is None or len(r[1]) < 3000]:
        assert enc.ids(text).tolist() == plain(path, text), repr(text)


def test_files_round_trip(spark, tmp_path):
    docs = X.with_extra(X.documents(spark), "ids", "frame", "file")
    path = str(tmp_path / "out")
    token_output.write_token_files(docs, path, tokenizer=WORD, cut="space_free", end_id=1)
    got = token_output.read_token_files(spark, path).collect()
    want = sorted(((r[0], [*plain(WORD, r[1]), 1]) for r in X.rows()), key=str)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=str) == want
    start = 0
    by_order = sorted(X.rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    digest = {(r.doc_id, r.start): r for r in token_output.read_back(spark, path).collect()}
    for doc_id, text, *_ in by_order:
        ids = np.array([*plain(WORD, text), 1], dtype="<u4")
        row = digest[doc_id, start]
        assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_are_zstandard_and_seekable(spark, tmp_path):
    path = tmp_path / "out"
    token_output.write_token_files(X.documents(spark), str(path), tokenizer=WORD, cut="space_free", end_id=1)
    found = 0
    for f in sorted(path.glob("part-*")):
        raw = f.read_bytes()
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True) as s:
            whole = s.read()
        reads = []

        class Counting(io.BytesIO):
            def read(self, n=-1):
                reads.append(n)
                return super().read(n)

        file = token_output.TokenFile(Counting(raw))
        k = len(file.table) - 1
        before = len(reads)
        ids = file.ids(k)
        assert reads[before:] == [int(file.table["packed"][k])]  # one frame only
        assert whole.endswith(ids.astype("<u2").tobytes())
        found += len(file.table)
        bad = bytearray(raw)
        bad[int(file.table["offset"][k]) + 6] ^= 0xFF
        with pytest.raises((ValueError, zstandard.ZstdError)):
            token_output.TokenFile(io.BytesIO(bytes(bad))).ids(k)
    assert found == len(X.rows())


def test_only_requested_documents(spark, tmp_path):
    path = str(tmp_path / "out")
    token_output.write_token_files(X.documents(spark), path, tokenizer=WORD, cut="space_free", end_id=1)
    assert sorted(r.doc_id for r in token_output.read_token_files(spark, path, [1, 5, 10**6]).collect()) == [1, 1, 5]


def test_files_stay_within_a_bound(spark, tmp_path, monkeypatch):
    """Ten times the text gives more files, not larger ones; ids and places stay the same."""
    monkeypatch.setattr(token_output, "FILE_BYTES", 20_000)
    rows = [(k, X.prose(random.Random(k), 150)) for k in range(400)]
    path = str(tmp_path / "out")
    token_output.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, tokenizer=WORD, cut="space_free", end_id=1)
    sizes = [f.stat().st_size for f in (tmp_path / "out").glob("part-*") if f.stat().st_size]
    assert len(sizes) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 20_000
    back = {r.doc_id: (r.start, r.n_tokens) for r in token_output.read_back(spark, path).collect()}
    at = 0
    for k in range(400):
        assert back[k][0] == at
        at += back[k][1]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "out")
    token_output.write_token_files(X.empty(spark), path, tokenizer=WORD, cut="space_free", end_id=1)
    assert token_output.read_back(spark, path).count() == 0
    assert packing.pack_documents(X.empty(spark), tokenizer=BYTE, cut="space_led", end_id=0).count() == 0


def test_packing_is_whole_and_gapless(spark):
    docs = X.with_extra(X.documents(spark), "piece", "length", "sequence_id", "__group")
    got = packing.pack_documents(docs, tokenizer=BYTE, cut="space_led", end_id=0, with_ids=True).collect()
    want = []
    for doc_id, text, *_ in X.rows():
        ids = [*plain(BYTE, text), 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= sum(r.length for r in got) / 2048 * 1.05 + 1


def test_packer_is_best_fit_and_bounded():
    p = packing.Packer(10, 2)
    assert p.place(6) == (0, 0) and p.place(7) == (1, 0)
    assert p.place(3) == (1, 7)  # the tighter of the two, now full and closed
    assert p.place(5) == (2, 0)
    assert p.place(8) == (3, 0)  # two are open: the fullest (0, with 4 free) closes
    assert p.place(4) == (2, 5) and p.place(2) == (3, 8)
    assert p.open <= 2
