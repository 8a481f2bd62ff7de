"""Token ids of whole texts, with a bounded cache of whole words.

Encoding a text piece by piece gives the ids of the whole text where the
tokenizer's own splitting never crosses the cut. Two ways to cut are offered:

* ``"space_free"``: white space separates and is dropped, letters are lowered
  (word-end BPE); cut at white space;
* ``"space_led"``: a piece takes one leading space (byte-level BPE); cut before
  a run of white space.

Texts with white space other than U+0020 and line feed are encoded whole, as
is every text when no way to cut is named. A piece of plain letters with plain
marks behind is two words to either tokenizer, so the model's merges are asked
for each of them directly; any other piece goes through the whole tokenizer.
Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import os
import re

import numpy as np

CACHE_LIMIT = 1_000_000
#: White space (and marks that some libraries take for it) other than U+0020 and line feed.
ODD_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2028\u2029\u202f\u205f\u2060\u3000\ufeff" + "".join(
    map(chr, range(0x2000, 0x200E)))
RUNS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: ASCII marks that neither tokenizer joins to letters (the apostrophe may be).
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

_encoders: dict[tuple[str, str | None], "Encoder"] = {}


def encoder(path: str, cut: str | None) -> "Encoder":
    """The process's encoder, so that later tasks of a worker find a warm cache."""
    if (path, cut) not in _encoders:
        _encoders[path, cut] = Encoder(path, cut)
    return _encoders[path, cut]


def byte_letters() -> dict[int, str]:
    """The public byte-level rule: printable bytes stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)}


def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder(dict):
    """Maps a piece to its ids as bytes, learning pieces as they are asked for."""

    def __init__(self, path: str, cut: str | None):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merges = self.tokenizer.model.tokenize
        self.width = "<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4"
        self.size = int(self.width[2])
        self.raw = [i.to_bytes(self.size, "little") for i in range(max(self.tokenizer.get_vocab(True).values()) + 1)]
        self.cut = cut
        self.letters = byte_letters()
        self.lead = self.letters[32] if cut == "space_led" else ""

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text (NULL: none) as unsigned integers of ``self.width``."""
        if not text:
            return np.zeros(0, dtype=self.width)
        if len(self) > CACHE_LIMIT:
            self.clear()
        if self.cut is None or any([c in text for c in ODD_SPACES]):
            found = self._whole(text)
        elif self.cut == "space_free":
            # the vocabulary is lower case; beyond Latin-1 lowering may depend on the neighbours
            found = b"".join(map(self.__getitem__, (text.lower() if latin(text) else text).split()))
        elif "  " in text:
            found = b"".join([self[p[1:]] if p[0] == " " else self._whole(p) for p in RUNS.findall(text)])
        else:
            first, *rest = text.split(" ")
            plain = first.isascii() and first.isalpha()
            found = (self._word(first) if plain else self._whole(first)) + b"".join(map(self.__getitem__, rest))
        return np.frombuffer(found, dtype=self.width)

    def __missing__(self, piece: str) -> bytes:
        letters = piece.rstrip(MARKS)
        if letters.isalpha() if letters.isascii() else LETTERS.fullmatch(letters):
            if len(letters) < len(piece):
                found = self[letters] + self._word(piece[len(letters):])
            else:
                found = self._word(self.lead + (piece if piece.isascii() else "".join(
                    [self.letters[b] for b in piece.encode()])))
        else:
            found = self._whole((" " if self.lead else "") + piece)
        self[piece] = found
        return found

    def _word(self, word: str) -> bytes:
        """Of one word in byte letters."""
        raw = self.raw
        return b"".join([raw[t.id] for t in self.merges(word)])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.width).tobytes()
