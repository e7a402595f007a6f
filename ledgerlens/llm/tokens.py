"""Whole-text encoding with a public byte-level BPE vocabulary.

Byte-level BPE first cuts a text into pieces that never hold a space except at
their start, and encodes each piece by itself. Cutting the text at its spaces
beforehand therefore gives the same ids, and the ids of a space-separated piece
can be remembered per Python worker. A space inside a longer run of white space
is the exception, and so is the spelling of an added token, which gives one id;
such texts are encoded whole.
"""

from __future__ import annotations

import re
import struct
from functools import cache

import numpy as np
from tokenizers import Tokenizer

from .common import Memory

VOCABULARY = "byte_bpe_50k.json"
#: Bytes of remembered pieces per worker, twice over (see ``common.Memory``): after
#: a space, after anything else, and runs of marks.
MAX_REMEMBERED = {"spaced": 96 << 20, "bare": 24 << 20, "marks": 2 << 20}

_RUN = re.compile(r"\s (?:\s|\Z)")
_SPACE = re.compile(r"\s")
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]
#: Letters below this are letters in every Unicode version in use.
_LATIN_END = "ɐ"
_WORD_AND_MARKS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([^\w\s]+)")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _pack(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, dtype="<u4").tobytes()


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE uses for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + i)
    return letters


class Encoder:
    """Encodes texts to packed ids (little-endian unsigned 32-bit integers); one
    per worker process and vocabulary."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.newline = self._whole("\n")
        self.spaced = Memory(self._spaced, MAX_REMEMBERED["spaced"])
        self.bare = Memory(self._bare, MAX_REMEMBERED["bare"])
        self.marks = Memory(self._whole, MAX_REMEMBERED["marks"])

    def _whole(self, text: str) -> bytes:
        return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, letters: str, space: str) -> bytes:
        """A word: no further cuts, straight to the model."""
        if not letters.isascii():                     # ASCII letters stand for themselves
            letters = letters.encode().decode("latin-1").translate(self.letters)
        return _pack([t.id for t in self.model.tokenize(space + letters)])

    def _spaced(self, piece: str) -> bytes:
        if piece.isalpha() and (piece.isascii() or max(piece) < _LATIN_END):
            return self._word(piece, self.space)
        parts = _WORD_AND_MARKS.fullmatch(piece)
        if parts:
            return self.spaced[parts[1]] + self.marks[parts[2]]
        line, cut, rest = piece.partition("\n")
        if cut and line and rest and not _SPACE.search(line[-1] + rest[0]):
            return self.spaced[line] + self.newline + self.bare[rest]
        return self._whole(" " + piece)

    def _bare(self, piece: str) -> bytes:
        if piece.isalpha() and (piece.isascii() or max(piece) < _LATIN_END):
            return self._word(piece, "")
        parts = _WORD_AND_MARKS.fullmatch(piece)
        if parts:
            return self.bare[parts[1]] + self.marks[parts[2]]
        return self._whole(piece)

    def packed(self, text: str) -> bytes:
        """Ids of the whole text."""
        if not text:
            return b""
        if _RUN.search(text) or any(spelling in text for spelling in self.added):
            return self._whole(text)
        first, space, rest = text.partition(" ")
        head = self.bare[first] if first else b""
        if not space:
            return head
        return head + b"".join(map(self.spaced.__getitem__, rest.split(" ")))


@cache
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(path)
