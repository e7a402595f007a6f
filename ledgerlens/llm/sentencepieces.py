"""Exact SentencePiece BPE encoding by backtracking, and decoding.

Merging the best adjacent pair until none is left gives one sequence of pieces.
A sequence is that one exactly if every two neighbours, merged by themselves,
come out as these two pieces again: until a merge crosses a boundary, the pieces
beside it merge as they would alone. So a text is encoded from left to right
with the longest piece at each place (from one Aho-Corasick pass), shorter ones
where the pair with its neighbour does not hold, and a step back where none
does. As the sequence up to a place is unique, a place that failed once fails
for good; a bitfield remembers it.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from functools import cache, cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, pieces
from .tokens import vocabulary_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"                  # fixed value: the library's mark for a space
#: Bytes of remembered words, and of parts of words, per worker, each twice over.
MAX_REMEMBERED = {"spaced": 96 << 20, "parts": 24 << 20}
#: Remembered pair checks per worker.
MAX_PAIRS = 500_000
END = float("-inf")          # below every score: no merge is left


class Vocabulary:
    """Pieces of a BPE model with byte fallback."""

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.library
        self.normalize = m.normalize
        self.byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        special = {i for i in range(len(self.names)) if m.is_control(i) or m.is_unknown(i) or m.is_byte(i)}
        if any(m.is_unused(i) for i in range(len(self.names))) or not all(map(m.is_byte, self.byte_ids)):
            raise ValueError("only BPE models with byte fallback and without unused pieces")
        self.control = {i for i in special if m.is_control(i)}
        self.ids = {p: i for i, p in enumerate(self.names) if i not in special}
        self.scores = {p: m.get_score(i) for p, i in self.ids.items()}
        if {c for p in self.ids for c in p} - set(self.ids):
            raise ValueError("a character of a piece is no piece")
        self.lengths = [len(p) for p in self.names]
        self.longest = max(map(len, self.ids))
        #: The longest piece that is a proper beginning of a piece, or -1.
        self.shorter = [next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1)
                        if i not in special else -1 for i, p in enumerate(self.names)]
        #: No piece has a space mark after another character, so no merge crosses
        #: the place before one: a text may be cut there.
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        #: Nor has one an ASCII letter beside another ASCII character.
        self.words = re.compile(r"(?<=[A-Za-z])(?=[\x00-\x40\x5b-\x60\x7b-\x7f])"
                                r"|(?<=[\x00-\x40\x5b-\x60\x7b-\x7f])(?=[A-Za-z])").split
        self.word_cuts = self.cuts and all(len(self.words(p)) == 1 for p in self.ids)


    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Of all pieces; only encoding needs it."""
        found = ahocorasick.Automaton()
        for p, i in self.ids.items():
            found.add_word(p, i)
        found.make_automaton()
        return found


@cache
def vocabulary(path: str) -> Vocabulary:
    """The worker's copy of a model file."""
    return Vocabulary(path)


class Encoder:
    """Encodes whole texts to packed ids; one per worker process and model."""

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        self.pairs: dict[int, bool] = {}
        self.shift = len(self.vocabulary.names).bit_length()
        self.histories: dict[int, tuple] = {}       # at most one per piece
        self.parts = Memory(self.chunk, MAX_REMEMBERED["parts"])
        #: By what follows the first space mark.
        self.spaced = Memory(lambda rest: self.cut(SPACE + rest), MAX_REMEMBERED["spaced"])

    def history(self, piece: int) -> tuple[bool, list[float], list[str], list[str]]:
        """How a piece's characters merge by themselves: whether they end as the
        piece, the score of every merge in turn (and the end), and the first and
        the last symbol before each."""
        held = self.histories.get(piece)
        if held is None:
            scores = self.vocabulary.scores
            symbols = list(self.vocabulary.names[piece])
            steps, firsts, lasts = [], [symbols[0]], [symbols[-1]]
            while True:
                best, at = END, -1
                for i in range(len(symbols) - 1):
                    score = scores.get(symbols[i] + symbols[i + 1], END)
                    if score > best:
                        best, at = score, i         # the leftmost of equal scores
                steps.append(best)
                if at < 0:
                    break
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
            held = self.histories[piece] = (len(symbols) == 1, steps, firsts, lasts)
        return held

    def fits(self, last: int, piece: int) -> bool:
        """Whether two neighbours, merged again from their characters, stay the
        two (``last`` -1: the piece alone).

        Both merge as they do alone, the better merge of either first and the
        left one of equals, until the two symbols at the boundary would merge
        before both."""
        pair = last << self.shift | piece
        held = self.pairs.get(pair)
        if held is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            held = self.pairs[pair] = self._again(last, piece)
        return held

    def _again(self, last: int, piece: int) -> bool:
        whole, right_steps, firsts, _ = self.history(piece)
        if last < 0 or not whole:
            return whole
        whole, left_steps, _, lasts = self.history(last)
        scores = self.vocabulary.scores
        i = j = 0
        while whole:
            left, right = left_steps[i], right_steps[j]
            across = scores.get(lasts[i] + firsts[j], END)
            if across > left and across >= right:
                return False
            if left == right == END:
                return True
            if left >= right:
                i += 1
            else:
                j += 1
        return False

    def look(self, text: str, longest: list[int], at: int) -> int:
        """The longest piece at a place of ``text``, noted in ``longest`` with
        those at the places that follow, up to one already known."""
        v = self.vocabulary
        for end, i in v.automaton.iter_long(text[at:at + 4 * v.longest]):
            start = end + 1 - v.lengths[i]
            if start > 3 * v.longest or longest[at + start] >= 0:
                break                               # cut off by the slice, or known
            longest[at + start] = i
        return longest[at]

    def run(self, text: str, longest: list[int], start: int, end: int, ids: list[int], at: int) -> list[int]:
        """Ids of ``text[start:end]``, all of whose characters are pieces; ``ids``
        are those up to ``at``, which hold so far."""
        lengths, shorter, known, fits = self.vocabulary.lengths, self.vocabulary.shorter, self.pairs.get, self.fits
        shift = self.shift
        failed = None                               # one bit per place
        last = ids[-1] if ids else -1
        piece = longest[at]
        while True:
            after = at + lengths[piece]
            if failed is None or not failed[after - start >> 3] >> (after - start & 7) & 1:
                holds = known(last << shift | piece)
                if holds or holds is None and fits(last, piece):
                    ids.append(piece)
                    if after == end:
                        return ids
                    at, last, piece = after, piece, longest[after]
                    if piece < 0:
                        piece = self.look(text, longest, at)
                    continue
            piece = shorter[piece]
            if piece < 0:                           # nothing holds here: one step back
                if failed is None:
                    failed = bytearray((end - start >> 3) + 1)
                failed[at - start >> 3] |= 1 << (at - start & 7)
                piece = ids.pop()
                at -= lengths[piece]
                last = ids[-1] if ids else -1

    def chunk(self, text: str) -> bytes:
        """Packed ids of normalized text, by backtracking between unknown characters."""
        v, known, fits, shift = self.vocabulary, self.pairs.get, self.fits, self.shift
        lengths = v.lengths
        found = list(v.automaton.iter_long(text))   # the longest pieces, one after the other
        ids: list[int] = []
        last, at = -1, 0
        for end, i in found:
            if end + 1 - at != lengths[i]:
                break                               # characters that are no piece
            holds = known(last << shift | i)
            if not holds and (holds is not None or not fits(last, i)):
                break
            ids.append(i)
            last, at = i, end + 1
        if at == len(text):                         # they hold as they are
            return array("I", ids).tobytes()
        longest = [-1] * len(text)
        runs: list[list[int]] = []                  # of characters that are pieces
        for end, i in found:
            start = end + 1 - lengths[i]
            longest[start] = i
            if runs and runs[-1][1] == start:
                runs[-1][1] = end + 1
            else:
                runs.append([start, end + 1])
        if runs == [[0, len(text)]]:
            return array("I", self.run(text, longest, 0, len(text), ids, at)).tobytes()
        ids, at = [], 0
        for start, end in [*runs, (len(text), len(text))]:
            ids += [v.byte_ids[b] for b in text[at:start].encode()]
            if start < end:
                ids += self.run(text, longest, start, end, [], start)
            at = end
        return array("I", ids).tobytes()

    def cut(self, text: str) -> bytes:
        """Packed ids of normalized text from one space mark to the next, cut
        further at the edges of its words."""
        words = self.vocabulary.words(text) if self.vocabulary.word_cuts else (text,)
        return b"".join(map(self.parts.__getitem__, words)) if len(words) > 1 else self.chunk(text)

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        plain = self.vocabulary.normalize(text) if text else ""
        if not plain:
            return b""
        if not self.vocabulary.cuts:
            return self.chunk(plain)
        head, *words = plain.split(SPACE)
        if "" in words:                             # more space marks go with the word after them
            marks, kept = "", []
            for word in words:
                if word:
                    kept.append(marks + word)
                    marks = ""
                else:
                    marks += SPACE
            words = [*kept, marks[1:]] if marks else kept
        out = b"".join(map(self.spaced.__getitem__, words))
        return self.cut(head) + out if head else out


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("corpus-one-each", _one_each)


class Decoder:
    """Turns ids back into text as the library's ``decode(ids)`` does."""

    def __init__(self, path: str) -> None:
        v = vocabulary(path)
        self.bytes = {i: b for b, i in enumerate(v.byte_ids)}
        self.names = [n.replace(SPACE, " ") for n in v.names]
        for i in v.control:
            self.names[i] = ""
        self.names[v.library.unk_id()] = v.library.decode([v.library.unk_id()])
        self.is_byte = np.zeros(len(self.names), dtype=bool)
        self.is_byte[v.byte_ids] = True
        self.plain_start = {v.library.unk_id(), *v.byte_ids}

    def text(self, ids: np.ndarray) -> str:
        found = ids.tolist()
        start = next((i for i in found if self.names[i]), None)
        if not self.is_byte[ids].any():
            out = "".join(map(self.names.__getitem__, found))
        else:
            parts, run = [], bytearray()
            for i in found:
                if i in self.bytes:
                    run.append(self.bytes[i])
                    continue
                if run:
                    parts.append(run.decode("utf-8", "corpus-one-each"))
                    run = bytearray()
                parts.append(self.names[i])
            parts.append(run.decode("utf-8", "corpus-one-each"))
            out = "".join(parts)
        # the space that normalization puts before a text goes
        return out[1:] if start is not None and start not in self.plain_start and out.startswith(" ") else out


@cache
def encoder(path: str) -> Encoder:
    """The worker's encoder for a model file."""
    return Encoder(path)


@cache
def decoder(path: str) -> Decoder:
    """The worker's decoder for a model file."""
    return Decoder(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           decoded: bool = False) -> DataFrame:
    """``(doc_id, ids)``: the ids of every whole text, without begin or end ids;
    with ``decoded`` also ``text``, what these ids decode to, in the same pass.

    Equal to the library's ``encode`` without sampling. Null and empty texts
    have no ids; characters that no piece has become their bytes. Repeated rows
    keep a row each; an empty table gives none. A text is cut before its space
    marks where the model's pieces allow it; chunks are remembered per worker up
    to a number of bytes, and longer ones are encoded each time.
    """
    path = model or vocabulary_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, back = encoder(path).packed, decoder(path).text
        for batch in batches:
            for b in pieces(batch):
                parts = [packed(t or "") for t in b.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
                flat = np.frombuffer(b"".join(parts), dtype="<i4")
                columns = [b.column(0), pa.ListArray.from_arrays(ends, pa.array(flat))]
                if decoded:
                    texts = [back(flat[a:z]) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    columns.append(pa.array(texts, pa.large_string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][:len(columns)])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, ids array<int>" + ", text string" * decoded)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """``(doc_id, ids, text)``: the text of every row's ids, as the library's ``decode``.

    Null ids count as none; no ids give an empty text. Byte pieces that are no
    UTF-8 give one replacement character each.
    """
    path = model or vocabulary_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = decoder(path).text
        for batch in batches:
            for b in pieces(batch):
                ids = b.column(1)
                flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
                texts = [text(flat[a:z]) for a, z in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array(texts, pa.large_string())],
                                                 names=["doc_id", "ids", "text"])

    narrow = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"),
                            F.coalesce(F.col(ids_col), F.array().cast("array<int>")).cast("array<int>").alias("ids"))
    return narrow.mapInArrow(run, "doc_id bigint, ids array<int>, text string")
