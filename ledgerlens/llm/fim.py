"""Fill-in-middle transformation by a compressed set of token boundaries.

A text is cut into units (runs of ASCII letters, and every other character by
itself). The code point offsets of the unit boundaries are a set of integers
that is stored as containers over 65,536 offsets each: a sorted array, a bitmap
or runs, whichever is smallest, with the cardinalities of all earlier
containers beside them. The n-th boundary is found by a search over the
cumulative cardinalities and a select inside one container.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces

SEED = 1
TRANSFORMED_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

CONTAINER_BITS = 16
BITMAP_BYTES = (1 << CONTAINER_BITS) // 8


class ArrayContainer:
    """Sorted 16-bit offsets."""

    def __init__(self, low: np.ndarray) -> None:
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per offset."""

    def __init__(self, low: np.ndarray) -> None:
        flags = np.zeros(1 << CONTAINER_BITS, dtype=np.uint8)
        flags[low] = 1
        self.words = np.packbits(flags, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        w = int(np.searchsorted(self.upto, k, side="right"))
        word = int(self.words[w])
        for _ in range(k - (int(self.upto[w - 1]) if w else 0)):
            word &= word - 1                       # drop the lowest bit set
        return w * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Runs of consecutive offsets: start of each, and offsets up to its end."""

    def __init__(self, low: np.ndarray, heads: np.ndarray) -> None:
        self.starts = low[heads].astype(np.uint16)
        self.upto = np.append(heads[1:], len(low)).astype(np.int64)

    def select(self, k: int) -> int:
        r = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.starts[r]) + k - (int(self.upto[r - 1]) if r else 0)


class BoundarySet:
    """A set of offsets in containers, for select by rank."""

    def __init__(self, offsets: np.ndarray) -> None:
        """``offsets``: ascending, without repeats."""
        high = offsets >> CONTAINER_BITS
        cuts = np.flatnonzero(np.diff(high)) + 1
        starts = [0, *cuts.tolist()] if len(offsets) else []
        self.before = starts                       # cardinality of all earlier containers
        self.size = len(offsets)
        self.bases: list[int] = []
        self.containers: list[ArrayContainer | BitmapContainer | RunContainer] = []
        for a, b in zip(starts, [*starts[1:], self.size]):
            self.bases.append(int(high[a]) << CONTAINER_BITS)
            self.containers.append(self._container(offsets[a:b] - self.bases[-1]))

    @staticmethod
    def _container(low: np.ndarray):
        heads = np.append(0, np.flatnonzero(np.diff(low) != 1) + 1)
        as_array, as_runs = 2 * len(low), 4 * len(heads)
        if as_runs < min(as_array, BITMAP_BYTES):
            return RunContainer(low, heads)
        return ArrayContainer(low) if as_array <= BITMAP_BYTES else BitmapContainer(low)

    def select(self, k: int) -> int:
        """The offset of rank ``k`` (0 for the smallest)."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        c = bisect_right(self.before, k) - 1
        return self.bases[c] + self.containers[c].select(k - self.before[c])


def boundaries(text: str) -> BoundarySet:
    """Offsets of the unit boundaries of a text: 0, the end, and all between."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    letter = ((codes | 32) - np.uint32(97)) < 26
    cut = np.ones(len(codes) + 1, dtype=bool)
    cut[1:-1] = ~(letter[1:] & letter[:-1])
    return BoundarySet(np.flatnonzero(cut))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers fixed by seed and id (a null id counts as no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def arrange(doc_id: int | None, text: str, seed: int = SEED, transformed: int = TRANSFORMED_PERCENT,
            suffix_first: int = SUFFIX_FIRST_PERCENT) -> tuple[int, str, int | None, int | None, str]:
    """``(units, form, prefix_chars, middle_chars, output)`` of one text."""
    cuts = boundaries(text)
    n = cuts.size - 1
    h = draws(doc_id, seed)
    if not text or h[2] % 100 >= transformed or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = (cuts.select(k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              transformed: int = TRANSFORMED_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for every row.

    ``n`` counts units; both cuts lie on unit boundaries, chosen by the id and
    ``seed`` alone. ``output`` is the text to train on: ``plain`` as it is,
    ``psm`` prefix-suffix-middle, ``spm`` suffix-prefix-middle, after markers.
    Null texts count as empty; empty texts and texts that hold a marker stay
    plain. Rows of one id and text give equal rows; an empty table gives none.
    One text is held at a time, with its boundary set.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string())
        for batch in batches:
            for b in pieces(batch):
                rows = [arrange(i, t or "", seed, transformed, suffix_first)
                        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(
        run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(form: Column, output: Column) -> Column:
    """The text that an output of :func:`transform` was made of.

    The markers are in no transformed text, so each cuts the output once."""
    cut = F.split(output, "|".join(re.escape(m) for m in (PREFIX, SUFFIX, MIDDLE)), -1)
    return (F.when(form == "psm", F.concat(cut[1], cut[3], cut[2]))
            .when(form == "spm", F.concat(cut[2], cut[3], cut[1])).otherwise(output))


#: DuckDB SQL of the registered query.
SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || cast(doc_id as varchar)) as h from documents),
u as (
  select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as w,
         cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
         cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from d),
k as (
  select doc_id, t, w, len(w) as n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) as a,
         greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90
              then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from u),
p as (
  select doc_id, t, n, form, array_to_string(w[1:a], '') as prefix, array_to_string(w[a + 1:b], '') as middle,
         array_to_string(w[b + 1:], '') as suffix
  from k)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p"""
