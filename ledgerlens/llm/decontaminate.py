"""Benchmark decontamination with an Aho-Corasick automaton.

The patterns are the windows of the test items' normalised words; every text
is normalised and scanned once, and hits are mapped back to offsets in the
original text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, pieces, utf8

WINDOW_WORDS = 10
#: Bytes of patterns and item ids in one automaton (about 50 bytes of memory
#: each). A benchmark with more windows is scanned for in several blocks.
BLOCK_CHARS = 4 << 20

#: Byte map of the normalisation: A-Z to a-z; digits, a-z and every byte of a
#: non-ASCII character stay; all else separates words.
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
             for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_SPANS = "array<struct<start:int,end:int,first_word:int,last_word:int>>"
_HITS = f"row bigint, doc_id bigint, n_words bigint, spans {_SPANS}, items array<string>"
_ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "end", "first_word", "last_word")]))),
    ("items", pa.list_(pa.string())),
])


def words(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_MAP).split()


def windows(text: bytes, size: int = WINDOW_WORDS) -> set[bytes]:
    """Distinct windows of ``size`` words; fewer words, but not none: one window."""
    w = words(text)
    if not w:
        return set()
    return {b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def patterns(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
             size: int = WINDOW_WORDS) -> DataFrame:
    """Distinct ``(pattern, item)`` rows of the test items; ids as strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, 1 << 20):
                rows = [(w, i) for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1)))
                        for w in windows(t, size)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=k) for c, k in zip(zip(*rows), (pa.binary(), pa.string()))],
                        names=["pattern", "item"])

    narrow = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "pattern binary, item string").distinct()


class _Scanner:
    """The automaton of one block of patterns."""

    def __init__(self, rows: list[tuple[bytes, str | None]]) -> None:
        items: dict[bytes, set[str]] = {}
        for pattern, item in rows:
            items.setdefault(bytes(pattern), set()).update(() if item is None else (item,))
        self.automaton = ahocorasick.Automaton()
        for pattern, ids in items.items():
            self.automaton.add_word(f" {pattern.decode('latin-1')} ",
                                    (len(pattern) + 2, pattern.count(b" ") + 1, tuple(ids)))
        if items:
            self.automaton.make_automaton()
        self.empty = not items

    def scan(self, text: bytes) -> tuple[int, list[dict], list[str]]:
        """Words of the text, merged hit spans, and the items that occur."""
        w = words(text)
        if self.empty or not w:
            return len(w), [], []
        line = f" {b' '.join(w).decode('latin-1')} "
        runs: list[list[int]] = []
        found: set[str] = set()
        at = word = 0
        hits = sorted((end + 1 - length, count, ids) for end, (length, count, ids) in self.automaton.iter(line))
        for start, count, ids in hits:
            word += line.count(" ", at, start)
            at = start
            if runs and word < runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], word + count)
            else:
                runs.append([word, word + count])
            found.update(ids)
        return len(w), _spans(text, runs), sorted(found)


def _spans(text: bytes, runs: list[list[int]]) -> list[dict]:
    """Word ranges as code point offsets of the original text."""
    if not runs:
        return []
    need = sorted({a for a, _ in runs} | {b - 1 for _, b in runs})
    places: dict[int, tuple[int, int]] = {}
    chars = done = k = 0
    for i, m in enumerate(_WORD.finditer(text)):
        if i == need[k]:
            start = chars + len(text[done:m.start()].decode())
            end = start + len(m.group().decode())
            places[i], chars, done = (start, end), end, m.end()
            k += 1
            if k == len(need):
                break
    return [{"start": places[a][0], "end": places[b - 1][1], "first_word": a, "last_word": b - 1}
            for a, b in runs]


_SCANNERS: dict[str, _Scanner] = {}


def _scanner(block: Broadcast) -> _Scanner:
    """The worker's automaton for a broadcast ``(name, rows)``; only the latest is kept."""
    name, rows = block.value
    if name not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[name] = _Scanner(rows)
    return _SCANNERS[name]


def _scan(texts: DataFrame, block: Broadcast, hits_only: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(block)
        for batch in batches:
            for b in pieces(batch):
                rows = [(r, i, *scanner.scan(t)) for r, i, t in
                        zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)))]
                if hits_only:
                    rows = [x for x in rows if x[3]]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return texts.mapInArrow(run, _HITS)


def _merge(parts: DataFrame) -> DataFrame:
    """Spans and items of one row from several blocks, made one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                spans: list[dict] = []
                for s in sorted((s for part in x["spans"] for s in part),
                                key=lambda s: (s["first_word"], s["last_word"])):
                    if spans and s["first_word"] <= spans[-1]["last_word"]:
                        if s["last_word"] > spans[-1]["last_word"]:
                            spans[-1] |= {"end": s["end"], "last_word": s["last_word"]}
                    else:
                        spans.append(dict(s))
                rows.append((x["row"], x["doc_id"], x["n_words"], spans,
                             sorted({i for part in x["items"] for i in part})))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    grouped = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    return grouped.mapInArrow(run, _HITS)


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, size: int,
            block_chars: int) -> list[DataFrame]:
    """The ``(pattern, item)`` rows in blocks of about ``block_chars`` bytes.

    The rows are ordered and cut where their running size passes a multiple of
    the bound, so no block is empty or larger than the bound and one row; the
    items of one pattern may lie in several blocks. The running size comes from
    range partitions and the sum of each, so nothing is gathered."""
    rows = patterns(benchmark, item_col, item_text_col, size).withColumn(
        "size", (F.octet_length("pattern") + F.coalesce(F.octet_length("item"), F.lit(0))).cast("bigint"))
    rows = (rows.repartitionByRange("pattern", "item").sortWithinPartitions("pattern", "item")
            .withColumn("part", F.spark_partition_id()))
    rows = materialize(rows, "benchmark-windows")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("size").alias("all"))     # one row per range partition
    parts = parts.select("part", F.coalesce(F.sum("all").over(before.orderBy("part")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("size").over(before.partitionBy("part").orderBy("pattern", "item")), F.lit(0))
    placed = rows.withColumn("inside", inside).join(F.broadcast(parts), "part")
    cut = placed.select("pattern", "item", F.floor((F.col("base") + F.col("inside")) / block_chars).alias("block"))
    cut = materialize(cut, "benchmark-blocks")
    numbers = sorted(r["block"] for r in cut.select("block").distinct().collect()) or [0]
    return [cut.where(F.col("block") == i).select("pattern", "item") for i in numbers]


def _sent(block: DataFrame) -> Broadcast:
    """A block of patterns, broadcast under a name of its own."""
    rows = [tuple(r) for r in block.collect()]
    return block.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       size: int = WINDOW_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(row, doc_id, n_words, spans, items)`` for every row of ``docs``.

    ``spans`` are the runs of hit words as code point offsets ``start, end`` of
    the original text and as word numbers ``first_word, last_word``; ``items``
    are the test items (ids as strings) with a window in the text. Null and
    empty texts have no words and no hits; null or empty items have no
    windows; an item of null id still marks words but is not listed. ``row``
    tells rows of one id apart. Empty tables give no rows, or no hits.

    The patterns of one block are broadcast: at most ``block_chars`` bytes and
    one row, measured first, whatever pattern many items share. Larger benchmarks
    are scanned block by block against all texts; the first pass gives the word
    counts too, and of the others only rows with hits are kept.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, size, block_chars)
    texts = docs.select(F.monotonically_increasing_id().alias("row"),
                        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if len(blocks) == 1:
        return _scan(texts, _sent(blocks[0]), hits_only=False)
    texts = materialize(texts, "scanned-texts")     # the same row numbers for every block
    passes = []
    for block in blocks:
        sent = _sent(block)
        passes.append(materialize(_scan(texts, sent, hits_only=bool(passes)), "block-hits"))
        sent.destroy()
    plain = passes[0].select("row", "doc_id", "n_words")
    hits = reduce(DataFrame.unionAll, passes).where(F.size("spans") > 0)
    merged = _merge(hits).select("row", "spans", "items")
    empty = [F.coalesce(c, F.array().cast(k)).alias(c) for c, k in (("spans", _SPANS), ("items", "array<string>"))]
    return plain.join(merged, "row", "left").select("row", "doc_id", "n_words", *empty)


def _hit(sent: Broadcast):
    """Column function: does a window of the block occur in the text?"""
    @F.pandas_udf(T.BooleanType())
    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = _scanner(sent)
        for texts in batches:
            yield pd.Series([t is not None and bool(scanner.scan(t)[1]) for t in texts], dtype=bool)

    return hit


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text",
                        size: int = WINDOW_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no window of a test item occurs.

    Decided row by row, without a join; with several blocks of patterns, what
    one block leaves is written before the next is scanned for.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, size, block_chars)
    for i, block in enumerate(blocks):
        sent = _sent(block)
        docs = docs.where(~_hit(sent)(F.col(text_col).cast("binary")))
        if i + 1 < len(blocks):
            docs = materialize(docs, "clean-so-far")
            sent.destroy()
    return docs


def digest(found: DataFrame) -> DataFrame:
    """Counts per row of :func:`find_contamination`'s result."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"),
                        lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


#: DuckDB SQL of the digest.
SQL = r"""
with d as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents),
b as (
  select item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
bw as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(w[i:i + 9], ' ') as p
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
lengths as (select distinct k from bw),
dw as (
  select r, i, k, array_to_string(w[i:i + k - 1], ' ') as p
  from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from d, lengths where len(w) >= k)),
hits as (select r, i, dw.k, item_id from dw join bw using (k, p)),
hit_words as (
  select r, count(distinct x) as n_hit
  from (select r, unnest(range(i, i + k)) as x from (select distinct r, i, k from hits)) group by r),
hit_items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct r, cast(item_id as varchar) as item from hits where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (r) left join hit_items using (r)"""
