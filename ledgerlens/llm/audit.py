"""Source divergence audit: how far the word use of sources lies apart.

Per language, every pair of sources is compared over all kept terms by a
scaled divergence of smoothed term shares, and every source lists the terms
it uses more than its language does. A share depends on nothing but a term's
count in the group, so terms of one count are one level: each (group, count)
has a bitset over term ids. The joint cells of two groups are the popcounts of
the AND of their levels, each weighted once by the divergence of its two
shares; cells with a zero count follow by complement from the level sizes.
All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import gapless_rank, materialize, pieces, utf8

MIN_DOCS = 3
TOP_TERMS = 200
SCALE_STEPS = 3                   # shares are scaled by 1000 ** SCALE_STEPS
#: What a task holds before it passes its counts on: distinct terms, bytes of text.
HELD_TERMS = 400_000
HELD_BYTES = 64 << 20
WORD_BITS = 64                    # term ids per word of a bitset
BLOCK_WORDS = 4                   # words compared in one group of rows
TILE_SOURCES = 64                 # sources compared in one group of rows, about
CELL_ROWS = 256                   # levels ANDed with all others at once
SALTS = 8
#: Text bytes of the group table that are broadcast; beyond it the joins shuffle.
MAX_GROUP_BYTES = 16 << 20

#: Byte map of terms: ASCII letters in lower case and every byte of a non-ASCII
#: character stay; all else separates terms.
_MAP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text."""
    return text.translate(_MAP).split()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of every term per group.

    A group has one more row, of null term, that stands for the group itself.
    Counted in the tasks (a bounded number of terms at a time), then summed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        seen = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, documents) in held.items():
                rows = [(None, 0, 0), *((t, n, documents[t]) for t, n in counts.items())]
                for i in range(0, len(rows), 10_000):
                    term, n, d = zip(*rows[i:i + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n)), pa.array([source] * len(n)),
                         pa.array(term, pa.binary()).cast(pa.string()),
                         pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for b in pieces(batch, 1 << 20):
                for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                    counts, documents = held.setdefault((lang, source), (Counter(), Counter()))
                    words = terms(text)
                    counts.update(words)
                    documents.update(set(words))
                    seen += len(text)
                    if seen > HELD_BYTES:
                        yield from flush()
                        seen = 0
                if sum(len(c) for c, _ in held.values()) > HELD_TERMS:
                    yield from flush()
                    seen = 0
        yield from flush()

    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
             for c, n in ((lang_col, "lang"), (source_col, "source"))]
    found = docs.select(*blank, F.col(text_col).alias("text")).mapInArrow(
        run, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """``1 + floor(10**9 * (count + 1) / total)``, by long division in base 1000.

    ``total`` is the group's count of all kept terms plus their number; exact
    for totals below 9 * 10**15."""
    total = F.nullif(total, F.lit(0).cast("bigint"))
    rest = count + 1
    out = F.call_function("div", rest, total)
    rest = rest % total
    for _ in range(SCALE_STEPS):
        out = out * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return out + 1


def _cell(p: Column, q: Column) -> Column:
    """f: the weight of a cell of shares p and q."""
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _joint(key: tuple, rows: pa.Table) -> pa.Table:
    """Joint cells of the levels of two tiles in one block of term ids.

    Per ordered pair of sources, the sum over the cells with both counts above
    zero of ``n * (f(c, d) - f(c, 0) - f(0, d) + f(0, 0))``: what those terms
    add to the sum that takes each group's zero count for all others.
    """
    lang, _, ta, tb = (k.as_py() for k in key)
    sources = rows["source"].combine_chunks().dictionary_encode()
    names = sources.dictionary.to_pylist()
    g = sources.indices.to_numpy()
    tile, word, bits, p, p0 = (rows[c].to_numpy() for c in ("tile", "word", "bits", "p", "p0"))
    order = np.argsort(word, kind="stable")
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    for at in np.split(order, np.flatnonzero(np.diff(word[order])) + 1):
        left, right = at[tile[at] == ta], at[tile[at] == tb]
        for i in range(0, len(left), CELL_ROWS):
            a = left[i:i + CELL_ROWS]
            both = bits[a][:, None] & bits[right][None, :]
            x, y = np.nonzero(both)
            n = np.bitwise_count(both[x, y].view(np.uint64)).astype(np.int64)
            x, y = a[x], right[y]
            apart = g[x] != g[y]
            x, y, n = x[apart], y[apart], n[apart]
            for u, v in ((x, y), (y, x)) if ta != tb else ((x, y),):
                weight = _f(p[u], p[v]) - _f(p[u], p0[v]) - _f(p0[u], p[v]) + _f(p0[u], p0[v])
                np.add.at(sums, (g[u], g[v]), n * weight)
    a, b = np.nonzero(sums)
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()),
                     "source": pa.array([names[i] for i in a], pa.string()),
                     "item": pa.array([names[i] for i in b], pa.string()),
                     "value": pa.array(sums[a, b], pa.int64())})


def _top(rows: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` largest values per group with their rank, through salted
    rankings: the last one of a group gets at most ``SALTS * limit`` rows."""
    def first(part: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy("lang", "source", *keys).orderBy(F.desc("value"), "item")
        return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)

    salted = rows.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)))
    return first(first(salted, "salt").drop("rank", "salt"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every (lang, source) group.

    Part ``pair`` has one row per other source of the language: the sum over
    all kept terms of ``f = (p - q) ** 2 // q`` of the shares in the two
    groups. Part ``term`` has the ``top`` terms that a group uses more than its
    language, by the same f. Ranks go by value descending, then item.

    Null texts, languages and sources count as empty. A term is kept if at
    least ``min_docs`` rows of its language have it; repeated rows count each.
    Groups without a kept term have equal shares for all; a language without
    kept terms gives pairs of value 0. Empty tables give no rows. The number of
    pairs is the square of a language's sources; nothing else grows so.
    """
    counted = materialize(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    total = (counted.where("term is not null").groupBy("lang", "term")
             .agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
             .select("lang", "term", "all", (-F.col("all")).alias("order")))
    # ids by frequency: terms of similar counts share a word of the bitsets
    ranked = gapless_rank(total, "lang", ["order", "term"], "id").select("lang", "term", "all", "id")
    kept = materialize(counted.where("n > 0").join(ranked, ["lang", "term"])
                       .select("lang", "source", "term", "n", "all", "id"), "kept-terms")

    langs = kept.select("lang", "term", "all").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("all").alias("lang_n"))
    groups = (counted.where("term is null").select("lang", "source")
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left")
              .join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("terms", F.lit(0)).cast("bigint").alias("terms"),
                      (F.coalesce("group_n", F.lit(0)) + F.coalesce("terms", F.lit(0))).cast("bigint").alias("size"),
                      (F.coalesce("lang_n", F.lit(0)) + F.coalesce("terms", F.lit(0))).cast("bigint").alias("lang_size")))
    groups = materialize(groups.withColumn("p0", share(F.lit(0).cast("bigint"), F.col("size"))), "groups")
    tiles = F.ceil(F.count(F.lit(1)) / TILE_SOURCES).cast("int")
    split = groups.join(groups.groupBy("lang").agg(tiles.alias("tiles")), "lang")
    split = materialize(split.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")), "tiles")
    bytes_of = split.agg(F.sum(F.octet_length("lang") + F.octet_length("source") + 64)).first()[0] or 0
    sized = F.broadcast if bytes_of <= MAX_GROUP_BYTES else (lambda d: d.hint("merge"))

    # part term
    p = share(F.col("n"), F.col("size"))
    q = share(F.col("all"), F.col("lang_size"))
    more = (kept.join(sized(split), ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
            .where("p > q").select("lang", "source", "item", _cell(F.col("p"), F.col("q")).alias("value")))
    found = _top(more, top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    # part pair: the stored levels, a word of a bitset per row
    levels = (kept.groupBy("lang", "source", "n", F.shiftright("id", 6).alias("word"))
              .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                            (F.col("id") % WORD_BITS).cast("int"))).alias("bits")))
    levels = materialize(levels.join(sized(split), ["lang", "source"])
                         .select("lang", "source", "word", "bits", "n", p.alias("p"), "p0", "tile", "tiles"),
                         "level-bitsets")
    meet = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1),
                       lambda t: F.struct(F.least(t, "tile").alias("ta"), F.greatest(t, "tile").alias("tb")))
    joint = (levels.withColumn("block", F.floor(F.col("word") / BLOCK_WORDS))
             .select("lang", "source", "word", "bits", "p", "p0", "tile", "block", F.inline(meet))
             .groupBy("lang", "block", "ta", "tb")
             .applyInArrow(_joint, "lang string, source string, item string, value bigint"))

    # zeros by complement: a level against the zero count of every other group
    sizes = levels.groupBy("lang", "source", "p", "p0").agg(F.sum(F.bit_count("bits")).alias("n"))
    other = split.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), "terms")
    against = sizes.join(sized(other), "lang").where("source != item")
    zero = _cell(F.col("p0"), F.col("q0")), _cell(F.col("q0"), F.col("p0"))
    level = against.select("lang", F.inline(F.array(
        F.struct("source", "item", (F.col("n") * (_cell(F.col("p"), F.col("q0")) - zero[0])).alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"),
                 (F.col("n") * (_cell(F.col("q0"), F.col("p")) - zero[1])).alias("value")))))
    every = (split.select("lang", "source", "p0").join(sized(other), "lang").where("source != item")
             .select("lang", "source", "item", F.coalesce(F.col("terms") * zero[0], F.lit(0)).alias("value")))
    pairs = (every.unionByName(level).unionByName(joint).groupBy("lang", "source", "item")
             .agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(order).alias("rank"))
    return pairs.unionByName(found)


#: DuckDB SQL of the registered query.
SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
t as (select r, lang, source, unnest(w) as term from d),
kept as (select lang, term, cast(count(*) as hugeint) as n from t group by lang, term having count(distinct r) >= 3),
langs as (select lang, cast(count(*) as hugeint) as v, sum(n) as ln from kept group by lang),
counts as (select lang, source, term, cast(count(*) as hugeint) as n from t semi join kept using (lang, term)
           group by lang, source, term),
groups as (select lang, source, coalesce(v, 0) as v, coalesce(ln, 0) as ln, coalesce(gn, 0) as gn
           from (select distinct lang, source from d) left join langs using (lang)
           left join (select lang, source, sum(n) as gn from counts group by lang, source) using (lang, source)),
shares as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
                  1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.gn + g.v) as p,
                  1 + (1000000000::hugeint * (k.n + 1)) // (g.ln + g.v) as q
           from groups g join kept k on k.lang = g.lang
           left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
cells as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
          from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
          group by a.lang, a.source, b.source),
pairs as (select a.lang, a.source, b.source as item, coalesce(c.value, 0) as value
          from groups a join groups b on a.lang = b.lang and a.source <> b.source
          left join cells c on c.lang = a.lang and c.source = a.source and c.item = b.source),
more as (select lang, source, term as item, ((p - q) * (p - q)) // q as value from shares where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value,
         row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all
  select * from (select lang, source, 'term' as part, item, value,
                        row_number() over (partition by lang, source order by value desc, item) as rank from more)
  where rank <= 200)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked"""
