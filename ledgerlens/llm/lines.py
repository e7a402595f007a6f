"""Line dedup by winnowing, on built-in functions only.

A window is a minimal run of consecutive lines with at least ``min_words``
words (lines without a word do not count). Every window selects the line with
the smallest hash as its fingerprint; equal runs that hold a window select
equal fingerprints, so runs can only match where fingerprints do; that leaves
out the other windows. Matches are not extended line by line: each line has the
window that starts at it and the one that ends at it, compared by a key of their
whole content, and a run of lines whose window occurred earlier is deleted.
Together these windows cover exactly the lines
that lie in some run of ``min_words`` words or more with an earlier copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize

MIN_WORDS = 50
_WORD = r"[^\\x20\\x09-\\x0D]+"


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Windows of every document of ``docs`` (columns ``id, h, text``).

    Columns: ``id, h``; ``first, last`` (places among the lines with a word);
    ``p_first, p_last`` (line numbers); ``seed`` (smallest line hash), ``at``
    (its place); ``k1, k2`` (128-bit content key). A window has at most
    ``min_words`` lines, so the work per line is bounded, however long the text.
    """
    m = int(min_words)
    # inline() of one row keeps each array a computed column: a plain
    # projection would be repeated inside every later lambda
    lines = docs.selectExpr("id", "h as doc_hash", f"""inline(array(struct(
        filter(transform(split(coalesce(text, ''), '\\n', -1), (l, i) -> struct(
            i as p, xxhash64(l) as h, xxhash64(7, l) as g, regexp_count(l, '{_WORD}') as w)),
            x -> x.w > 0) as u)))""").where("size(u) > 0")
    arrays = lines.selectExpr("id", "doc_hash",
                              "inline(array(struct(u.p as p, u.h as h, u.g as g, u.w as w)))")
    step = f"(a, x) -> if(a.t >= {m}, a, struct(a.t + x as t, a.k + 1 as k))"
    start = "struct(0 as t, 0 as k)"
    # forward: shortest run from line s; backward: shortest run to line s, where it
    # is not a forward window as well (that is, without its last line it is still long enough)
    forward = f"""transform(sequence(1, size(w)), s -> if(w[s - 1] >= {m},
        struct(s as first, 1 as n),
        aggregate(slice(w, s, {m}), {start}, {step}, a -> struct(s as first, if(a.t >= {m}, a.k, 0) as n))))"""
    backward = f"""transform(sequence(1, size(w)), s -> if(w[s - 1] >= {m},
        struct(s as first, 0 as n),
        aggregate(reverse(slice(w, greatest(1, s - {m - 1}), least(s, {m}))), {start}, {step},
            a -> struct(s - a.k + 1 as first, if(a.t - w[s - 1] >= {m}, a.k, 0) as n))))"""
    spans = arrays.selectExpr("id", "doc_hash", "p", "h", "g",
                              f"inline(filter(concat({forward}, {backward}), x -> x.n > 0))")
    seeded = spans.selectExpr("id", "doc_hash", "first", "first + n - 1 as last", "p", "h", "g", "n",
                              "array_min(slice(h, first, n)) as seed")
    return seeded.selectExpr(
        "id", "doc_hash as h", "first", "last", "p[first - 1] as p_first", "p[last - 1] as p_last", "seed",
        "cast(array_position(slice(h, first, n), seed) as int) + first - 1 as at",
        "xxhash64(slice(h, first, n)) as k1", "xxhash64(slice(g, first, n)) as k2")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, h, runs)``: line ranges to delete per document, sorted and disjoint.

    The earliest occurrence of a run, by id, text hash and line, stays. Every
    occurrence is compared with the first one only, never with each other.
    """
    found = materialize(windows(docs, min_words), "line-windows")
    place = F.xxhash64("id", "h", "at")
    seeds = (found.groupBy("seed").agg(F.min(place).alias("a"), F.max(place).alias("b"))
             .where("a != b").select("seed"))
    # merge joins at any size: the plan that large inputs need, and whose
    # partitions adaptive execution splits
    matched = found.join(materialize(seeds, "line-seeds").hint("merge"), "seed", "left_semi")
    matched = materialize(matched.select("id", "h", "first", "last", "p_first", "p_last", "k1", "k2"),
                          "line-matches")
    occurrence = F.struct("id", "h", "first", "last")
    firsts = (matched.groupBy("k1", "k2").agg(F.min(occurrence).alias("o"), F.max(occurrence).alias("z"))
              .where("o != z").select("k1", "k2", "o"))
    both = matched.join(materialize(firsts, "line-firsts").hint("merge"), ["k1", "k2"])
    same_doc = F.col("id").eqNullSafe(F.col("o.id")) & (F.col("h") == F.col("o.h"))
    # a copy that overlaps the first occurrence in its own document loses the rest only
    later = both.where(~(same_doc & (F.col("first") == F.col("o.first")))).select(
        "id", "h", "p_first", "p_last", "first", "last", same_doc.alias("same"), F.col("o.last").alias("o_last"))
    whole = later.where(~F.col("same") | (F.col("first") > F.col("o_last"))).select("id", "h", "p_first", "p_last")
    partly = later.where(F.col("same") & (F.col("first") <= F.col("o_last")) & (F.col("last") > F.col("o_last")))
    ends = matched.select("id", "h", F.col("last").alias("o_last"), F.col("p_last").alias("o_p_last")).distinct()
    # (id, h) repeat and compress well, so the planner takes these rows for a tenth of what they hold
    partly = (partly.join(ends.hint("merge"), partly.id.eqNullSafe(ends.id) & (partly.h == ends.h)
                          & (partly.o_last == ends.o_last))
              .select(partly.id, partly.h, (F.col("o_p_last") + 1).alias("p_first"), "p_last"))
    runs = whole.unionAll(partly).distinct()
    in_doc = Window.partitionBy("id", "h").orderBy("p_first", "p_last")
    before = in_doc.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("new", F.coalesce(F.col("p_first") > F.max("p_last").over(before) + 1, F.lit(True)))
    runs = runs.withColumn("run", F.sum(F.col("new").cast("int")).over(in_doc))
    merged = runs.groupBy("id", "h", "run").agg(F.min("p_first").alias("a"), F.max("p_last").alias("b"))
    return merged.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS, runs_col: str | None = "_ll_runs") -> DataFrame:
    """``docs`` without later repeated runs, plus ``runs_col`` (deleted line ranges).

    Every row stays, its text may become empty; null texts stay null. Rows
    that repeat both id and text are one document and keep the same lines.
    Runs are compared across and inside documents; null ids sort first. The
    text is joined with the ranges by (id, text hash): one shuffle of the
    rows, none of whose keys adaptive execution cannot split. A column of the
    input named ``runs_col`` is replaced; with None the ranges are left out and
    all columns of the input stay.
    """
    i, h, r = (free_name(docs, n) for n in ("_ll_id", "_ll_hash", "_ll_ranges"))
    keyed = docs.withColumn(i, F.col(id_col)).withColumn(h, F.xxhash64(F.col(text_col)))
    slim = keyed.select(F.col(i).alias("id"), F.col(h).alias("h"), F.col(text_col).alias("text"))
    runs = materialize(repeated_runs(slim, min_words), "line-runs").hint("merge")
    joined = keyed.join(runs, keyed[i].eqNullSafe(runs["id"]) & (keyed[h] == runs["h"]), "left")
    out = joined.select(*[keyed[c] for c in docs.columns], runs["runs"].alias(r))
    quoted = f"`{text_col}`"
    pieces = f"""flatten(transform(sequence(0, size({r})), i -> slice(split({quoted}, '\\n', -1),
        if(i = 0, 0, {r}[i - 1].b + 1) + 1,
        if(i = size({r}), size(split({quoted}, '\\n', -1)), {r}[i].a)
            - if(i = 0, 0, {r}[i - 1].b + 1))))"""
    kept = F.expr(f"if({r} is null, {quoted}, array_join({pieces}, '\\n'))")
    out = out.withColumn(text_col, kept)
    return out.drop(r) if runs_col is None else out.withColumn(runs_col, F.col(r)).drop(r)


#: DuckDB SQL of the registered query.
SQL = r"""
with l as (
  select doc_id, pos - 1 as p, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as w
  from (select doc_id, unnest(string_split(text, chr(10))) as line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) as pos from documents)),
u as (select *, row_number() over (partition by doc_id order by p) as u,
             sum(w) over (partition by doc_id order by p) as c from l where w > 0),
spans as (
  select a.doc_id, a.u as s, min(b.u) as e
  from u a join u b on a.doc_id = b.doc_id and b.u between a.u and a.u + 49 and b.c >= a.c - a.w + 50 group by all
  union
  select b.doc_id, max(a.u), b.u
  from u a join u b on a.doc_id = b.doc_id and a.u between b.u - 49 and b.u and b.c >= a.c - a.w + 50
  group by b.doc_id, b.u),
content as (select doc_id, s, e, string_agg(line, chr(10) order by u) as k
            from spans join u using (doc_id) where u between s and e group by all),
ranked as (select doc_id, s, e, first_value(doc_id) over o as fd, first_value(s) over o as fs,
                  first_value(e) over o as fe
           from content window o as (partition by k order by doc_id, s)),
gone as (select doc_id, doc_id = fd and s <= fe as clipped, case when clipped then fe else s end as s, e
         from ranked where not (doc_id = fd and s = fs)),
ranges as (select gone.doc_id, x.p + cast(clipped as int) as a, y.p as b
           from gone join u x on x.doc_id = gone.doc_id and x.u = gone.s
           join u y on y.doc_id = gone.doc_id and y.u = gone.e),
dead as (select distinct l.doc_id, l.p from l join ranges r on l.doc_id = r.doc_id and l.p between r.a and r.b)
select l.doc_id, count(*) as n_lines, count(dead.p) as n_deleted,
       coalesce(string_agg(l.line, chr(10) order by l.p) filter (dead.p is null), '') as text
from l left join dead using (doc_id, p) group by l.doc_id"""
