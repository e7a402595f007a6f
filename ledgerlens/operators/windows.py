"""Window operators written to survive hot partitions.

A window partitioned by one key sends every row of that key to one task. The
operators here keep that bounded:

* ``running_count`` pre-aggregates rows that share (partition, order value)
  before the window, so copies of a row cost one window row.
* ``bucketed_lag`` splits each partition into order-preserving buckets and
  takes the lag inside each bucket; the last value of every bucket is carried
  to the head of the next one through a table with one row per bucket. A key
  holding a third of all rows is spread over as many tasks as it has buckets,
  and the large side is shuffled once.
* ``bucket_cuts`` finds, by a sample of the total order, the buckets with too
  many rows and where to cut them, so that a bucket is bounded by rows and not
  by its span of time (a busy hour, rows without a timestamp).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_count(df: DataFrame, partition_cols: Sequence[str], order_col: str,
                  out_col: str = "running_count", weight_col: str = "n",
                  count: Column | None = None) -> DataFrame:
    """Count of rows with order value <= the current one inside each partition.

    This is ``count(*) OVER (PARTITION BY p ORDER BY o)`` with the default
    RANGE frame (peers share a count), returned once per distinct
    ``(p, o)`` with ``weight_col`` = number of rows carrying it. ``count`` is the
    aggregate that counts rows, if a row stands for several. A ``df`` that is
    partitioned by (some of) the partition columns is not shuffled again.
    """
    keys = [*partition_cols, order_col]
    grouped = df.groupBy(*keys).agg((F.count(F.lit(1)) if count is None else count).alias(weight_col))
    w = (Window.partitionBy(*partition_cols).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return grouped.withColumn(out_col, F.sum(weight_col).over(w))


KEY, BUCKET, PART = "__key", "__bucket", "__part"
CUTS, HEADS = "__cuts", "__heads"
# Below every real bucket: rows whose order starts with null sort first.
NULL_BUCKET = -(2 ** 63)


def bucket_keys(partition_cols: Sequence[str], bucket: Column) -> list[Column]:
    """The columns ``__key`` (one text for all partition columns) and
    ``__bucket``, both never null, so that plain equality joins them."""
    parts = [F.when(F.col(c).isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("v"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")))
        for c in partition_cols]
    return [F.concat(*parts).alias(KEY), F.coalesce(bucket.cast("bigint"), F.lit(NULL_BUCKET)).alias(BUCKET)]


# Rows of a bucket beyond which it is cut, samples that stand for them, and the
# most cuts there are: what is broadcast is bounded at any size.
CUT_ROWS = 1_000_000
CUT_SAMPLES = 64
MAX_CUTS = 50_000
# Cuts that lie together, found by the first of them.
STRETCH = 128


def order_sample(df: DataFrame, rows: int, cut_rows: int = CUT_ROWS) -> DataFrame:
    """About ``CUT_SAMPLES`` rows in ``cut_rows``; ``rows`` is about the number of
    ``df``, and ``cut_rows`` grows with it once there would be more than
    ``MAX_CUTS`` cuts. Write the sample before use: it is not repeatable."""
    return df.sample(min(1.0, CUT_SAMPLES / max(cut_rows, -(-rows // MAX_CUTS))), seed=7)


def bucket_cuts(sample: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """``(__key, __bucket, __cuts, __heads)``: ascending cut points of buckets with
    many rows, in stretches, and the first cut of each.

    ``sample`` (:func:`order_sample`, written) brings ``__key`` and ``__bucket``.
    Every ``CUT_SAMPLES``-th sample of a bucket, in order, cuts it. Where the cuts
    fall never changes a result."""
    sample = sample.select(KEY, BUCKET, F.struct(*order_cols).alias("at"))
    place = F.row_number().over(Window.partitionBy(KEY, BUCKET).orderBy("at"))
    cut = sample.select(KEY, BUCKET, "at", place.alias("n")).where(F.col("n") % CUT_SAMPLES == 0)
    cuts = cut.groupBy(KEY, BUCKET).agg(F.array_sort(F.array_distinct(F.collect_list("at"))).alias("c"))
    stretch = F.transform(F.sequence(F.lit(0), F.floor((F.size("c") - 1) / STRETCH).cast("int")),
                          lambda i: F.slice(F.col("c"), i * STRETCH + 1, STRETCH))
    return cuts.select(KEY, BUCKET, stretch.alias(CUTS)).select(
        KEY, BUCKET, CUTS, F.transform(CUTS, lambda s: s[0]).alias(HEADS))


def with_part(df: DataFrame, cuts: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """``df`` with ``__part``: how many cuts of its bucket a row is not below.

    ``cuts`` (of :func:`bucket_cuts`) is broadcast; it has at most ``MAX_CUTS``
    cut points, plus those that chance adds. The stretch of cuts is found by its
    first ones, then the place in it."""
    found = df.join(F.broadcast(cuts), [KEY, BUCKET], "left")
    at = F.struct(*order_cols)
    n = F.size(F.filter(HEADS, lambda c: c <= at))
    inside = F.size(F.filter(F.get(F.col(CUTS), n - 1), lambda c: c <= at))
    # null without cuts or below the first; never null as a whole, so that a join on
    # it adds no filter to one side, which would keep two exchanges from being one
    part = F.coalesce((n - 1) * STRETCH + inside, F.lit(0))
    return found.select(*df.columns, part.cast("int").alias(PART))


def bucketed_lag(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                 value_col: str, out_col: str, bucket: Column | None,
                 totals: dict[str, Column] | None = None, read_whole: str | None = None) -> DataFrame:
    """``lag(value_col) OVER (PARTITION BY p ORDER BY o)`` for a total order ``o``.

    ``bucket`` must be non-decreasing along ``o`` inside a partition (e.g. the
    hour of the first order column); a column ``__part`` (:func:`with_part`) may
    cut buckets further. The window then runs per (partition, bucket, part); the head row of each bucket gets its value from the last row of
    the previous non-empty bucket, through a table with one row per bucket.
    Every step on the large side uses the same partitioning by
    (``__key``, ``__bucket``, ``__part``): if ``df`` brings these columns and is
    partitioned by them, it is not shuffled again. With ``bucket=None``
    this is the plain window.

    ``read_whole`` names a column, never null, that the small table does not need:
    it reads it all the same, so that both sides share one exchange. ``totals`` adds, per name, the sum of an amount over the whole partition;
    the sums go through the same small table.
    """
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    totals = totals or {}
    if bucket is None:
        over = Window.partitionBy(*partition_cols)
        out = df.withColumn(out_col, F.lag(value_col).over(over.orderBy(*order)))
        return out.select("*", *[F.sum(c).over(over).alias(n) for n, c in totals.items()])

    own = list(df.columns)
    if KEY not in own:
        df = df.select("*", *bucket_keys(partition_cols, bucket))
    else:
        own = [c for c in own if c not in (KEY, BUCKET, PART)]
    if PART not in df.columns:
        df = df.withColumn(PART, F.lit(0))
    place = [KEY, BUCKET, PART]
    whole = Window.partitionBy(*place).orderBy(*order)
    end = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = df.select("*", F.lag(value_col).over(whole).alias("__prev"), F.row_number().over(whole).alias("__row"))

    heads = df.select(*place, F.row_number().over(whole).alias("__row"),
                      F.last(value_col).over(end).alias("__last"),
                      *[F.sum(c).over(end).alias(n) for n, c in totals.items()],
                      (F.col(read_whole).isNotNull() if read_whole else F.lit(True)).alias("__read"))
    heads = heads.where("__row = 1 and __read")
    per_key = Window.partitionBy(KEY)
    carried = heads.select(*place, F.lag("__last").over(per_key.orderBy(BUCKET, PART)).alias("__carried"),
                           *[F.sum(n).over(per_key).alias(n) for n in totals])
    joined = inside.join(carried, place)
    value = F.when(F.col("__row") == 1, F.col("__carried")).otherwise(F.col("__prev"))
    return joined.select(*own, value.alias(out_col), *totals)
