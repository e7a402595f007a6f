"""Wash-trading jobs.

J13 groups identical transfers, looks at the sender's previous
counterparty and flags four heuristics; J14 counts repeated transfers inside
a block and ranks (block, sender) by the value of flagged transfers.

Both are written against hot keys: the per-sender window is split into time
buckets (``bucketed_lag``), so one very active sender is spread over many
tasks, and a block bounds what a key of J14 can hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.topk import first_n, top_k
from ..operators.combine import COUNT, combine_copies, many_copies
from ..operators.sizes import ROW_BYTES, TASK_ROWS, scanned_bytes, tasks_for
from ..operators.windows import (BUCKET, CUT_ROWS, KEY, NULL_BUCKET, PART, bucket_cuts, bucket_keys, bucketed_lag,
                                 order_sample, running_count, with_part)
from ..schemas import WEI
from ..session import scratch_path

TRANSFER_KEYS = ["from_address", "to_address", "value", "gas", "gas_price", "block_timestamp"]
# total order of a sender's transfer groups (the timestamp alone has ties)
SENDER_ORDER = ["block_timestamp", "to_address", "value", "gas", "gas_price"]
BLOCK_KEYS = ["block_number", "from_address", "to_address", "value"]

# Fixed values of the heuristics.
GAS_PRICE_FACTOR = 1.5
PLAIN_TRANSFER_GAS = 21000
CHEAP_GAS_PRICE = 1_000_000_000

DEFAULT_BUCKET_SECONDS = 3600
NULL_FIRST = -(2 ** 63)   # below every epoch second


def transfer_groups(tx: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Identical transfers collapsed, with their count and mean gas price.

    Rows that stand for several (``combine_copies``) count as many."""
    count = F.sum(COUNT) if COUNT in tx.columns else F.count(F.lit(1))
    return tx.groupBy(*TRANSFER_KEYS, *extra_keys).agg(
        count.alias("tx_count"),
        # the gas price is a key of the group, so it is its own mean
        C.joined_double(C.whole("gas_price"), C.nanos("gas_price")).alias("avg_gas_price"),
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hour_bucket(bucket_seconds: int | None) -> Column | None:
    if not bucket_seconds:
        return None
    return F.floor(F.col("block_timestamp") / F.lit(bucket_seconds))


def prev_counterparty(tx: DataFrame, bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                      totals: dict[str, Column] | None = None, cut_rows: int = CUT_ROWS) -> DataFrame:
    """Transfer groups with the sender's previous counterparty.

    The transfers are dealt by (sender, hour) once; grouping, lag and the
    per-hour summary all run on that partitioning. ``totals`` adds sums over
    all of a sender's groups. Where the input can hold more than ``cut_rows``
    rows of a sender in one hour, or without a timestamp, such a bucket is cut
    along the total order, by a sample of one narrow scan; and where the sample
    holds many copies, tasks combine identical transfers before they are dealt.
    """
    bucket = _hour_bucket(bucket_seconds)
    if bucket is None:
        groups = transfer_groups(tx)
    else:
        rows = tx.select(*TRANSFER_KEYS, *bucket_keys(["from_address"], bucket))
        place = [KEY, BUCKET]
        most = scanned_bytes(tx) // ROW_BYTES
        if most > cut_rows:
            sample = _written(order_sample(rows, most, cut_rows), "transfer-sample")
            if many_copies(sample, TRANSFER_KEYS):
                # written, since a Python step is planned twice; the two columns are
                # never null, but a file does not say so
                rows = _written(combine_copies(rows), "combined-transfers").withColumns(
                    {KEY: F.coalesce(KEY, F.lit("")), BUCKET: F.coalesce(BUCKET, F.lit(NULL_BUCKET))})
            rows = with_part(rows, _written(bucket_cuts(sample, SENDER_ORDER), "bucket-cuts"), SENDER_ORDER)
            place.append(PART)
        groups = transfer_groups(rows.repartition(*place), place)
    return bucketed_lag(groups, ["from_address"], SENDER_ORDER, "to_address", "prev_to_address", bucket, totals,
                        read_whole="tx_count")


def _heuristics(avg_col: str) -> Column:
    repeated = F.col("tx_count") > 1
    pricey = F.col("gas_price") > F.col(avg_col) * GAS_PRICE_FACTOR
    cheap_zero = ((F.col("value") == 0) & (F.col("gas") > PLAIN_TRANSFER_GAS)
                  & (F.col("gas_price") > CHEAP_GAS_PRICE))
    new_party = F.col("prev_to_address").isNull() | (F.col("prev_to_address") != F.col("to_address"))
    return F.coalesce(repeated | pricey | cheap_zero | new_party, F.lit(False))


OUT = [*TRANSFER_KEYS, "tx_count", "prev_to_address"]


def wash_heuristics(tx: DataFrame, bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Transfer groups matching any of the four heuristics.

    The price rule compares with the mean of the group itself, as the job
    states it (the price is a group key, so the rule cannot fire); see
    ``wash_heuristics_sender_mean`` for the per-sender mean.
    """
    g = prev_counterparty(tx, bucket_seconds)
    return g.where(_heuristics("avg_gas_price")).select(*OUT)


def wash_heuristics_sender_mean(tx: DataFrame,
                                bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """J13 with the price rule against the sender's mean gas price."""
    copies = F.when(F.col("gas_price").isNotNull(), F.col("tx_count"))
    g = prev_counterparty(tx, bucket_seconds, {
        "__prices": (C.whole("gas_price") * F.col("tx_count")).cast(WEI),
        "__nanos": (C.nanos("gas_price") * F.col("tx_count")).cast(WEI), "__priced": copies})
    mean = F.try_divide(C.joined_double(F.col("__prices"), F.col("__nanos")), F.col("__priced"))
    j = g.withColumn("sender_avg_gas_price", mean)
    return j.where(_heuristics("sender_avg_gas_price")).select(*OUT, "sender_avg_gas_price")


def wash_heuristics_50(tx: DataFrame) -> DataFrame:
    """T5: 50 flagged transfers (deterministic first 50 by the group keys)."""
    flagged = wash_heuristics(tx)
    return first_n(flagged, 50, TRANSFER_KEYS).select("from_address", "to_address", "value")


# --------------------------------------------------------------------------
# J14
# --------------------------------------------------------------------------

def _block_rows(tx: DataFrame, cut_rows: int, task_rows: int) -> tuple[DataFrame, Column, int | None]:
    """The ranking columns of a block's transfers, what counts them and into how
    many partitions they are dealt (none: as adaptive execution does). Where a
    sample of a large input holds many copies, tasks combine them first."""
    t = tx.where(F.col("block_number").isNotNull() & F.col("value").isNotNull())
    t = t.select(*BLOCK_KEYS, "block_timestamp")
    scanned = scanned_bytes(tx)
    most = scanned // ROW_BYTES
    if most > cut_rows and many_copies(_written(order_sample(t, most, cut_rows), "transfer-sample"), t.columns):
        t = combine_copies(t)
    count = F.sum(COUNT) if COUNT in t.columns else F.count(F.lit(1))
    return t, count, tasks_for(scanned, task_rows)


def running_transfer_count(tx: DataFrame, cut_rows: int = CUT_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Running count of identical transfers in a block, ordered by time.

    ``count(*) OVER (PARTITION BY block, from, to, value ORDER BY ts)``
    with the default RANGE frame, one row per distinct timestamp with
    ``n`` copies. Large inputs are dealt by the partition columns once, into
    partitions of about ``task_rows`` rows.
    """
    t, count, tasks = _block_rows(tx, cut_rows, task_rows)
    if tasks:
        t = t.repartition(tasks, *BLOCK_KEYS)
    return running_count(t, BLOCK_KEYS, "block_timestamp", out_col="block_count", count=count)


def wash_flagged(tx: DataFrame) -> DataFrame:
    """Repeated transfers in a block, or transfers to oneself."""
    c = running_transfer_count(tx)
    flag = (F.col("block_count") > 1) | (F.col("from_address") == F.col("to_address"))
    return c.withColumn("flagged", F.coalesce(flag, F.lit(False))).where("flagged").drop("flagged")


def wash_by_block_sender(tx: DataFrame, cut_rows: int = CUT_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Value of flagged transfers per (block, sender), summed exactly.

    Same result as summing ``wash_flagged`` rows, without the window: in a
    group of identical transfers (block, from, to, value) every row's running
    count exceeds 1 except when it is the *only* row at the group's earliest
    timestamp. So per group the flagged rows are all ``n`` rows, minus one
    when that earliest timestamp holds a single row and the transfer is not
    to oneself. The rows are dealt by (block, sender) once, which serves all
    three aggregations, large inputs into partitions of about ``task_rows``
    rows; a block bounds what one key can hold. No sort. Where a sample of a large
    input holds many copies, tasks combine them first.
    """
    t, count, tasks = _block_rows(tx, cut_rows, task_rows)
    t = t.repartition(*([tasks] if tasks else []), "block_number", "from_address")
    per_ts = t.groupBy(*BLOCK_KEYS, "block_timestamp").agg(count.alias("n_ts"))
    per_group = per_ts.groupBy(*BLOCK_KEYS).agg(
        F.sum("n_ts").alias("n"),
        # rows at the earliest timestamp (a null timestamp sorts first, as in
        # the window); a long ordering keeps this a hash aggregate
        F.min_by("n_ts", F.coalesce("block_timestamp", F.lit(NULL_FIRST))).alias("n_first"),
    )
    to_self = F.coalesce(F.col("from_address") == F.col("to_address"), F.lit(False))
    lone_first = (F.col("n_first") == 1) & ~to_self
    flagged = F.col("n") - F.when(lone_first, 1).otherwise(0)
    return (per_group.where(flagged > 0)
            .groupBy("block_number", "from_address")
            .agg(F.sum(F.col("value") * flagged).alias("total_value")))


def wash_top100(tx: DataFrame, k: int = 100) -> DataFrame:
    """The (block, sender) pairs with the most flagged value."""
    return top_k(wash_by_block_sender(tx), k, "total_value", ["block_number", "from_address"])
