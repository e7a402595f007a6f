"""Join helpers: size-checked broadcast and the join shapes the jobs use.

A side is broadcast only if the planner's size estimate (file sizes for a
scan) is within a byte bound. The check reads no rows and runs no job. Above
the bound the join stays a shuffle join, which adaptive execution may still
turn into a broadcast at run time from real shuffle sizes, and whose skewed
partitions it splits. Both ways give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitset import maybe_listed
from .sizes import planned_bytes

# Estimated bytes of the side (key and a few attributes) allowed into a broadcast.
DEFAULT_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when the planner expects ``df`` to hold at most ``max_bytes``.

    Pass the rows before any aggregation: estimates of scans come from file
    sizes; input of unknown size counts as too large.
    """
    if max_bytes <= 0:
        return False
    return planned_bytes(df) <= max_bytes


def keep_listed(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``left`` without rows that cannot match ``right``.

    A reducer to put below an aggregation: the join that follows still decides.
    The keys of a small ``right`` are broadcast; of a large one a bitset of
    fixed size (``bitset``), which lets a few other rows pass.
    """
    if not fits_broadcast(right, max_bytes):
        return maybe_listed(left, right.select(right_key), left_key, right_key)
    keys = right.select(F.col(right_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    return left.join(F.broadcast(keys), left[left_key] == keys["__k"], "left_semi")


def semi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (each left row once).

    Only the key of ``right`` is used; duplicates of it are removed before
    the exchange (partial aggregation), so a repeated address costs nothing.
    A small key set is broadcast (left semi join). Otherwise the keys are
    joined as an inner join on the distinct keys -- the same rows -- which
    the optimizer does not move below an aggregate on ``left``: a left semi
    join would be pushed under it, shuffling the raw rows by a possibly hot
    key instead of one pre-aggregated row per key.
    """
    listed = right.select(F.col(right_key).alias("__k")).where(F.col("__k").isNotNull())
    keys = listed.distinct()
    if fits_broadcast(listed, max_broadcast_bytes):
        return left.join(F.broadcast(keys), left[left_key] == keys["__k"], "left_semi")
    return left.join(keys, left[left_key] == keys["__k"], "inner").drop("__k")
