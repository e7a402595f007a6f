"""Sizes from the planner: no job is run and no row is read."""

from __future__ import annotations

from pyspark.sql import DataFrame

UNKNOWN = 2 ** 63 - 1
# Bytes of a transaction in a well compressed columnar copy, about.
ROW_BYTES = 16
# Rows that a task groups or sorts; adaptive execution deals by compressed bytes,
# of which narrow rows take a few each and hundreds once they are grouped.
TASK_ROWS = 250_000
MAX_TASKS = 100_000


def planned_bytes(df: DataFrame) -> int:
    """The planner's estimate of ``df`` in bytes (file sizes for a scan).

    Where no planner is at hand (Spark Connect) the size counts as unknown: as
    large as the planner's own default for that."""
    try:
        df._jdf
    except AttributeError:
        return UNKNOWN
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, by the planner's estimate: an
    estimate of its rows that a join does not multiply."""
    try:
        df._jdf
    except AttributeError:
        return UNKNOWN
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def tasks_for(scanned: int, task_rows: int = TASK_ROWS) -> int | None:
    """Partitions that keep about ``task_rows`` rows in each, by the bytes that are
    read (:func:`scanned_bytes`); none for a small or unknown input, which adaptive
    execution deals."""
    if scanned >= UNKNOWN:
        return None
    tasks = -(-scanned // (ROW_BYTES * task_rows))
    return min(tasks, MAX_TASKS) if tasks > 4 else None
