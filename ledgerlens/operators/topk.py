"""Top-k and first-n with a total order.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
a k-row heap and only k rows per task reach the final merge, so no full sort
and no large shuffle. Ties are broken by the listed key columns so the result
does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, by: str, tie_break: Sequence[str] = (),
          descending: bool = True) -> DataFrame:
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with the 1-based place of each row in a total order.

    One task orders all rows: for small aggregated results (a row per month).
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Deterministic stand-in for an unordered ``take(n)``."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
