"""Storage overhead of the hex columns of the blocks table.

Text length of every column of every row, summed in one global aggregate
(partial sums per task, one row each to merge). Hex columns count as
``length / HEX_CHARS_PER_BYTE`` bytes, the others one byte per character.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import text_length
from ..schemas import HEX_COLUMNS

# Fixed value: characters counted as one byte of a hex column.
HEX_CHARS_PER_BYTE = 4
MB = 1024 * 1024


def _row_len(cols: Sequence[str]):
    return reduce(add, [text_length(c) for c in cols]) if cols else F.lit(0)


def _metrics(hex_chars, rest_bytes) -> list:
    hex_mb = hex_chars / F.lit(HEX_CHARS_PER_BYTE) / F.lit(MB)
    rest_mb = rest_bytes / F.lit(MB)
    return [hex_mb.alias("total_hex_mb"), rest_mb.alias("remaining_mb"),
            (F.try_divide(hex_mb, hex_mb + rest_mb) * 100).alias("space_saved_pct")]


def data_overhead(blocks: DataFrame, hex_cols: Sequence[str] = HEX_COLUMNS) -> DataFrame:
    """Hex size, size of all other columns (MB) and the share the hex columns take."""
    rest = [c for c in blocks.columns if c not in hex_cols]
    sums = blocks.agg(F.sum(_row_len(hex_cols)).alias("hex_chars"),
                      F.sum(_row_len(rest)).alias("remaining_bytes"))
    return sums.select("hex_chars", "remaining_bytes",
                       *_metrics(F.col("hex_chars"), F.col("remaining_bytes")))


def first_block(blocks: DataFrame) -> DataFrame:
    """The rows of the lowest block number, also where numbers were read as text.

    The minimum is a scalar subquery over the number column alone; the filter on
    it is pushed into a columnar scan, so the wide columns of other blocks are
    not read where their files or row groups tell the numbers apart."""
    number = F.col("number")
    if dict(blocks.dtypes)["number"] == "string":
        number = number.try_cast("bigint")
    lowest = blocks.select(number.alias("number")).agg(F.min("number"))
    return blocks.where(number == lowest.scalar())


def data_overhead_first_block(blocks: DataFrame, hex_cols: Sequence[str] = HEX_COLUMNS) -> DataFrame:
    """The job's literal measure: hex columns of the first block only (lowest
    number; the least size if several rows have it) against the first remaining
    column summed over all blocks.

    Two passes over one narrow column each, and the hex columns of one block."""
    first_rest = next(c for c in blocks.columns if c not in hex_cols)
    none = F.lit(None).cast("bigint")
    hex_chars = first_block(blocks).agg(F.min(_row_len(hex_cols)).cast("bigint").alias("hex_chars"))
    rest = blocks.agg(F.sum(text_length(first_rest)).alias("remaining_bytes"))
    # two rows made one; a second scalar subquery would be merged with the minimum's
    # into one value, which scans do not take as a filter
    sums = (hex_chars.select("hex_chars", none.alias("remaining_bytes"))
            .unionByName(rest.select(none.alias("hex_chars"), "remaining_bytes"))
            .agg(F.max("hex_chars").alias("hex_chars"), F.max("remaining_bytes").alias("remaining_bytes")))
    return sums.select("hex_chars", "remaining_bytes",
                       *_metrics(F.col("hex_chars"), F.col("remaining_bytes")))
