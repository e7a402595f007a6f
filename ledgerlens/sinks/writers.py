"""Result writers.

Results are written by the executors (``DataFrameWriter``), never gathered
on the driver. The pair-list form -- one JSON array holding every row -- is
by nature one record: it is the form of results that are small by
construction (a top-k list, a row per month).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ..schemas import SCAM_LINE_FIELDS


# Rows of a file of compressed text: it cannot be split, so one task reads it.
FILE_ROWS = 250_000


def compressed(df: DataFrame) -> DataFrameWriter:
    """Writer of large text (lines, CSV): gzip in files of ``FILE_ROWS`` rows. Hashes
    in hex take about half their bytes, repeated ones next to nothing."""
    return df.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)


def run_stamped_path(base: str, part: str, now: dt.datetime | None = None) -> str:
    """K5: ``<base>/ethereum_<part>_<dd-mm-YYYY_HH-MM-SS>`` (no ``:``; Hadoop
    paths cannot hold it)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return f"{base.rstrip('/')}/ethereum_{part}_{now.strftime('%d-%m-%Y_%H-%M-%S')}"


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1 / K4: one JSON object per row."""
    df.write.mode(mode).json(path)


def pair_list(df: DataFrame, key_cols: Sequence[str], value_col: str,
              order: Sequence[Column] | None = None) -> DataFrame:
    """K1 pair-list form: one row, ``value`` = ``[[key, number], ...]`` JSON.

    A single key is written as ``[key, number]``, a compound key as
    ``[[k1, k2], number]``; numbers stay JSON numbers and a non-finite
    number is written as ``null`` (JSON has no ``Infinity``). ``order`` fixes
    the element order (default: value descending, then keys).
    """
    from pyspark.sql import Window

    if len(key_cols) == 1:
        key = F.to_json(F.struct(F.col(key_cols[0]).cast("string").alias("k")))
        key = F.regexp_extract(key, r'^\{"k":(.*)\}$', 1)
    else:
        key = F.to_json(F.array(*[F.col(c).cast("string") for c in key_cols]))
    v = F.col(value_col)
    finite = v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf"))
    num = F.when(finite, v.cast("string")).otherwise(F.lit("null"))
    order = list(order or [F.col(value_col).desc(), *[F.col(c) for c in key_cols]])
    rank = F.row_number().over(Window.orderBy(*order))
    elem = F.concat(F.lit("["), key, F.lit(","), num, F.lit("]"))
    items = df.select(rank.alias("r"), elem.alias("e"))
    one = items.agg(F.sort_array(F.collect_list(F.struct("r", "e"))).alias("a"))
    return one.select(F.concat(F.lit("["), F.array_join(F.col("a.e"), ","), F.lit("]")).alias("value"))


def write_pair_list(df: DataFrame, key_cols: Sequence[str], value_col: str, path: str,
                    mode: str = "overwrite", order: Sequence[Column] | None = None) -> None:
    pair_list(df, key_cols, value_col, order).coalesce(1).write.mode(mode).text(path)


def csv_lines(df: DataFrame, cols: Sequence[str], sep: str = ",") -> DataFrame:
    """``a,b,c`` text lines (nulls as empty fields)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def write_csv_lines(df: DataFrame, cols: Sequence[str], path: str, mode: str = "overwrite") -> None:
    csv_lines(df, cols).write.mode(mode).text(path)


def write_csv_header(df: DataFrame, cols: Sequence[str], path: str, mode: str = "overwrite",
                     large: bool = False) -> None:
    """K3: CSV with a header line and a fixed column order; :func:`compressed` where ``large``."""
    out = df.select(*cols)
    (compressed(out) if large else out.write).mode(mode).option("header", True).csv(path)


def write_scam_lines(flat: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: nine-field scam lines as the value jobs read them (no header, the
    address at position 6, blanks empty). A line is plain text unless a field
    has a comma; then fields with a comma or a quote are quoted, which
    ``sources.text.split_scam_fields`` reads back. Line ends inside a field
    become spaces."""
    flat = flat.withColumnRenamed("identity", "id")
    plain = flat.select(*[F.regexp_replace(F.col(c).cast("string"), "[\r\n]", " ").alias(c) for c in SCAM_LINE_FIELDS])
    comma = F.lit(False)
    for c in SCAM_LINE_FIELDS:
        comma = comma | F.contains(F.coalesce(c, F.lit("")), F.lit(","))
    marked = plain.withColumn("quoted", comma)
    special = lambda c: F.col("quoted") & F.col(c).rlike('[,"]')
    quoted = [F.when(special(c), F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')))
              .otherwise(F.col(c)).alias(c) for c in SCAM_LINE_FIELDS]
    write_csv_lines(marked.select(*quoted), SCAM_LINE_FIELDS, path, mode)


def format_metrics(df: DataFrame, decimals: int = 2) -> DataFrame:
    """K6: numeric columns as ``#,###.##`` text."""
    num = ("double", "float", "int", "bigint", "smallint", "tinyint")
    cols = [F.format_number(F.col(c), decimals).alias(c)
            if t in num or t.startswith("decimal") else F.col(c)
            for c, t in df.dtypes]
    return df.select(*cols)


def _in_hashes(df: DataFrame) -> DataFrameWriter:
    """Writer of tables that are mostly hashes in hex: Parquet's delta encodings keep the
    lengths and the common start of the texts apart from their digits, and zstd's lowest
    level, which looks for few repeats, takes the least room for digits that have none."""
    return (df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1")
            .option("parquet.writer.version", "v2"))


def write_typed_ledger(transactions: DataFrame | Iterable[DataFrame], blocks: DataFrame | Iterable[DataFrame],
                       contracts: DataFrame, scams: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Typed parquet copy of the ledger; transactions partitioned by month so
    monthly jobs and time filters prune whole folders. ``transactions`` should
    hold every line with its check flags (``sources.ledger.all_transactions``),
    so that each job can apply its own line check to the copy.

    Transactions and blocks may come in parts, which are written one after the other:
    a part's source may go when the next is asked for, and the blocks' first part is
    asked for when all transactions are written.

    Nothing is shuffled: a task writes what it reads, a file per month that occurs
    in it. Exports lie in block order, so that is a few consecutive months. zstd
    halves hashes in hex, which the default codec leaves as they are."""
    from ..functions.columns import month_start

    r = root.rstrip("/")

    def parts(table: DataFrame | Iterable[DataFrame]) -> Iterable[tuple[DataFrame, str]]:
        if isinstance(table, DataFrame):
            yield table, mode
            return
        if mode == "ignore":
            raise ValueError("a copy that is there cannot be told from an earlier part; write a whole table")
        for i, df in enumerate(table):
            yield df, "append" if i else mode

    for df, how in parts(transactions):
        tx = df.withColumn("month", F.date_format(month_start("block_timestamp"), "yyyy-MM"))
        _in_hashes(tx).mode(how).partitionBy("month").parquet(f"{r}/transactions")
    for df, how in parts(blocks):
        _in_hashes(df).mode(how).parquet(f"{r}/blocks")
    for name, df in (("contracts", contracts), ("scams", scams)):
        df.write.mode(mode).option("compression", "zstd").parquet(f"{r}/{name}")
