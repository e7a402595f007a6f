"""Line-oriented CSV text: scan, split into fields, type by position.

The exports are read as raw lines (``spark.read.text``), split once into an
array column and addressed by position. Quotes are not honoured, exactly as a
plain ``line.split(',')`` would not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..schemas import BLOCK_FIELDS, CONTRACT_FIELDS, SCAM_LINE_FIELDS, TRANSACTION_FIELDS

FIELDS = "fields"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column ``value`` (splittable, one task per file block)."""
    return spark.read.text(path)


def split_fields(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Add the array column ``fields``; trailing empty fields are kept.

    The line is split exactly once. A plain projection would be inlined by
    the optimizer into every later field reference (a pushed-down filter
    reading ten fields would split the line ten times); producing the array
    through a one-element ``inline`` generator keeps it a computed column.
    """
    row = F.struct(F.col("value"), F.split(F.col("value"), sep, -1).alias(FIELDS))
    return lines.select(F.inline(F.array(row)))


# Fixed value: a comma with an even number of quotes after it.
_OUTER_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def split_quoted_fields(lines: DataFrame, n: int) -> DataFrame:
    """:func:`split_fields` for lines of ``n`` fields that may be quoted.

    A line with ``n`` fields by its commas is taken as it is, quotes and all. In
    others that hold a quote, commas inside quotes do not count, quotes around a
    field go and doubled ones become one."""
    plain = F.split("value", ",", -1)
    quoted = F.transform(F.split("value", _OUTER_COMMA, -1), lambda f: F.when(
        f.rlike('^".*"$'), F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))
    fields = F.when((F.size(plain) == n) | ~F.contains(F.col("value"), F.lit('"')), plain).otherwise(quoted)
    return lines.select(F.inline(F.array(F.struct(F.col("value"), fields.alias(FIELDS)))))


def split_scam_fields(lines: DataFrame) -> DataFrame:
    """The nine fields of scam lines, as the registry job writes them."""
    return split_quoted_fields(lines, len(SCAM_LINE_FIELDS))


def field(i: int) -> Column:
    """Field ``i`` (0-based) or null when the line is shorter."""
    return F.try_element_at(F.col(FIELDS), F.lit(i + 1))


def arity(n: int) -> Column:
    return F.size(F.col(FIELDS)) == n


def tx_field(name: str) -> Column:
    return field(TRANSACTION_FIELDS.index(name))


def from_columns(table: DataFrame, fields: list[str]) -> DataFrame:
    """A table of text columns (CSV with header) in the form of split lines."""
    return table.select(F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields]).alias(FIELDS))


def typed_transactions(split: DataFrame, **extra: Column) -> DataFrame:
    """Typed view of split transaction lines; unparsable fields are null.

    ``extra`` columns over the split line are added under their names.
    """
    f = tx_field
    return split.select(
        f("hash").alias("hash"),
        P.to_long(f("nonce")).alias("nonce"),
        f("block_hash").alias("block_hash"),
        P.to_long(f("block_number")).alias("block_number"),
        P.to_long(f("transaction_index")).alias("transaction_index"),
        P.blank_to_null(f("from_address")).alias("from_address"),
        P.blank_to_null(f("to_address")).alias("to_address"),
        P.to_wei(f("value")).alias("value"),
        P.to_price(f("gas")).alias("gas"),
        P.to_price(f("gas_price")).alias("gas_price"),
        f("input").alias("input"),
        P.to_long(f("block_timestamp")).alias("block_timestamp"),
        P.to_long(f("max_fee_per_gas")).alias("max_fee_per_gas"),
        P.to_long(f("max_priority_fee_per_gas")).alias("max_priority_fee_per_gas"),
        P.to_long(f("transaction_type")).cast("int").alias("transaction_type"),
        *[c.alias(name) for name, c in extra.items()],
    )


def typed_blocks(split: DataFrame) -> DataFrame:
    f = lambda n: field(BLOCK_FIELDS.index(n))
    longs = {"number", "size", "gas_limit", "gas_used", "timestamp", "transaction_count",
             "base_fee_per_gas"}
    wei = {"difficulty", "total_difficulty"}
    cols = []
    for n in BLOCK_FIELDS:
        if n in longs:
            cols.append(P.to_long(f(n)).alias(n))
        elif n in wei:
            cols.append(P.to_wei(f(n)).alias(n))
        else:
            cols.append(f(n).alias(n))
    return split.select(*cols)


def typed_contracts(split: DataFrame) -> DataFrame:
    f = lambda n: field(CONTRACT_FIELDS.index(n))
    return split.select(
        P.blank_to_null(f("address")).alias("address"),
        f("bytecode").alias("bytecode"),
        f("function_sighashes").alias("function_sighashes"),
        P.to_flag(f("is_erc20")).alias("is_erc20"),
        P.to_flag(f("is_erc721")).alias("is_erc721"),
        P.to_long(f("block_number")).alias("block_number"),
    )


def typed_scams(split: DataFrame) -> DataFrame:
    f = lambda n: field(SCAM_LINE_FIELDS.index(n))
    return split.select(
        P.to_long(f("id")).alias("id"),
        f("name").alias("name"),
        f("url").alias("url"),
        f("coin").alias("coin"),
        f("category").alias("category"),
        f("subcategory").alias("subcategory"),
        P.blank_to_null(f("address")).alias("address"),
        f("status").alias("status"),
    )
