"""Typed ledger tables, from the driver tables or from ledger files.

``from_tables`` derives the four ledger tables from the driver's parquet
tables (see ``fixtures``); ``from_text`` and ``from_parquet`` read real
exports. All return the same typed schemas, so the jobs do not care which.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import to_flag
from ..operators import validate as V
from ..schemas import PRICE
from ..session import path_version, session_key
from . import fixtures, text


@dataclass(frozen=True)
class Ledger:
    transactions: DataFrame
    blocks: DataFrame
    contracts: DataFrame
    scams: DataFrame


def _typed_contracts(c: DataFrame) -> DataFrame:
    return c.select("address", "bytecode", "function_sighashes",
                    to_flag("is_erc20").alias("is_erc20"),
                    to_flag("is_erc721").alias("is_erc721"),
                    F.col("block_number").cast("bigint").alias("block_number"))


def _typed_transactions(t: DataFrame) -> DataFrame:
    return t.withColumns({c: F.col(c).cast(PRICE) for c in ("gas", "gas_price")})


_FROM_TABLES: dict[tuple[str, str], tuple[tuple, Ledger]] = {}


def from_tables(spark: SparkSession, sf_dir: str) -> Ledger:
    """Ledger tables derived from the driver tables in ``sf_dir``.

    Built once per session and state of the files: the DataFrames are lazy and immutable, and
    building them (dozens of column expressions, each analysed on creation)
    costs more driver time than many small jobs take to run.
    """
    root = sf_dir.rstrip("/")
    key = (session_key(spark), root)
    version = tuple(path_version(spark, f"{root}/{n}.parquet") for n in ("lineitem", "orders", "supplier"))
    held = _FROM_TABLES.get(key)
    if held is None or held[0] != version or held[1].transactions.sparkSession is not spark:
        held = _FROM_TABLES[key] = (version, _build_from_tables(spark, sf_dir))
    return held[1]


def _build_from_tables(spark: SparkSession, sf_dir: str) -> Ledger:
    return Ledger(
        transactions=_typed_transactions(fixtures.transactions(spark, sf_dir)),
        blocks=fixtures.blocks(spark, sf_dir),
        contracts=_typed_contracts(fixtures.contracts(spark, sf_dir)),
        scams=fixtures.scams(spark, sf_dir),
    )


def all_transactions(split: DataFrame) -> DataFrame:
    """Every line of the right number of fields, typed, with the flags that the
    jobs' own line checks need besides the typed columns."""
    return text.typed_transactions(split.where(V.tx_arity()), **{n: f() for n, f in V.TX_FLAGS.items()})


def checked(tx: DataFrame, check: str) -> DataFrame:
    """The rows of :func:`all_transactions` that a job's line check keeps."""
    return tx.where(V.TX_CHECKS[check][1]()).drop(*V.TX_FLAGS)


def from_text(spark: SparkSession, transactions: str, blocks: str, contracts: str,
              scams: str) -> Ledger:
    """Read CSV exports line by line and type them.

    Transactions keep every 15-field line (unparsable fields are null); a job's
    own line check is applied with :func:`checked`.
    """
    tx = all_transactions(text.split_fields(text.read_lines(spark, transactions)))
    bl = text.typed_blocks(text.split_fields(text.read_lines(spark, blocks)).where(V.block_line()))
    ct = text.split_fields(text.read_lines(spark, contracts))
    ct = text.typed_contracts(ct.where(V.contract_arity() & (text.field(0) != "address")))
    sc = text.typed_scams(text.split_scam_fields(text.read_lines(spark, scams)).where(V.scam_line()))
    return Ledger(tx, bl, ct, sc)


def from_parquet(spark: SparkSession, root: str) -> Ledger:
    """Typed parquet copies written by ``sinks.writers.write_typed_ledger``."""
    r = root.rstrip("/")
    return Ledger(*(spark.read.parquet(f"{r}/{n}") for n in
                    ("transactions", "blocks", "contracts", "scams")))
