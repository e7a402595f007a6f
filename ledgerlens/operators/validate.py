"""Row filters of the jobs as boolean Columns over split lines (``fields``).

Each predicate mirrors one job's line check; the typed conversion that
follows never fails on a line a predicate accepted.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..sources.text import arity, field, tx_field

TX_ARITY, BLOCK_ARITY, CONTRACT_ARITY, SCAM_ARITY = 15, 19, 6, 9


def tx_arity() -> Column:                       # F1
    return arity(TX_ARITY)


def tx_value_ts() -> Column:                    # F2
    return tx_arity() & P.is_wei(tx_field("value")) & P.is_int(tx_field("block_timestamp"))


def tx_block_digits() -> Column:                # F3 (also drops the header)
    return tx_arity() & P.is_digits(tx_field("block_number"))


def contract_arity() -> Column:                 # F4
    return arity(CONTRACT_ARITY)


def block_line() -> Column:                     # F5
    return arity(BLOCK_ARITY) & F.coalesce(field(1) != "hash", F.lit(False))


def tx_gas_price() -> Column:                   # F6
    # timestamps must be integers: the month label takes whole seconds
    return tx_arity() & P.is_float(tx_field("gas_price")) & P.is_int(tx_field("block_timestamp"))


def tx_block_value() -> Column:                 # F7
    return tx_arity() & P.is_int(tx_field("block_number")) & P.is_wei(tx_field("value"))


def scam_line() -> Column:                      # F8
    return arity(SCAM_ARITY) & P.is_int(field(0))


def tx_full() -> Column:                        # F9
    return tx_block_value() & P.is_int(tx_field("block_timestamp"))


def tx_digits_value() -> Column:                # F10
    return tx_arity() & P.is_digits(tx_field("block_timestamp")) & P.is_wei(tx_field("value"))


def valid_scam_record(rec: Column | str = "record") -> Column:    # F11
    """A registry record with every required field and a non-empty address list."""
    r = F.col(rec) if isinstance(rec, str) else rec
    return (r.isNotNull() & r["id"].isNotNull() & r["category"].isNotNull()
            & r["name"].isNotNull() & r["url"].isNotNull() & r["coin"].isNotNull() & r["status"].isNotNull()
            & (F.coalesce(F.size(r["addresses"]), F.lit(0)) > 0))


def tx_timestamp() -> Column:                   # J1: only the timestamp is parsed
    return tx_arity() & P.is_int(tx_field("block_timestamp"))


def tx_services() -> Column:                    # J3: digit block number, integer amount
    return tx_block_digits() & P.is_big_int(tx_field("value"))


# Flags that a typed copy keeps of a line, for checks its typed columns cannot decide.
TX_FLAGS = {
    "block_digits": lambda: P.is_digits(tx_field("block_number")),
    "timestamp_digits": lambda: P.is_digits(tx_field("block_timestamp")),
    "value_integer": lambda: P.is_big_int(tx_field("value")),
}


def _set(*names: str) -> Column:
    return reduce(and_, [F.col(n).isNotNull() for n in names], F.lit(True))


# Every transaction check on the text line, and the same check on a typed copy
# that holds all lines of the right number of fields plus the flags.
TX_CHECKS = {
    "arity": (tx_arity, lambda: F.lit(True)),
    "timestamp": (tx_timestamp, lambda: _set("block_timestamp")),
    "value_ts": (tx_value_ts, lambda: _set("value", "block_timestamp")),
    "services": (tx_services, lambda: F.col("block_digits") & F.col("value_integer")),
    # a price that is no number or not finite never counts in a mean
    "gas_price": (lambda: tx_gas_price() & P.is_price(tx_field("gas_price")), lambda: _set("gas_price", "block_timestamp")),
    "block_value": (tx_block_value, lambda: _set("block_number", "value")),
    "full": (tx_full, lambda: _set("block_number", "value", "block_timestamp")),
    "digits_value": (tx_digits_value, lambda: F.col("timestamp_digits") & _set("value")),
}
