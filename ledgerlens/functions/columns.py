"""Scalar column expressions shared by the jobs (all JVM-side built-ins)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category relabel of the registry flattening job and the
# category roll-up of the scam pair job.
CATEGORY_RELABEL = {"Scam": "Scamming"}
CATEGORY_ROLLUP = {"Phishing": "Scam", "Fake ICO": "Scam", "Scamming": "Scam"}

# Contract type names and interaction kinds.
TYPE_BOTH, TYPE_ERC20, TYPE_ERC721, TYPE_OTHER = "ERC20+ERC721", "ERC20", "ERC721", "Other"
CONTRACT_CREATION, CONTRACT_INTERACTION = "Contract Creation", "Contract Interaction"

# Billionths in a whole: prices keep nine digits of a fraction.
NANOS = 1_000_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole(price: Column | str) -> Column:
    """The whole part of a price."""
    return F.floor(_col(price))


def nanos(price: Column | str) -> Column:
    """The fraction of a price above its whole part, in billionths."""
    c = _col(price)
    return ((c - F.floor(c)).cast("decimal(10,9)") * F.lit(NANOS).cast("decimal(10,0)")).cast("bigint")


def joined_double(whole_sum: Column, nano_sum: Column) -> Column:
    """Sums of whole parts and of billionths as one double."""
    return whole_sum.cast("double") + nano_sum.cast("double") / F.lit(float(NANOS))


def joined_price(whole_sum: Column, nano_sum: Column) -> Column:
    """Sums of whole parts and of billionths as one exact decimal(38,9)."""
    n, unit = nano_sum.cast("decimal(38,0)"), F.lit(NANOS).cast("decimal(10,0)")
    # a multiple of the unit divides exactly, at any scale the division keeps
    carried = (whole_sum + ((n - n % unit) / unit)).cast("decimal(28,0)")
    rest = (n % unit).cast("decimal(10,0)") * F.lit(Decimal("1e-9")).cast("decimal(9,9)")
    return (carried + rest).cast("decimal(38,9)")


def month_label(epoch_seconds: Column | str) -> Column:
    """UTC calendar month of an epoch-seconds timestamp as ``MM/yyyy``."""
    return F.date_format(F.timestamp_seconds(_col(epoch_seconds)), "MM/yyyy")


def month_key(epoch_seconds: Column | str) -> Column:
    """UTC month as the integer ``yyyymm``: cheap to compute and group on;
    format it with :func:`month_key_label` after aggregating."""
    ts = F.timestamp_seconds(_col(epoch_seconds))
    return F.year(ts) * 100 + F.month(ts)


def month_key_label(key: Column | str) -> Column:
    """``yyyymm`` integer to the ``MM/yyyy`` label."""
    k = _col(key)
    return F.concat(F.lpad((k % 100).cast("string"), 2, "0"), F.lit("/"),
                    F.lpad((k / 100).cast("int").cast("string"), 4, "0"))


def month_start(epoch_seconds: Column | str) -> Column:
    """First day of the UTC month, for chronological ordering of labels."""
    return F.trunc(F.to_date(F.timestamp_seconds(_col(epoch_seconds))), "month")


def map_lookup(c: Column | str, mapping: dict[str, str]) -> Column:
    """``mapping.get(c, c)`` as a literal map lookup."""
    c = _col(c)
    if not mapping:
        return c
    lit_map = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lit_map, c), c)


def relabel_category(c: Column | str) -> Column:
    return map_lookup(c, CATEGORY_RELABEL)


def rollup_category(c: Column | str) -> Column:
    return map_lookup(c, CATEGORY_ROLLUP)


def contract_type_code(is_erc20: Column | str, is_erc721: Column | str) -> Column:
    """Raw code: the two flags as 0/1 digits joined when either is set, else ``Other``."""
    a = _col(is_erc20).cast("int").cast("string")
    b = _col(is_erc721).cast("int").cast("string")
    return F.when((a == "1") | (b == "1"), F.concat(a, b)).otherwise(F.lit(TYPE_OTHER))


def contract_type_label(is_erc20: Column | str, is_erc721: Column | str) -> Column:
    """Readable contract type from boolean (or 0/1) flags."""
    a = F.coalesce(_col(is_erc20).cast("boolean"), F.lit(False))
    b = F.coalesce(_col(is_erc721).cast("boolean"), F.lit(False))
    return (F.when(a & b, TYPE_BOTH).when(a, TYPE_ERC20).when(b, TYPE_ERC721)
            .otherwise(TYPE_OTHER))


# Labels in text order: the smallest label of a group is the label of the
# smallest index, so "first label" aggregates can run on integers.
TYPE_LABELS = sorted([TYPE_BOTH, TYPE_ERC20, TYPE_ERC721, TYPE_OTHER])
KIND_LABELS = sorted([CONTRACT_CREATION, CONTRACT_INTERACTION])


def label_index(label: Column, labels: list[str]) -> Column:
    """Position of ``label`` in the sorted ``labels`` (an int, hash-aggregatable)."""
    out = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(labels))):
        out = F.when(label == name, F.lit(i)).otherwise(out)
    return out


def index_label(index: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), index + 1)


def interaction_kind(to_address: Column | str) -> Column:
    """A transaction without a target creates a contract; else it calls one."""
    t = _col(to_address)
    return (F.when(t.isNull() | (F.trim(t) == ""), CONTRACT_CREATION)
            .otherwise(CONTRACT_INTERACTION))


def fee_sum(max_fee: Column | str, max_priority_fee: Column | str) -> Column:
    wide = [F.coalesce(_col(c).cast("decimal(37,0)"), F.lit(0)) for c in (max_fee, max_priority_fee)]
    return wide[0] + wide[1]


def contract_age(tx_block: Column | str, contract_block: Column | str) -> Column:
    """Blocks between the contract's creation and the transaction."""
    return (_col(tx_block) - _col(contract_block)).cast("bigint")


def text_length(c: Column | str) -> Column:
    """Characters of a column's text form; 0 for null."""
    return F.coalesce(F.length(_col(c).cast("string")), F.lit(0))


def first_and_last(arr: Column | str) -> tuple[Column, Column]:
    a = _col(arr)
    return F.try_element_at(a, F.lit(1)), F.try_element_at(a, F.lit(-1))
