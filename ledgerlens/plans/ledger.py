"""Ledger jobs: monthly counts and averages, top services and miners,
contract types and contract gas.

Every job takes typed DataFrames (see ``schemas``) and returns a lazy
DataFrame. Joins with the contracts table are written so that a hot address
cannot overload one task: when the contract side is proven small it is
broadcast and joined before aggregating (no shuffle of transactions at all);
otherwise a bitset of the listed addresses drops most other transactions, the
rest is aggregated per address first, and the join meets one row per address on
each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast, keep_listed, semi_join
from ..operators.topk import ranked, top_k
from ..schemas import WEI


def wide_sum(c: Column | str) -> Column:
    """Exact sum of an integer column at any volume: bigint sums of fees pass
    2**63 within a month of a busy ledger."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast(WEI))


def price_sums(c: str, name: str, times: Column | None = None) -> list[Column]:
    """Exact sum of a price column in two integer sums, ``name`` for the whole
    parts and ``name_nanos`` for the fractions, whatever the order of the rows.
    ``times`` weights each row (a count of copies)."""
    parts = (C.whole(c), name), (C.nanos(c), f"{name}_nanos")
    return [F.sum((p if times is None else p * times).cast(WEI)).alias(n) for p, n in parts]


def price_mean(total: str, n: str) -> Column:
    """Mean from the two sums of :func:`price_sums`, divided last."""
    return F.try_divide(C.joined_double(F.col(total), F.col(f"{total}_nanos")), F.col(n))


def _months(tx: DataFrame) -> DataFrame:
    """Rows with a timestamp, keyed by the integer month ``mkey`` (yyyymm).

    Grouping happens on the integer; the ``MM/yyyy`` text is built once per
    group afterwards (:func:`_labelled`), not once per transaction.
    """
    return tx.where(F.col("block_timestamp").isNotNull()) \
        .withColumn("mkey", C.month_key("block_timestamp"))


def _labelled(agg: DataFrame, *cols) -> DataFrame:
    return agg.select(C.month_key_label("mkey").alias("month"), *cols)


def monthly_tx_count(tx: DataFrame) -> DataFrame:
    """Transactions per UTC month (``MM/yyyy``)."""
    agg = _months(tx).groupBy("mkey").agg(F.count(F.lit(1)).alias("tx_count"))
    return _labelled(agg, "tx_count")


def monthly_avg_value(tx: DataFrame) -> DataFrame:
    """Mean transferred value per month; the sum is exact, divided last."""
    t = _months(tx).where(F.col("value").isNotNull())
    agg = t.groupBy("mkey").agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("value").alias("total_value"),
    )
    return _labelled(
        agg, "tx_count", "total_value",
        (F.col("total_value").cast("double") / F.col("tx_count")).alias("avg_value"),
    )


def monthly_gas_price(tx: DataFrame, chronological: bool = False) -> DataFrame:
    """Mean gas price per month with its place by label (or by calendar month)."""
    t = _months(tx).where(F.col("gas_price").isNotNull())
    agg = t.groupBy("mkey").agg(
        F.count(F.lit(1)).alias("tx_count"),
        *price_sums("gas_price", "sum_gas_price"),
    )
    out = agg.select("mkey", C.month_key_label("mkey").alias("month"), "tx_count",
                     price_mean("sum_gas_price", "tx_count").alias("avg_gas_price"))
    order = F.col("mkey") if chronological else F.col("month")
    # one row per month: a few hundred rows over the ledger's life
    return ranked(out, [order]).orderBy("rank").drop("mkey")


def value_by_address(tx: DataFrame, key: str = "to_address") -> DataFrame:
    """A3: exact total value received per address."""
    return (tx.where(F.col(key).isNotNull() & F.col("value").isNotNull())
            .groupBy(key).agg(F.sum("value").alias("total_value")))


def top10_services(tx: DataFrame, contracts: DataFrame, k: int = 10,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Contracts that received the most value.

    Only the total of each address is kept, so the join with the (possibly
    repeating) contract list is a semi join.
    """
    listed = contracts.select("address").where(F.col("address").isNotNull())
    totals = contract_totals(tx, listed, max_broadcast_bytes)
    return top_k(totals, k, "total_value", ["address"])


def contract_totals(tx: DataFrame, contracts: DataFrame,
                    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """JN1: value received per listed contract address.

    A small list filters the transactions on the map side before they are
    aggregated. A bitset of a large one drops most of the others, and the rest
    meets the list as one pre-aggregated row per address.
    """
    totals = value_by_address(keep_listed(tx, contracts, "to_address", "address", max_broadcast_bytes))
    if not fits_broadcast(contracts, max_broadcast_bytes):
        totals = semi_join(totals, contracts, "to_address", "address", max_broadcast_bytes)
    return totals.withColumnRenamed("to_address", "address")


def size_by_miner(blocks: DataFrame) -> DataFrame:
    """A5: total block bytes per miner."""
    return (blocks.where(F.col("miner").isNotNull() & F.col("size").isNotNull())
            .groupBy("miner").agg(F.sum("size").alias("total_size")))


def top10_miners(blocks: DataFrame, k: int = 10) -> DataFrame:
    """Miners of the most block bytes."""
    return top_k(size_by_miner(blocks), k, "total_size", ["miner"])


def _contract_copies(contracts: DataFrame) -> DataFrame:
    """Per contract address: how often it is listed (bag joins multiply by it)."""
    return (contracts.where(F.col("address").isNotNull()).groupBy("address")
            .agg(F.count(F.lit(1)).alias("copies")))


def contract_gas_monthly(tx: DataFrame, contracts: DataFrame,
                         max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mean gas limit per month of transactions sent to contracts.

    Join semantics are those of a plain inner join with the contract list:
    an address listed twice counts its transactions twice.
    """
    copies = _contract_copies(contracts)
    t = _months(tx).where(F.col("to_address").isNotNull() & F.col("gas").isNotNull())
    if fits_broadcast(contracts.select("address"), max_broadcast_bytes):
        j = t.join(F.broadcast(copies), t["to_address"] == copies["address"])
        sums = j.groupBy("mkey").agg(F.sum("copies").alias("tx_count"), *price_sums("gas", "sum_gas", F.col("copies")))
    else:
        t = keep_listed(t, contracts, "to_address", "address", max_broadcast_bytes)
        pre = t.groupBy("to_address", "mkey").agg(
            F.count(F.lit(1)).alias("n0"), *price_sums("gas", "g0"))
        j = pre.join(copies, pre["to_address"] == copies["address"])
        sums = j.groupBy("mkey").agg(
            F.sum(F.col("n0") * F.col("copies")).alias("tx_count"),
            *[F.sum(F.col(f"g0{s}") * F.col("copies")).alias(f"sum_gas{s}") for s in ("", "_nanos")])
    return _labelled(sums, "tx_count", price_mean("sum_gas", "tx_count").alias("avg_gas"))


def contract_gas_sorted(tx: DataFrame, contracts: DataFrame, text_order: bool = False) -> DataFrame:
    """J8 ordered by mean gas, highest first, with its ``rank``.

    Numeric order by default; ``text_order`` sorts by the printed mean, as a
    sort of the numbers' text would (``"9..."`` before ``"10..."``).
    """
    key = F.col("avg_gas").cast("string") if text_order else F.col("avg_gas")
    return ranked(contract_gas_monthly(tx, contracts), [key.desc(), F.col("month")]).orderBy("rank")


def contract_types(tx: DataFrame, contracts: DataFrame, side: str = "to",
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Per contract address its type, calls, value, gas, mean gas price and fees.

    ``side`` picks the transaction address matched with the contract
    (``"to"``: calls into the contract, ``"from"``: transactions it sent).
    Rows follow inner-join (bag) semantics; both sides are reduced to one row
    per address before the join and the totals scaled by the multiplicity,
    which gives the same numbers without a skewed join. Only contracts that
    received a positive total value are kept. The contract list, or a bitset
    of a large one, first filters the transactions on the map side.
    """
    key = {"to": "to_address", "from": "from_address"}[side]
    t = keep_listed(tx, contracts, key, "address", max_broadcast_bytes)
    t = t.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("address")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("v"),
        *price_sums("gas", "g"),
        *price_sums("gas_price", "gp"),
        F.count("gas_price").alias("n_gp"),
        wide_sum(C.fee_sum("max_fee_per_gas", "max_priority_fee_per_gas")).alias("fees"),
        F.min("block_number").alias("min_tx_block"),
        # smallest label, taken on its integer position (keeps a hash aggregate)
        F.min(C.label_index(C.interaction_kind("to_address"), C.KIND_LABELS)).alias("kind_i"),
    )
    c = contracts.where(F.col("address").isNotNull()).groupBy("address").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("block_number").alias("max_contract_block"),
        F.min(C.label_index(C.contract_type_label("is_erc20", "is_erc721"), C.TYPE_LABELS))
        .alias("type_i"),
    )
    j = t.join(c, "address")
    out = j.select(
        "address", C.index_label(F.col("type_i"), C.TYPE_LABELS).alias("contract_type"),
        (F.col("n") * F.col("copies")).alias("calls"),
        (F.col("v") * F.col("copies")).cast(WEI).alias("total_value"),
        C.joined_price(F.col("g") * F.col("copies"), F.col("g_nanos") * F.col("copies")).alias("total_gas"),
        price_mean("gp", "n_gp").alias("avg_gas_price"),
        (F.col("fees") * F.col("copies")).cast(WEI).alias("total_fees"),
        C.contract_age("min_tx_block", "max_contract_block").alias("contract_age"),
        C.index_label(F.col("kind_i"), C.KIND_LABELS).alias("interaction_kind"),
    )
    return out.where(F.col("total_value") > 0)


def contract_age_range(tx: DataFrame, contracts: DataFrame,
                       max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """E13 per contract: youngest and oldest transaction age in blocks.

    Over the bag join, min(tx - c) = min(tx) - max(c) and max(tx - c) =
    max(tx) - min(c), so each side is reduced to one row per address first.
    """
    t = keep_listed(tx, contracts, "to_address", "address", max_broadcast_bytes)
    t = (t.where(F.col("to_address").isNotNull() & F.col("block_number").isNotNull())
         .groupBy(F.col("to_address").alias("address"))
         .agg(F.min("block_number").alias("t_min"), F.max("block_number").alias("t_max")))
    c = (contracts.where(F.col("address").isNotNull() & F.col("block_number").isNotNull())
         .groupBy("address")
         .agg(F.min("block_number").alias("c_min"), F.max("block_number").alias("c_max")))
    j = t.join(c, "address")
    return j.select("address",
                    C.contract_age("t_min", "c_max").alias("min_age"),
                    C.contract_age("t_max", "c_min").alias("max_age"))
