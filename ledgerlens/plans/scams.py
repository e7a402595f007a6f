"""Scam jobs: value sent to reported scams, its course over time, the
registry flattening, and the address / transfer pair tables.

The scam registry is a curated list (thousands of entries), so joins with
it broadcast it after a size check and aggregate on the map side; if it is
ever too large to broadcast, transactions are first reduced to one row per
address (and month) so the shuffle join meets one row per key on each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import DEFAULT_BROADCAST_BYTES, fits_broadcast, keep_listed
from ..operators.topk import top_k
from ..operators.validate import valid_scam_record
from ..schemas import SCAM_DOCUMENT


def _scam_keys(scams: DataFrame) -> DataFrame:
    return scams.where(F.col("address").isNotNull()).select("id", "category", "address")


def _scam_value(tx: DataFrame, scams: DataFrame, extra_keys: dict[str, Column],
                scam_cols: list[str], max_broadcast_bytes: int) -> DataFrame:
    """Exact value received by scam addresses, grouped by ``extra_keys`` + ``scam_cols``.

    Bag semantics of an inner join: an address listed under several scams
    counts for each of them.
    """
    keys = _scam_keys(scams)
    t = tx.where(F.col("to_address").isNotNull() & F.col("value").isNotNull())
    for name, expr in extra_keys.items():
        t = t.withColumn(name, expr).where(F.col(name).isNotNull())
    group = [*extra_keys, *scam_cols]
    if fits_broadcast(keys, max_broadcast_bytes):
        j = t.join(F.broadcast(keys), t["to_address"] == keys["address"])
        return j.groupBy(*group).agg(F.sum("value").alias("total_value"))
    pre = t.groupBy("to_address", *extra_keys).agg(F.sum("value").alias("v"))
    j = pre.join(keys, pre["to_address"] == keys["address"])
    return j.groupBy(*group).agg(F.sum("v").alias("total_value"))


def value_by_scam(tx: DataFrame, scams: DataFrame,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """A8 / JN3: total value sent to each (scam id, category)."""
    return _scam_value(tx, scams, {}, ["id", "category"], max_broadcast_bytes)


def top10_scams(tx: DataFrame, scams: DataFrame, k: int = 10) -> DataFrame:
    """The most lucrative scams."""
    return top_k(value_by_scam(tx, scams), k, "total_value", ["id", "category"])


def scam_time_series(tx: DataFrame, scams: DataFrame,
                     max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Value sent to scams per (month, category), summed exactly."""
    mkey = F.when(F.col("block_timestamp").isNotNull(), C.month_key("block_timestamp"))
    v = _scam_value(tx, scams, {"mkey": mkey}, ["category"], max_broadcast_bytes)
    return v.select(C.month_key_label("mkey").alias("month"), "category", "total_value")


def scam_join(tx: DataFrame, scams: DataFrame,
              max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """JN3 per matched scam address: transfers received and their value."""
    keys = _scam_keys(scams)
    t = keep_listed(tx, keys, "to_address", "address", max_broadcast_bytes)
    t = t.where(F.col("to_address").isNotNull() & F.col("value").isNotNull())
    pre = t.groupBy("to_address").agg(F.count(F.lit(1)).alias("tx_count"),
                                      F.sum("value").alias("total_value"))
    keys_b = F.broadcast(keys) if fits_broadcast(keys, max_broadcast_bytes) else keys
    j = pre.join(keys_b, pre["to_address"] == keys_b["address"])
    return j.select("id", "category", "address", "tx_count", "total_value")


# --------------------------------------------------------------------------
# Registry documents
# --------------------------------------------------------------------------

def parse_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Registry JSON text -> one row per map entry (``key``, ``record``).

    The schema is given, never inferred: inference would make one struct
    field per address key. Ids may be numbers or text. Text that is no
    registry document stops the job: a document of several lines has to be
    read as a whole file.
    """
    text = F.col(text_col)
    parsed = docs.where(F.trim(text) != "").select(text.alias("text"), F.from_json(text, SCAM_DOCUMENT).alias("doc"))
    result = F.when(F.col("doc.result").isNotNull(), F.col("doc.result")).otherwise(
        F.raise_error(F.concat(F.lit("not a registry document: "), F.substring("text", 1, 80))))
    return with_typed_ids(parsed.select(F.explode(result).alias("key", "record")))


def with_typed_ids(entries: DataFrame) -> DataFrame:
    """Records whose text id is typed; an id that is no integer is null."""
    typed = F.col("record").withField("id", F.col("record.id").try_cast("bigint"))
    return entries.select("key", F.when(F.col("record").isNotNull(), typed).alias("record"))


def flatten_registry(entries: DataFrame) -> DataFrame:
    """One row per (scam record, address) with its index."""
    ok = entries.where(valid_scam_record("record"))
    r = F.col("record")
    rows = ok.select(
        r["id"].alias("identity"), r["name"].alias("name"), r["url"].alias("url"),
        r["coin"].alias("coin"), C.relabel_category(r["category"]).alias("category"),
        F.coalesce(r["subcategory"], F.lit("")).alias("subcategory"),
        r["status"].alias("status"),
        F.posexplode(r["addresses"]).alias("index", "address"),
    )
    return rows.select("identity", "name", "url", "coin", "category", "subcategory",
                       F.col("index").cast("bigint").alias("index"), "status", "address")


def scam_pairs(entries: DataFrame) -> DataFrame:
    """First and last address of every valid record, with its coin."""
    ok = entries.where(valid_scam_record("record"))
    first, last = C.first_and_last(F.col("record.addresses"))
    return ok.select(F.col("record.id").alias("id"), first.alias("first_address"),
                     last.alias("last_address"), F.col("record.coin").alias("coin"),
                     C.rollup_category(F.col("record.category")).alias("category_group"))


def tx_pairs(tx: DataFrame) -> DataFrame:
    """``((from, to), value)`` of every transfer."""
    return tx.select("from_address", "to_address", "value")
