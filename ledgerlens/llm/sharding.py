"""Sharding by weighted rendezvous hashing, on built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank

DEFAULT_SHARDS = 40


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Index of the shard that wins ``key``.

    Every (key, shard) pair gets a uniform hash u in (0, 1); the shard with
    the smallest ``-ln(u) / weight`` wins, so shard i receives a share of the
    keys proportional to its weight, and appending a shard only takes keys
    into the new shard. The key is hashed as given (a null key hashes like
    any other value, always to the same shard); ties go to the lower index.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    w = F.array(*[F.lit(float(x)) for x in weights])

    def score(i: Column) -> Column:
        h = F.xxhash64(F.lit("rendezvous"), key, i)
        u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / F.element_at(w, i + 1)).alias("score"), i.alias("shard"))

    every = F.sequence(F.lit(0), F.lit(len(weights) - 1))
    return F.array_min(F.transform(every, score))["shard"]


def assign_shards(docs: DataFrame, weights: Sequence[float] = (1.0,) * DEFAULT_SHARDS,
                  grown_weight: float = 1.0, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: where it goes, and where it would go after growth.

    Returns the id (as ``doc_id``), ``size`` (UTF-8 bytes of the text plus
    16), ``text_crc32`` (unsigned), ``law`` (``key``), ``shard``, ``slot``
    (gapless from 0 in each shard, by id, checksum and size) and
    ``grown_shard`` (the shard when one more of ``grown_weight`` is added).
    The id alone decides the shard: repeated ids share a shard and get
    different slots; a null id is one more key; a null text has no bytes
    (size 16, checksum 0). An empty table gives no rows. Only narrow rows are
    shuffled, never the text.
    """
    key, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, grown_weight]).alias("grown_shard"),
    )
    ranked = gapless_rank(narrow, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * DEFAULT_SHARDS,
                 id_col: str = "doc_id") -> None:
    """Write the documents under ``path``, one folder per shard.

    Each task writes its own files into every shard folder, so a shard of any
    size is written by many tasks and the text is not shuffled.
    """
    docs.withColumn("shard", shard_of(F.col(id_col), weights)).write.partitionBy("shard").parquet(path)
