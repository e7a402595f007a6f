"""A fixed-size bitset of listed keys, to drop rows that cannot join.

Every key sets ``BITS_PER_KEY`` bits in one bucket of 32,768 bits; bucket and
bits come from seeded hashes. A row whose bits are not all set has no partner
in the list. The set has at most ``MAX_BUCKETS`` rows of 4 KB whatever the list
holds, so it can always be broadcast. Keys that are not listed may pass (more
of them the fuller the bitset is): the join that follows decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizes import planned_bytes

BITS_PER_KEY = 4
BUCKET_BITS = 32_768                 # of one bitmap of the SQL bitmap functions
WORD_BITS = 64
MAX_BUCKETS = 4_096                  # 16 MB
#: Planned bytes of a list per bucket: about 16 bits for a key of 50 bytes.
LIST_BYTES_PER_BUCKET = 100_000

BUCKET, WORDS = "__bucket_no", "__words"


def buckets_for(listed: DataFrame, most: int = MAX_BUCKETS) -> int:
    """Buckets for a list of the planned size, ``most`` at most."""
    return max(1, min(most, planned_bytes(listed) // LIST_BYTES_PER_BUCKET))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(BUCKET_BITS)).cast("int") for i in range(BITS_PER_KEY)]


def key_bitset(listed: DataFrame, key: str, buckets: int) -> DataFrame:
    """``(__bucket_no, __words)``: the bitset of the distinct non-null keys, as
    one array of 64-bit words per bucket that holds a key.

    The bitmaps are combined in the tasks that read the list, so what is
    shuffled is one bitmap per task and bucket."""
    k = F.col(key)
    bits = (listed.where(k.isNotNull())
            .select(_bucket(k, buckets).alias(BUCKET), F.explode(F.array(*_bits(k))).alias("bit")))
    maps = bits.groupBy(BUCKET).agg(F.bitmap_construct_agg(F.col("bit").cast("bigint")).alias("map"))
    # eight bytes each, the first one highest
    word = F.expr(f"transform(sequence(0, {BUCKET_BITS // WORD_BITS - 1}), "
                  "i -> cast(conv(hex(substring(map, 8 * i + 1, 8)), 16, -10) as bigint))")
    return maps.select(BUCKET, word.alias(WORDS))


def _is_set(bit: Column) -> Column:
    word = F.get(F.col(WORDS), F.shiftright(bit, 6))
    # bit n of a bitmap is bit n % 8 of byte n / 8
    return F.getbit(word, (F.lit(7) - F.shiftright(bit.bitwiseAND(63), 3)) * 8 + bit.bitwiseAND(7)) == 1


def maybe_listed(left: DataFrame, listed: DataFrame, left_key: str, listed_key: str,
                 buckets: int | None = None) -> DataFrame:
    """``left`` without rows whose key cannot be in ``listed``; null keys go.

    Every row whose key is listed stays, once. ``left`` is not shuffled."""
    n = buckets or buckets_for(listed)
    held = F.broadcast(key_bitset(listed, listed_key, n))
    k = F.col(left_key)
    joined = left.join(held, _bucket(k, n) == held[BUCKET])
    passed = F.lit(True)
    for bit in _bits(k):
        passed = passed & _is_set(bit)
    return joined.where(k.isNotNull() & passed).select(*left.columns)
