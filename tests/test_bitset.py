"""The bitset of listed keys: no listed row is lost, most others go, fixed size."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import bitset as B
from ledgerlens.plans import ledger as L
from ledgerlens.session import scratch_path
from ledgerlens.sources.ledger import from_tables


def addresses(spark, n, start=0):
    key = F.concat(F.lit("0x"), F.sha1(F.col("id").cast("string").cast("binary")))
    return spark.range(start, start + n).select("id", key.alias("k"))


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_listed_rows_stay_and_others_mostly_go(spark, buckets):
    listed = addresses(spark, 2_000 * min(buckets, 10))
    n = listed.count()
    rows = addresses(spark, 40_000)
    got = B.maybe_listed(rows, listed.select(F.col("k").alias("address")), "k", "address", buckets)
    assert got.columns == rows.columns
    assert got.where(F.col("id") < n).count() == n
    assert got.count() < n + 0.05 * (40_000 - n)


def test_repeats_nulls_and_empty_lists(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v int")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "address string")
    assert sorted(r.v for r in B.maybe_listed(rows, listed, "k", "address", 4).collect()) == [1, 2]
    assert B.maybe_listed(rows, listed.limit(0), "k", "address", 4).collect() == []


def test_every_bit_of_a_bucket_is_read_where_it_was_set(spark):
    """Bits alone: a bitmap of one bit answers for that bit only."""
    probe = spark.range(B.BUCKET_BITS).select(F.col("id").cast("int").alias("bit"))
    for bit in (0, 1, 7, 8, 63, 64, 65, 4_095, 32_767):
        word = F.expr(f"transform(sequence(0, {B.BUCKET_BITS // B.WORD_BITS - 1}), "
                      "i -> cast(conv(hex(substring(map, 8 * i + 1, 8)), 16, -10) as bigint))")
        held = (spark.range(1).select(F.lit(bit).cast("bigint").alias("b"))
                .agg(F.bitmap_construct_agg("b").alias("map")).select(word.alias(B.WORDS)))
        got = probe.crossJoin(F.broadcast(held)).where(B._is_set(F.col("bit"))).collect()
        assert [r.bit for r in got] == [bit]


def test_size_is_bounded_whatever_the_list(spark):
    listed = addresses(spark, 30_000).select("k")
    held = B.key_bitset(listed, "k", 5)
    assert held.count() == 5 and held.where(F.size(B.WORDS) != B.BUCKET_BITS // B.WORD_BITS).count() == 0
    assert B.buckets_for(spark.range(10 ** 15)) == B.MAX_BUCKETS


def plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_large_lists_reduce_below_the_first_exchange(spark, small):
    """On written tables and the path of a large list, the bitset join lies between
    the scan of the transactions and their first exchange."""
    led = from_tables(spark, small)
    paths = {}
    for name in ("transactions", "contracts"):
        paths[name] = scratch_path(spark, name)
        getattr(led, name).write.parquet(paths[name])
    tx, contracts = (spark.read.parquet(p) for p in paths.values())
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for job in (L.top10_services, L.contract_totals, L.contract_gas_monthly, L.contract_types,
                    L.contract_age_range):
            df = job(tx, contracts, max_broadcast_bytes=0)
            lines = plan(df)
            scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "to_address" in x)
            above = [i for i, x in enumerate(lines[:scan]) if "Exchange hashpartitioning" in x]
            reducer = max(i for i, x in enumerate(lines[:scan]) if "BroadcastHashJoin" in x and B.BUCKET in x)
            assert not [i for i in above if i > reducer], "\n".join(lines)
            # the join that decides follows, on aggregated rows
            join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
            assert join < reducer and any("HashAggregate" in x for x in lines[join:reducer])
            assert sorted(map(tuple, df.collect())) == sorted(map(tuple, job(tx, contracts).collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_that_pass_wrongly_are_removed(spark, small, monkeypatch):
    """With a bitset so full that everything passes, the results are the same."""
    led = from_tables(spark, small)
    want = sorted(map(tuple, L.contract_totals(led.transactions, led.contracts).collect()))
    monkeypatch.setattr(B, "_is_set", lambda bit: F.lit(True))
    got = L.contract_totals(led.transactions, led.contracts, max_broadcast_bytes=0)
    assert sorted(map(tuple, got.collect())) == want
