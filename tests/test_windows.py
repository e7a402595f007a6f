"""Skew-safe window operators equal the plain windows they replace."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.windows import bucketed_lag, running_count


def _rows(n_hot=400):
    rows = []
    # one hot sender spread over many hours, ties on the timestamp inside an hour
    for i in range(n_hot):
        rows.append(("hot", f"t{i % 7}", i % 5, 1000 + (i // 3) * 600))
    for s in range(20):
        for i in range(5):
            rows.append((f"s{s}", f"t{(s + i) % 3}", i, 5000 + i * 10))
    rows.append((None, "tn", 1, 10))
    rows.append((None, "tm", 2, 7200 * 3))
    rows.append(("hot", None, 9, 1000))
    rows.append(("late", "x", 1, None))
    rows.append(("late", "y", 1, 100))
    return rows


def test_bucketed_lag_equals_plain_lag(spark):
    df = spark.createDataFrame(_rows(), "sender string, to string, v int, ts long")
    order = ["ts", "to", "v"]
    plain = bucketed_lag(df, ["sender"], order, "to", "prev", None)
    split = bucketed_lag(df, ["sender"], order, "to", "prev",
                         F.floor(F.col("ts") / F.lit(3600)))
    summed = bucketed_lag(df, ["sender"], order, "to", "prev",
                          F.floor(F.col("ts") / F.lit(3600)), totals={"all_v": F.col("v")})
    whole = bucketed_lag(df, ["sender"], order, "to", "prev", None, totals={"all_v": F.col("v")})
    assert sorted(map(tuple, summed.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    a = sorted(map(tuple, plain.collect()), key=repr)
    b = sorted(map(tuple, split.collect()), key=repr)
    assert a == b
    # and equals the textbook window
    w = Window.partitionBy("sender").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    ref = sorted(map(tuple, df.withColumn("prev", F.lag("to").over(w)).collect()), key=repr)
    assert a == ref


def test_running_count_equals_range_window(spark):
    rows = [("b1", "x", 1, 10), ("b1", "x", 1, 10), ("b1", "x", 1, 20), ("b1", "x", 1, 5),
            ("b1", "y", 1, 10), ("b2", "x", 1, 10)] + [("hot", "h", 1, t % 4) for t in range(200)]
    df = spark.createDataFrame(rows, "b string, k string, v int, ts int")
    got = running_count(df, ["b", "k", "v"], "ts", "cnt")
    w = Window.partitionBy("b", "k", "v").orderBy("ts")   # RANGE frame: peers share
    ref = (df.withColumn("cnt", F.count(F.lit(1)).over(w))
           .groupBy("b", "k", "v", "ts", "cnt").agg(F.count(F.lit(1)).alias("n")))
    cols = ["b", "k", "v", "ts", "n", "cnt"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, ref.select(cols).collect()))


def test_means_with_no_prices_are_null_not_errors(spark):
    """A group whose prices are all missing has no mean (ANSI mode stays on)."""
    from decimal import Decimal

    from ledgerlens.plans.wash import transfer_groups

    df = spark.createDataFrame(
        [("a", "b", Decimal(1), 21000, None, 10), ("a", "b", Decimal(1), 21000, None, 10)],
        "from_address string, to_address string, value decimal(38,0), gas long, gas_price long, "
        "block_timestamp long")
    r = transfer_groups(df).first()
    assert r["tx_count"] == 2 and r["avg_gas_price"] is None


def test_j14_ranking_equals_literal_window_on_ties_and_nulls(spark):
    """Aggregate-only J14 equals count(*) OVER (... ORDER BY ts) > 1 | self."""
    import random
    from decimal import Decimal

    from ledgerlens.plans.wash import wash_by_block_sender

    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        b = rnd.randint(1, 30)
        f = f"s{rnd.randint(1, 6)}"
        t = f if rnd.random() < 0.1 else f"r{rnd.randint(1, 4)}"
        v = Decimal(rnd.choice([0, 1, 2, 10**20]))
        ts = None if rnd.random() < 0.05 else rnd.choice([100, 100, 200, 300])
        rows.append((b, f, t, v, ts))
    df = spark.createDataFrame(
        rows, "block_number long, from_address string, to_address string, value decimal(38,0), "
              "block_timestamp long")
    w = Window.partitionBy("block_number", "from_address", "to_address", "value") \
        .orderBy(F.col("block_timestamp").asc_nulls_first())
    lit = (df.withColumn("c", F.count(F.lit(1)).over(w))
           .where((F.col("c") > 1) | (F.col("from_address") == F.col("to_address")))
           .groupBy("block_number", "from_address").agg(F.sum("value").alias("total_value")))
    got = wash_by_block_sender(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, lit.collect()))


def hot_transfers(spark, n=6_000):
    """A third of the rows: one sender in one hour; a third: one without timestamps."""
    from pyspark.sql import functions as F

    rnd = F.xxhash64(F.lit("hot"), "id")
    kind = F.col("id") % 3
    return spark.range(n).select(
        F.when(kind == 0, "hot").when(kind == 1, "timeless").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("from_address"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("t"), F.pmod(rnd, F.lit(40)))).alias("to_address"),
        F.pmod(rnd, F.lit(7)).cast("decimal(38,0)").alias("value"),
        F.lit(21000).cast("decimal(28,9)").alias("gas"), F.pmod(rnd, F.lit(3)).cast("decimal(28,9)").alias("gas_price"),
        F.when(kind != 1, F.when(kind == 0, 7200 + F.pmod(rnd, F.lit(300))).otherwise(F.pmod(rnd, F.lit(10 ** 6))))
        .cast("bigint").alias("block_timestamp"))


@pytest.mark.parametrize("cut_rows, stretch", [(100, 128), (100, 3), (1_000, 128)])
def test_cut_buckets_give_the_rows_of_a_plain_window(spark, cut_rows, stretch, monkeypatch):
    from ledgerlens.operators import windows
    from ledgerlens.plans import wash as W

    monkeypatch.setattr(windows, "STRETCH", stretch)
    tx = hot_transfers(spark).repartition(4)
    totals = {"n": F.col("tx_count")}
    plain = W.prev_counterparty(tx, bucket_seconds=None, totals=totals)
    cut = W.prev_counterparty(tx, totals=totals, cut_rows=cut_rows)
    assert cut.columns == plain.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_a_hot_hour_and_rows_without_time_spread_over_tasks(spark):
    """Parts of a hot bucket are bounded by rows, keep the order and are dealt apart."""
    from ledgerlens.operators import windows as N
    from ledgerlens.plans import wash as W
    from ledgerlens.session import scratch_path

    tx = hot_transfers(spark)
    rows = tx.select(*W.TRANSFER_KEYS, *N.bucket_keys(["from_address"], F.floor(F.col("block_timestamp") / 3600)))
    path = scratch_path(spark, "cuts")
    N.order_sample(rows, 6_000, 200).write.parquet(path)
    cuts = N.bucket_cuts(spark.read.parquet(path), W.SENDER_ORDER)
    assert {r["__key"] for r in cuts.collect()} >= {"v3:hot", "v8:timeless"}
    parts = N.with_part(rows, cuts, W.SENDER_ORDER)
    for sender in ("hot", "timeless"):
        own = parts.where(F.col("from_address") == sender)
        sizes = [r["count"] for r in own.groupBy("__part").count().collect()]
        assert len(sizes) >= 5 and max(sizes) <= 800 and sum(sizes) == 2_000
        dealt = own.repartition(16, "__key", "__bucket", "__part").select(F.spark_partition_id().alias("p"))
        assert dealt.distinct().count() >= 4
        # parts follow the total order
        ends = own.groupBy("__part").agg(F.min(F.struct(*W.SENDER_ORDER)).alias("a"), F.max(F.struct(*W.SENDER_ORDER)).alias("z"))
        ends = ends.crossJoin(ends.select(F.col("__part").alias("q"), F.col("a").alias("b"))).where("__part < q and z >= b")
        assert ends.count() == 0


def test_small_inputs_are_not_sampled(spark, small):
    from ledgerlens.plans import wash as W
    from ledgerlens.sources.ledger import from_tables

    plan = W.wash_heuristics(from_tables(spark, small).transactions)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sample" not in plan and "bucket-cuts" not in plan
