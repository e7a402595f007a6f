"""Streaming monthly statistics equal the batch jobs."""

from pathlib import Path

from pyspark.sql import functions as F

from ledgerlens.plans import ledger as L
from ledgerlens.session import scratch_path
from ledgerlens.sources import fixtures as FX
from ledgerlens.sources.ledger import all_transactions, checked
from ledgerlens.sources.text import split_fields
from ledgerlens.streaming import monthly as SM


def batch(lines, check):
    return checked(all_transactions(split_fields(lines)), check)


def test_stream_equals_batch(spark, small):
    """Each statistic counts the lines of its own batch job, bad lines included."""
    src_dir = scratch_path(spark, "arrivals")
    only_some = ["value=abc,gas_price=7", "block_number=x,gas_price=1.5", "gas_price=abc", "gas_price=nan,value=9"]
    more = [FX._variant(**dict(x.split("=") for x in line.split(","))) for line in only_some]
    extra = spark.createDataFrame([(x,) for x in more], "value string")
    FX.transaction_lines(spark, small).unionAll(extra).repartition(3).write.text(src_dir)
    out, ckpt = scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    stream = SM.monthly_stats(SM.transaction_stream(spark, src_dir, max_files_per_trigger=1))
    SM.start_monthly_changelog(stream, out, ckpt).awaitTermination()
    got = SM.with_averages(SM.read_latest(spark, out))
    # several micro-batches were written
    assert spark.read.parquet(out).select("batch_id").distinct().count() >= 3

    lines = spark.read.text(src_dir)
    j1 = L.monthly_tx_count(batch(lines, "timestamp"))
    j2 = L.monthly_avg_value(batch(lines, "value_ts")).select("month", "total_value", "avg_value")
    j7 = L.monthly_gas_price(batch(lines, "gas_price")).select("month", "avg_gas_price")
    ref = j1.join(j2, "month").join(j7, "month")
    month = "07/2017"                      # of the lines above
    counts = {c: batch(lines, c).where("block_timestamp = 1500000000").count() for c in ("timestamp", "value_ts", "gas_price")}
    assert len(set(counts.values())) == 3
    last = SM.read_latest(spark, out).where(F.col("month") == month).first()
    assert (last.tx_count, last.value_count, last.gas_price_count) == tuple(counts.values())
    cols = ["month", "tx_count", "total_value", "avg_value", "avg_gas_price"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, ref.select(cols).collect()))


def test_watermarked_append_closes_months(spark, small):
    src_dir = scratch_path(spark, "arrivals-wm")
    FX.transaction_lines(spark, small).orderBy(F.col("value")).coalesce(1).write.text(src_dir)
    stats = SM.monthly_stats(SM.transaction_stream(spark, src_dir), watermark_delay="0 seconds")
    out = scratch_path(spark, "closed")
    q = (stats.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", scratch_path(spark, "ckpt-wm"))
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    closed = spark.read.parquet(out)
    assert closed.count() > 0
    # every emitted month is final and equals the batch count
    counted = L.monthly_tx_count(batch(spark.read.text(src_dir), "timestamp"))
    j = closed.join(counted.withColumnRenamed("tx_count", "b"), "month")
    assert j.where("tx_count != b").count() == 0


def test_state_has_few_partitions_and_batches_many_files(spark, small):
    """The session may shuffle widely; a state of one row per month need not."""
    src_dir = scratch_path(spark, "arrivals-few")
    FX.transaction_lines(spark, small).repartition(6).write.text(src_dir)
    out, ckpt = scratch_path(spark, "log-few"), scratch_path(spark, "ckpt-few")
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "20")
    try:
        stats = SM.monthly_stats(SM.transaction_stream(spark, src_dir, SM.files_per_batch(spark)))
        SM.start_monthly_changelog(stats, out, ckpt).awaitTermination()
        assert spark.conf.get(name) == "20"
    finally:
        spark.conf.set(name, before)
    stores = [p for p in Path(ckpt.removeprefix("file:"), "state", "0").iterdir() if p.name.isdigit()]
    assert len(stores) == SM.STATE_PARTITIONS
    # all cores have files in a batch: fewer batches than files
    assert SM.files_per_batch(spark) >= spark.sparkContext.defaultParallelism
    batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert batches == -(-6 // SM.files_per_batch(spark))
    counted = L.monthly_tx_count(batch(spark.read.text(src_dir), "timestamp"))
    got = SM.read_latest(spark, out).select("month", "tx_count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, counted.collect()))
