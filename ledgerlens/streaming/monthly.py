"""Monthly ledger statistics over arriving export files (Structured Streaming).

The batch jobs J1 (count), J2 (mean value) and J7 (mean gas price) share one
key, the UTC month, so one streaming aggregation maintains all three. Lines
are typed as in batch (``sources.text``) and every statistic counts the lines
that its own job's check keeps, so a file that arrives is counted the same way
the three batch runs would count it.

State is one row per month (a few hundred rows over the ledger's life), so
no watermark is required; the query runs in ``update`` mode and writes each
micro-batch's changed months to a changelog folder (``foreachBatch``, keyed by
batch id, idempotent on replay). ``read_latest`` folds the changelog to the
current value per month. With ``watermark_delay`` the query instead closes
months once event time has moved past them and emits them once (``append``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import columns as C
from ..plans.ledger import price_mean, price_sums
from ..sources.ledger import all_transactions
from ..sources.text import split_fields

STATS = ["tx_count", "value_count", "total_value", "gas_price_count", "sum_gas_price", "sum_gas_price_nanos"]


# Compressed files are read by one task each; a micro-batch also costs seconds of its own.
FILES_PER_CORE = 4
# Partitions of a state of one row per month; each is a store that every batch commits.
STATE_PARTITIONS = 8


def files_per_batch(spark: SparkSession) -> int:
    """Files of a micro-batch that keep every core busy; one where the cores are not
    known (Spark Connect)."""
    try:
        return FILES_PER_CORE * spark.sparkContext.defaultParallelism
    except Exception:
        return 1


def transaction_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Every line of the right number of fields in the text export files that
    appear under ``path``, typed; each statistic applies its own job's check."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return all_transactions(split_fields(reader.load(path)))


def monthly_stats(tx: DataFrame, watermark_delay: str | None = None) -> DataFrame:
    """Per-month running totals; works on a batch or a streaming DataFrame.

    The checks of the three jobs, on typed lines: J1 takes lines with a
    timestamp, J2 of those the ones with an amount, J7 those with a gas price."""
    t = tx.where(F.col("block_timestamp").isNotNull()).withColumn("mkey", C.month_key("block_timestamp"))
    keys = ["mkey"]
    if watermark_delay:
        t = (t.withColumn("month_start", F.to_timestamp(C.month_start("block_timestamp")))
             .withWatermark("month_start", watermark_delay))
        keys = ["month_start", "mkey"]
    agg = t.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.count("value").alias("value_count"),
        F.sum("value").alias("total_value"),
        F.count("gas_price").alias("gas_price_count"),
        *price_sums("gas_price", "sum_gas_price"),
    )
    return agg.select(C.month_key_label("mkey").alias("month"), *STATS)


def with_averages(stats: DataFrame) -> DataFrame:
    """J2 / J7 means from the running totals (divided last)."""
    return stats.select(
        "month", "tx_count", "total_value",
        F.try_divide(F.col("total_value").cast("double"), "value_count").alias("avg_value"),
        price_mean("sum_gas_price", "gas_price_count").alias("avg_gas_price"),
    )


def start_monthly_changelog(stats: DataFrame, out_path: str, checkpoint: str,
                            trigger: dict | None = None) -> StreamingQuery:
    """Write each micro-batch's updated months to ``out_path/batch_id=N``."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # overwriting the batch's own folder makes a replayed batch idempotent
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = (stats.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"availableNow": True}))
    # a stream takes the number of its state partitions from the session as it starts
    # and keeps it in its checkpoint
    conf, name = stats.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(name)
    conf.set(name, str(min(int(before), STATE_PARTITIONS)))
    try:
        return w.start()
    finally:
        conf.set(name, before)


def read_latest(spark: SparkSession, out_path: str) -> DataFrame:
    """Fold the changelog: the newest row of every month."""
    log = spark.read.parquet(out_path)
    latest = log.groupBy("month").agg(
        F.max_by(F.struct(*STATS), F.col("batch_id")).alias("s"))
    return latest.select("month", *[F.col(f"s.{c}").alias(c) for c in STATS])
