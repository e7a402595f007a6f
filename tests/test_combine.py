"""Copies are combined in their task before rows are dealt; results stay the same."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import combine as N
from ledgerlens.plans import wash as W


def copy_heavy(spark, n=8_000):
    """Two thirds of the rows are copies of one transfer, the rest of few others."""
    i = F.col("id")
    hot = i % 3 != 0
    key = F.when(hot, F.lit(0)).otherwise(i % 500)
    return spark.range(n, numPartitions=4).select(
        F.concat(F.lit("s"), key % 20).alias("from_address"),
        F.when(key % 7 != 3, F.concat(F.lit("t"), key % 9)).alias("to_address"),
        (key % 5).cast("decimal(38,0)").alias("value"), F.lit("21000.5").cast("decimal(28,9)").alias("gas"),
        (key % 3).cast("decimal(28,9)").alias("gas_price"),
        F.when(key % 13 != 5, 3600 + key).cast("bigint").alias("block_timestamp"), (key % 40).alias("block_number"))


def plain(rows):
    return sorted(map(str, rows.collect()))


def test_counts_add_up_and_rows_shrink(spark):
    tx = copy_heavy(spark)
    got = N.combine_copies(tx, held_rows=1_000)
    assert got.columns == [*tx.columns, N.COUNT]
    assert plain(got.groupBy(*tx.columns).agg(F.sum(N.COUNT).alias("n"))) == plain(
        tx.groupBy(*tx.columns).agg(F.count(F.lit(1)).alias("n")))
    assert got.count() < tx.count() / 2
    assert N.combine_copies(tx.limit(0)).collect() == []


@pytest.mark.parametrize("cut_rows", [50, 500])
def test_jobs_give_the_same_rows(spark, cut_rows, tmp_path):
    path = str(tmp_path / "tx")
    copy_heavy(spark).write.parquet(path)
    tx = spark.read.parquet(path)
    assert plain(W.prev_counterparty(tx, cut_rows=cut_rows)) == plain(W.prev_counterparty(tx, bucket_seconds=None))
    assert plain(W.wash_by_block_sender(tx, cut_rows=cut_rows)) == plain(W.wash_by_block_sender(tx))


def shuffled_rows(df):
    """Records written by the explicit exchanges of a finished query."""
    from test_plans import _nodes

    qe = df._jdf.queryExecution()
    df.collect()
    return [n.metrics().get("shuffleRecordsWritten").get().value() for n in _nodes(qe.executedPlan())
            if n.nodeName() == "Exchange" and "REPARTITION_BY_COL" in n.simpleString(1_000)]


def test_copies_do_not_cross_the_network(spark, tmp_path):
    """Measured on the copy-heavy table: one large exchange still, of a few rows."""
    path = str(tmp_path / "tx")
    copy_heavy(spark).write.parquet(path)
    tx = spark.read.parquet(path)
    for job in (W.prev_counterparty, W.wash_by_block_sender):
        raw, combined = shuffled_rows(job(tx, cut_rows=10 ** 12)), shuffled_rows(job(tx, cut_rows=500))
        assert len(raw) == len(combined) == 1
        assert raw[0] == 8_000 and combined[0] <= 4_000, (job, raw, combined)


def test_few_copies_are_left_alone(spark):
    tx = spark.range(1_000).select(F.col("id").alias("k"))
    assert not N.many_copies(tx, ["k"]) and N.many_copies(tx.select((F.col("k") % 100).alias("k")), ["k"])
    assert not N.many_copies(tx.limit(0), ["k"])


@pytest.mark.parametrize("job", [W.running_transfer_count, W.wash_by_block_sender])
def test_large_inputs_are_dealt_by_their_rows(spark, job, tmp_path):
    """Adaptive execution would deal these few bytes into a partition or two."""
    from ledgerlens.operators.sizes import ROW_BYTES, scanned_bytes, tasks_for

    path = str(tmp_path / "tx")
    copy_heavy(spark).write.parquet(path)
    tx = spark.read.parquet(path)
    task_rows = scanned_bytes(tx) // ROW_BYTES // 20
    dealt = job(tx, cut_rows=10 ** 12, task_rows=task_rows)
    assert dealt.rdd.getNumPartitions() == tasks_for(scanned_bytes(tx), task_rows) >= 20
    combined = job(tx, cut_rows=500, task_rows=task_rows)
    assert plain(dealt) == plain(combined) == plain(job(tx))


def test_running_count_combines_copies_before_dealing(spark, tmp_path):
    path = str(tmp_path / "tx")
    copy_heavy(spark).write.parquet(path)
    tx = spark.read.parquet(path)
    from test_plans import _nodes

    def rows_dealt(cut_rows):
        df = W.running_transfer_count(tx, cut_rows=cut_rows, task_rows=10)
        df.collect()
        return [n.metrics().get("shuffleRecordsWritten").get().value() for n in _nodes(df._jdf.queryExecution().executedPlan())
                if n.nodeName() == "Exchange"]

    raw, combined = rows_dealt(10 ** 12), rows_dealt(500)
    assert len(raw) == len(combined) == 1
    assert raw[0] == 8_000 and combined[0] <= 4_000


def test_small_and_unknown_inputs_are_left_to_adaptive_execution():
    from ledgerlens.operators.sizes import MAX_TASKS, UNKNOWN, tasks_for

    assert tasks_for(UNKNOWN) is None and tasks_for(10 ** 7) is None
    assert tasks_for(10 ** 9) == 250 and tasks_for(10 ** 15) == MAX_TASKS
