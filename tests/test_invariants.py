"""Shape invariants the saved reference results show, checked on ours."""

import pytest

from ledgerlens.plans import ledger as L
from ledgerlens.plans import wash as W
from ledgerlens.sources.ledger import from_tables


@pytest.fixture(scope="module")
def led(spark, small):
    return from_tables(spark, small)


def test_count_and_value_series_share_months(led):
    a = {r["month"] for r in L.monthly_tx_count(led.transactions).collect()}
    b = {r["month"] for r in L.monthly_avg_value(led.transactions).collect()}
    assert a == b and len(a) > 12


def test_gas_price_series_is_label_sorted(led):
    months = [r["month"] for r in L.monthly_gas_price(led.transactions).collect()]
    assert months == sorted(months)
    chrono = [r["month"] for r in L.monthly_gas_price(led.transactions, chronological=True).collect()]
    assert chrono == sorted(chrono, key=lambda m: (m[3:], m[:2]))


def test_contract_gas_sorted_descending(led):
    v = [r["avg_gas"] for r in L.contract_gas_sorted(led.transactions, led.contracts).collect()]
    assert v == sorted(v, reverse=True)


def test_top_lists_are_descending_and_bounded(led):
    w = [r["total_value"] for r in W.wash_top100(led.transactions).collect()]
    assert len(w) <= 100 and w == sorted(w, reverse=True)
    m = [r["total_size"] for r in L.top10_miners(led.blocks).collect()]
    assert len(m) == 10 and m == sorted(m, reverse=True)


def test_first_fifty_flagged_transfers(led):
    rows = W.wash_heuristics_50(led.transactions).collect()
    assert len(rows) == 50
    assert rows == sorted(rows, key=lambda r: (r["from_address"], r["to_address"], r["value"]))


def test_session_defaults_do_not_override_deployment():
    from ledgerlens.session import BASE_CONF, CLUSTER_CONF

    assert "spark.sql.shuffle.partitions" in CLUSTER_CONF
    assert BASE_CONF["spark.sql.session.timeZone"] == "UTC"


def test_text_renderings_print_the_numbers(spark, small):
    import __spark_entry__ as E

    q = E.queries()
    text = {r["month"]: r["avg_value_text"] for r in q["avg_value_text"](spark, small).collect()}
    nums = {r["month"]: r["avg_value"] for r in L.monthly_avg_value(from_tables(spark, small).transactions).collect()}
    assert text.keys() == nums.keys()
    assert all(abs(float(text[m]) - nums[m] / 1e18) <= 5e-7 for m in nums)
    fm = q["format_metrics"](spark, small).first()
    assert fm["hex_chars"].replace(",", "").split(".")[0].isdigit()


def test_sums_past_64_bits(spark):
    """Monthly sums of gas prices pass 2**63 on a busy ledger."""
    from ledgerlens.streaming.monthly import monthly_stats, with_averages

    rows = [(1, 1, f"a{i % 2}", "c", 5 * 10**18, 5 * 10**18, 1_500_000_000 + i, 10, 4 * 10**18, 4 * 10**18) for i in range(4)]
    tx = spark.createDataFrame(
        rows, "block_number bigint, transaction_index bigint, from_address string, to_address string, gas bigint, "
              "gas_price bigint, block_timestamp bigint, v int, max_fee_per_gas bigint, max_priority_fee_per_gas bigint")
    tx = tx.withColumn("value", tx.v.cast("decimal(38,0)"))
    contracts = spark.createDataFrame([("c", True, False, 1)], "address string, is_erc20 boolean, is_erc721 boolean, block_number bigint")
    assert [r.avg_gas_price for r in L.monthly_gas_price(tx).collect()] == [5e18]
    assert [r.avg_gas for r in L.contract_gas_monthly(tx, contracts).collect()] == [5e18]
    assert [r.avg_gas for r in L.contract_gas_monthly(tx, contracts, max_broadcast_bytes=0).collect()] == [5e18]
    (r,) = L.contract_types(tx, contracts).collect()
    assert (r.total_gas, r.avg_gas_price, r.total_fees) == (20 * 10**18, 5e18, 32 * 10**18)
    assert with_averages(monthly_stats(tx)).first().avg_gas_price == 5e18
    assert {x.sender_avg_gas_price for x in W.wash_heuristics_sender_mean(tx).collect()} == {5e18}


def test_every_rule_decides_something(led):
    """The tables hold cases for each rule of the wash and contract-type jobs."""
    from pyspark.sql import functions as F

    g = W.prev_counterparty(led.transactions).cache()
    same = F.col("prev_to_address").eqNullSafe(F.col("to_address"))
    assert g.where("tx_count > 1").count() > 0
    assert g.where((F.col("tx_count") == 1) & same & (F.col("value") == 0) & (F.col("gas") > 21000)
                   & (F.col("gas_price") > 10**9)).count() >= 0
    assert g.where((F.col("value") == 0) & (F.col("gas") > 21000) & (F.col("gas_price") > 10**9)).count() > 0
    assert g.where("to_address is null").count() > 0
    assert W.wash_by_block_sender(led.transactions).count() > 100
    listed = led.contracts.select("address").distinct()
    received = L.value_by_address(led.transactions).join(listed, L.F.col("to_address") == listed.address)
    assert received.where("total_value = 0").count() > 0


def test_shuffle_partitions_follow_the_input():
    from ledgerlens.session import shuffle_partitions_for

    assert shuffle_partitions_for(10**9) == 4096
    assert shuffle_partitions_for(100 * 10**12) * (128 << 20) >= 100 * 10**12


def test_scratch_is_removed_and_caches_notice_changes(spark):
    from ledgerlens.session import _SCRATCH, path_version, remove_scratch, scratch_path, session_key
    from ledgerlens.sources import fixtures as FX

    held = _SCRATCH.pop(session_key(spark), [])
    try:
        root = scratch_path(spark, "tables")
        spark.range(5).write.parquet(f"{root}/orders.parquet")
        before = path_version(spark, f"{root}/orders.parquet")
        assert FX.table(spark, root, "orders").count() == 5
        spark.range(9).write.mode("overwrite").parquet(f"{root}/orders.parquet")
        assert path_version(spark, f"{root}/orders.parquet") != before
        assert FX.table(spark, root, "orders").count() == 9
        assert remove_scratch(spark) == 1 and remove_scratch(spark) == 0
        with pytest.raises(Exception):
            spark.read.parquet(f"{root}/orders.parquet").count()
    finally:
        _SCRATCH[session_key(spark)] = held


def test_client_without_a_shared_folder_is_an_error():
    from ledgerlens.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Remote:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(Remote())


def test_object_store_options():
    from ledgerlens.session import object_store_conf

    conf = object_store_conf("http://store:9000", "key", "secret", path_style=False, ssl=True)
    assert conf == {"spark.hadoop.fs.s3a.endpoint": "http://store:9000",
                    "spark.hadoop.fs.s3a.path.style.access": "false",
                    "spark.hadoop.fs.s3a.connection.ssl.enabled": "true",
                    "spark.hadoop.fs.s3a.access.key": "key", "spark.hadoop.fs.s3a.secret.key": "secret"}
    assert "spark.hadoop.fs.s3a.access.key" not in object_store_conf("http://store:9000")
