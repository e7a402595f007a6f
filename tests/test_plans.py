"""Physical-plan properties the jobs rely on at scale."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import ledger as L
from ledgerlens.plans import scams as S
from ledgerlens.plans import wash as W
from ledgerlens.sources.ledger import from_tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def led(spark, small):
    return from_tables(spark, small)


def test_monthly_count_prunes_and_combines_map_side(led):
    p = plan(L.monthly_tx_count(led.transactions))
    assert "partial_count" in p
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    # only the join key and the timestamp of line items are read
    assert any(set(re.sub(r"#\d+L?", "", s).split(",")) == {"l_orderkey", "l_linenumber", "l_shipdate"} for s in scans)


def test_shuffle_join_path_aggregates_before_joining(spark, led):
    """With broadcasting off, transactions are reduced per key before the join."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for df in (L.top10_services(led.transactions, led.contracts, max_broadcast_bytes=0),
                   L.contract_gas_monthly(led.transactions, led.contracts, max_broadcast_bytes=0),
                   S.value_by_scam(led.transactions, led.scams, max_broadcast_bytes=0)):
            lines = plan(df).splitlines()
            j = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "to_address" in line)
            # the first (left, transactions) child of the join is an aggregate
            assert any("HashAggregate" in line and "sum(" in line for line in lines[j + 1:j + 4]), lines[j:j + 4]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_broadcast_path_broadcasts_the_small_side(led):
    p = plan(S.top10_scams(led.transactions, led.scams))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_j14_ranking_needs_no_window_or_sort_aggregate(led):
    p = plan(W.wash_top100(led.transactions))
    assert "Window" not in p and "SortAggregate" not in p and "TakeOrderedAndProject" in p


def test_contract_types_stays_hash_aggregated(led):
    p = plan(L.contract_types(led.transactions, led.contracts))
    assert "SortAggregate" not in p


def test_sender_window_is_split_into_buckets(led):
    p = plan(W.prev_counterparty(led.transactions))
    window = next(line for line in p.splitlines() if "Window [lag" in line and "__prev" in line)
    assert "__bucket" in window


def test_text_order_sort(spark, led):
    a = L.contract_gas_sorted(led.transactions, led.contracts, text_order=True).collect()
    texts = [str(r["avg_gas"]) for r in a]
    assert texts == sorted(texts, reverse=True)


@pytest.fixture(scope="module")
def typed(spark, led):
    """Typed copies on disk, as the jobs read them at scale (no fixture join)."""
    from ledgerlens.session import scratch_path

    def copy(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    return copy(led.transactions, "tx-copy"), copy(led.contracts, "contracts-copy"), copy(led.scams, "scams-copy")


def final_plan(df) -> str:
    """The adaptive plan after it has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_j14_deals_its_rows_once(typed):
    p = plan(W.wash_by_block_sender(typed[0]))
    assert p.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in p and "Window" not in p


def test_j13_has_one_large_exchange_and_one_scan(typed):
    for job in (W.wash_heuristics, W.wash_heuristics_sender_mean):
        p = final_plan(job(typed[0]))
        assert "SortAggregate" not in p
        scans = [x for x in p.splitlines() if "FileScan" in x]
        large = [x for x in p.splitlines() if "Exchange hashpartitioning" in x and "REPARTITION_BY_COL" in x
                 and "Reused" not in x]
        by_sender = [x for x in p.splitlines() if "Exchange hashpartitioning(__key" in x and "REPARTITION" not in x]
        assert len(scans) == 1 and len(large) == 1, p
        # what else is shuffled has one row per (sender, hour)
        assert len(by_sender) <= 2, p


def test_contract_filter_comes_before_the_first_exchange(typed):
    tx, contracts, scams = typed
    for df in (L.contract_types(tx, contracts), L.contract_age_range(tx, contracts),
               L.contract_totals(tx, contracts), S.scam_join(tx, scams)):
        lines = plan(df).splitlines()
        scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "block_timestamp" in x or
                    "FileScan" in x and "to_address" in x)
        semi = max(i for i, x in enumerate(lines[:scan]) if "LeftSemi" in x and "BroadcastHashJoin" in x)
        assert not any("Exchange hashpartitioning" in x for x in lines[semi:scan]), lines


def _nodes(plan):
    """Nodes of a physical plan, through adaptive stages."""
    name = plan.nodeName()
    yield plan
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.finalPhysicalPlan())
    elif name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
        yield from _nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _scans(plan):
    """Scan nodes with the rows each gave."""
    return [(n.simpleString(10_000), n.metrics().get("numOutputRows").get().value())
            for n in _nodes(plan) if "Scan parquet" in n.nodeName()]


def test_first_block_reads_the_wide_columns_of_few_blocks(spark, led):
    """The minimum comes from the number column; its filter prunes the wide scan."""
    from ledgerlens.plans import overhead as O
    from ledgerlens.session import scratch_path

    path = scratch_path(spark, "blocks-copy")
    led.blocks.repartitionByRange(8, "number").sortWithinPartitions("number").write.parquet(path)
    blocks = spark.read.parquet(path)
    total = blocks.count()
    df = O.data_overhead_first_block(blocks)
    got = df.collect()
    narrow = [x for x in final_plan(df).splitlines() if "FileScan" in x and "logs_bloom" not in x]
    assert narrow and all("ReadSchema: struct<number:bigint>" in x for x in narrow)
    qe = df._jdf.queryExecution()
    df.collect()
    wide = [(s, n) for s, n in _scans(qe.executedPlan()) if "logs_bloom" in s]
    assert len(wide) == 1 and 0 < wide[0][1] <= total // 4, (wide, total)
    # text numbers: the same two steps, the same result
    text = spark.createDataFrame(blocks.select(*[F.col(c).cast("string") for c in blocks.columns]).collect(),
                                 ", ".join(f"`{c}` string" for c in blocks.columns))
    assert O.data_overhead_first_block(text).collect() == got


def test_first_block_ties_nulls_and_no_rows(spark):
    from ledgerlens.plans import overhead as O

    def measure(rows):
        df = spark.createDataFrame(rows, "number bigint, logs_bloom string")
        return tuple(O.data_overhead_first_block(df, ["logs_bloom"]).first())[:2]

    assert measure([(7, "x" * 9), (3, "x" * 5), (3, "x" * 4), (None, "x")]) == (4, 3)
    assert measure([(None, "x")]) == (None, 0)
    assert measure([]) == (None, None)
