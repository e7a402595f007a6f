"""Figures of the saved reference results that our operators reproduce."""

from pyspark.sql import functions as F

from ledgerlens.plans.overhead import data_overhead_first_block
from ledgerlens.schemas import BLOCK_FIELDS, HEX_COLUMNS
from ledgerlens.sources.documents import parse_pair_list
from ledgerlens.sources.ledger import from_tables

# The saved storage-overhead results (MB, MB, percent).
SAVED_HEX_MB = 0.00018548965454101562
SAVED_REMAINING_MB = 45.670411109924316
SAVED_PCT = 0.00040614677352983407


def test_overhead_one_row_form_reproduces_saved_figures(spark):
    """Hex columns of one block (778 characters) against the block-number
    column of blocks 0..7,000,000."""
    widths = {"sha3_uncles": 66, "logs_bloom": 514, "transactions_root": 66,
              "state_root": 66, "receipts_root": 66}
    cols = []
    for c in BLOCK_FIELDS:
        if c == "number":
            cols.append(F.col("id").alias("number"))
        elif c in HEX_COLUMNS:
            cols.append(F.lit("f" * widths[c]).alias(c))
        else:
            cols.append(F.lit("x").alias(c))
    blocks = spark.range(0, 7_000_001, numPartitions=8).select(*cols)
    r = data_overhead_first_block(blocks).first()
    assert r["hex_chars"] == 778
    assert r["total_hex_mb"] == SAVED_HEX_MB
    assert r["remaining_mb"] == SAVED_REMAINING_MB
    assert abs(r["space_saved_pct"] - SAVED_PCT) < 1e-18


def test_fixture_first_block_hex_width(spark, small):
    r = data_overhead_first_block(from_tables(spark, small).blocks).first()
    assert r["hex_chars"] / 4 == 194.5


def test_pair_list_formats(spark):
    lines = spark.createDataFrame([
        ('[["09/2018", 16056742], ["06/2017", 7244657]]',),
        ('[[["5622", "Scamming"], 1.6709083588072888e+22], [["01/2018", "Phishing"], Infinity]]',),
    ], "value string")
    rows = parse_pair_list(lines).collect()
    assert rows[0]["key"] == "09/2018" and rows[0]["number"] == 16056742.0
    assert rows[2]["key"].replace(" ", "") == '["5622","Scamming"]'
    assert rows[2]["number"] == 1.6709083588072888e22
    assert rows[3]["number"] == float("inf")
    py = spark.createDataFrame([("[('0xaa', 84155363699941767867374641), ('0x77', 5)]",)], "value string")
    prow = parse_pair_list(py, python_literal=True).collect()
    assert prow[0]["key"] == "0xaa" and prow[0]["number"] == 8.415536369994177e25
