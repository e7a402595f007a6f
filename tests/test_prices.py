"""Gas and gas prices keep their fraction, exactly, in every form of input."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.functions import parsing as P
from ledgerlens.plans import ledger as L
from ledgerlens.plans import wash as W
from ledgerlens.schemas import PRICE, TRANSACTION_FIELDS, TRANSACTIONS
from ledgerlens.session import scratch_path
from ledgerlens.sinks import writers as K
from ledgerlens.sources import ledger as src
from ledgerlens.sources import text as TX


def line(**changes):
    good = dict(zip(TRANSACTION_FIELDS, ["0xh", "1", "0xb", "7", "1", "a1", "c1", "5", "21000", "1000000000", "0x",
                                         "1500000000", "0", "0", "0"]))
    return ",".join({**good, **changes}.values())


def typed(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return src.all_transactions(TX.split_fields(df))


@pytest.mark.parametrize("text, want", [
    ("1.5", "1.5"), ("0.4", "0.4"), ("21000.7", "21000.7"), ("2.5e9", "2500000000"), (" 7 ", "7"),
    ("0.1234567894", "0.123456789"), ("0.1234567895", "0.123456790"), ("9223372036854775807", "9223372036854775807"),
    ("1e25", None), ("nan", None), ("abc", None), ("1d", None), ("", None), ("1_0", None)])
def test_spellings(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(P.to_price("t").alias("p"), P.is_price("t").alias("ok")).first()
    assert got.p == (None if want is None else Decimal(want)) and got.ok == (want is not None)


def test_fractions_count_as_such(spark):
    rows = typed(spark, [line(gas_price="1.5", gas="21000.7"), line(gas_price="0.4", gas="1.1")])
    assert L.monthly_gas_price(rows).first().avg_gas_price == 0.95
    contracts = spark.createDataFrame([("c1", True, False, 1)] * 2,
                                      "address string, is_erc20 boolean, is_erc721 boolean, block_number bigint")
    for bytes_ in (64 << 20, 0):
        assert L.contract_gas_monthly(rows, contracts, bytes_).first().avg_gas == 21001.8 / 2
        got = L.contract_types(rows, contracts, max_broadcast_bytes=bytes_).first()
        assert got.total_gas == Decimal("42003.6") and got.avg_gas_price == 0.95
    assert {r.avg_gas_price for r in W.transfer_groups(rows).collect()} == {1.5, 0.4}
    got = W.wash_heuristics_sender_mean(rows).collect()
    assert {r.sender_avg_gas_price for r in got} == {0.95} and {r.gas_price for r in got} == {Decimal("1.5"), Decimal("0.4")}


def test_sums_do_not_depend_on_the_order(spark):
    """Large and small prices mixed: the same bits however the rows are dealt."""
    lines = [line(gas_price=p) for p in ["0.1"] * 300 + ["123456789012345678.123456789"] * 7 + ["0.000000001"] * 50]
    want = (Decimal("0.1") * 300 + Decimal("123456789012345678.123456789") * 7 + Decimal("0.000000001") * 50)
    seen = set()
    for parts in (1, 3, 8):
        df = typed(spark, lines[parts:] + lines[:parts]).repartition(parts)
        sums = df.agg(*L.price_sums("gas_price", "s")).first()
        assert Decimal(sums.s) + Decimal(sums.s_nanos) / 10 ** 9 == want
        seen.add(L.monthly_gas_price(df).first().avg_gas_price)
    assert len(seen) == 1


@pytest.mark.parametrize("whole, nanos, want", [
    (5, 0, "5"), (5, 1, "5.000000001"), (5, 1_999_999_999, "6.999999999"), (0, 10 ** 27 - 1, "999999999999999999.999999999"),
    (10 ** 27, 999_999_999_999, "1000000000000000000000000999.999999999")])
def test_joined_price_is_exact(spark, whole, nanos, want):
    df = spark.createDataFrame([(Decimal(whole), Decimal(nanos))], "w decimal(38,0), n decimal(38,0)")
    assert df.select(C.joined_price(F.col("w"), F.col("n")).alias("p")).first().p == Decimal(want)


def test_every_reader_gives_the_schema(spark, small):
    tables = src.from_tables(spark, small)
    root, lines = scratch_path(spark, "typed"), scratch_path(spark, "lines")
    K.write_csv_lines(tables.transactions, TRANSACTION_FIELDS, lines)
    from_lines = src.all_transactions(TX.split_fields(spark.read.text(lines)))
    K.write_typed_ledger(from_lines, tables.blocks, tables.contracts, tables.scams, root)
    want = {f.name: f.dataType for f in TRANSACTIONS}
    assert want["gas"] == want["gas_price"] == PRICE
    for tx in (tables.transactions, from_lines, src.from_parquet(spark, root).transactions):
        assert want.items() <= {f.name: f.dataType for f in tx.schema}.items()
    month = L.monthly_gas_price(tables.transactions).collect()
    assert L.monthly_gas_price(src.checked(src.from_parquet(spark, root).transactions, "gas_price")).collect() == month
