"""Broadcast and shuffle branches of the size-checked joins agree."""

import pytest

from ledgerlens.plans import ledger as L
from ledgerlens.plans import scams as S
from ledgerlens.sources.ledger import from_tables


def _same(a, b):
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.fixture(scope="module")
def led(spark, small):
    return from_tables(spark, small)


def test_services(led):
    _same(L.top10_services(led.transactions, led.contracts),
          L.top10_services(led.transactions, led.contracts, max_broadcast_bytes=0))


def test_contract_gas(led):
    _same(L.contract_gas_monthly(led.transactions, led.contracts),
          L.contract_gas_monthly(led.transactions, led.contracts, max_broadcast_bytes=0))


def test_scam_value_and_series(led):
    _same(S.value_by_scam(led.transactions, led.scams),
          S.value_by_scam(led.transactions, led.scams, max_broadcast_bytes=0))
    _same(S.scam_time_series(led.transactions, led.scams),
          S.scam_time_series(led.transactions, led.scams, max_broadcast_bytes=0))
    _same(S.scam_join(led.transactions, led.scams),
          S.scam_join(led.transactions, led.scams, max_broadcast_bytes=0))


def test_contract_types_bag_semantics(spark, led):
    """Pre-aggregated join equals the literal row-by-row inner join."""
    from pyspark.sql import functions as F

    from ledgerlens.functions import columns as C

    got = L.contract_types(led.transactions, led.contracts)
    t, c = led.transactions, led.contracts
    j = t.join(c, t["to_address"] == c["address"])
    ref = j.groupBy(c["address"]).agg(
        F.min(C.contract_type_label(c["is_erc20"], c["is_erc721"])).alias("contract_type"),
        F.count(F.lit(1)).alias("calls"), F.sum(t["value"]).alias("total_value"),
        F.sum(t["gas"]).alias("total_gas"),
        (F.sum(t["gas_price"]).cast("double") / F.count(t["gas_price"])).alias("avg_gas_price"),
        F.sum(C.fee_sum(t["max_fee_per_gas"], t["max_priority_fee_per_gas"])).alias("total_fees"),
        F.min(t["block_number"] - c["block_number"]).alias("contract_age"),
        F.min(C.interaction_kind(t["to_address"])).alias("interaction_kind"),
    ).where("total_value > 0")
    _same(got, ref.select(got.columns))
