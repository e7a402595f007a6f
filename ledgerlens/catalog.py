"""Registry of every query: Spark builder + DuckDB oracle SQL.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
ledger tables derived from the driver tables in ``sf_dir``. ``SQL`` holds
the equivalent DuckDB statement (column names identical) for entries that
have one.

Names follow the operator inventory: jobs (``monthly_tx_count`` ...
``wash_top100``) run on the typed tables; ``valid_*`` / ``typed_*`` /
``split_*`` / ``scan_text_lines`` exercise the line checks on the written
text exports; ``*_text`` runs a job the way the original script did, on the
text export with that job's own line check; ``scan_*`` / ``sink_*`` /
``read_*`` round-trip through files under the session's checkpoint folder;
``stream_*`` runs through Structured Streaming.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle as O
from .plans import ledger as L
from .sources import ledger as src

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # month labels and epoch conversions are UTC throughout
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = O.with_views(sql)
        return fn
    return deco


M = O.month

# ---------------------------------------------------------------- J1 / A1 / E3

_J1_SQL = f"""
select {M('block_timestamp')} as month, count(*) as tx_count
from transactions where block_timestamp is not null group by 1"""


@register("monthly_tx_count", _J1_SQL)
def _monthly_tx_count(spark, sf):
    return L.monthly_tx_count(src.from_tables(spark, sf).transactions)


# ---------------------------------------------------------------- J2 / A2

@register("monthly_avg_value", f"""
select {M('block_timestamp')} as month, count(*) as tx_count, sum(value) as total_value,
       cast(sum(value) as double) / count(*) as avg_value
from transactions where block_timestamp is not null and value is not null group by 1""")
def _monthly_avg_value(spark, sf):
    return L.monthly_avg_value(src.from_tables(spark, sf).transactions)


# ---------------------------------------------------------------- J7 / A6 / T3

_GAS_PRICE_SQL = f"""
select {M('block_timestamp')} as month, count(*) as tx_count,
       {O.sql_mean('gas_price', 'count(*)')} as avg_gas_price
from transactions where block_timestamp is not null and gas_price is not null group by 1"""


def _gas_rank(order: str) -> str:
    return f"select *, row_number() over (order by {order}) as rank from ({_GAS_PRICE_SQL}) m"


@register("monthly_gas_price", _gas_rank("month"))
def _monthly_gas_price(spark, sf):
    return L.monthly_gas_price(src.from_tables(spark, sf).transactions)


@register("monthly_gas_price_sorted", _gas_rank("month[4:7], month[1:2]"))
def _monthly_gas_price_sorted(spark, sf):
    return L.monthly_gas_price(src.from_tables(spark, sf).transactions, chronological=True)


# ---------------------------------------------------------------- J3 / A3 / A4 / JN1 / T1

_CONTRACT_TOTALS = """
select to_address as address, sum(value) as total_value from transactions
where to_address is not null and value is not null
  and to_address in (select address from contracts where address is not null)
group by 1"""


@register("top10_services", _CONTRACT_TOTALS + "\norder by total_value desc, address limit 10")
def _top10_services(spark, sf):
    d = src.from_tables(spark, sf)
    return L.top10_services(d.transactions, d.contracts)


@register("semi_join_contracts", _CONTRACT_TOTALS)
def _semi_join_contracts(spark, sf):
    d = src.from_tables(spark, sf)
    return L.contract_totals(d.transactions, d.contracts)


@register("value_by_address", """
select to_address, sum(value) as total_value from transactions
where to_address is not null and value is not null group by 1""")
def _value_by_address(spark, sf):
    return L.value_by_address(src.from_tables(spark, sf).transactions)


@register("distinct_contracts", """
select distinct address from contracts where address is not null""")
def _distinct_contracts(spark, sf):
    from pyspark.sql import functions as F

    c = src.from_tables(spark, sf).contracts
    return c.where(F.col("address").isNotNull()).select("address").dropDuplicates(["address"])


# ---------------------------------------------------------------- J4 / A5

_MINER_SQL = """
select miner, cast(sum(size) as bigint) as total_size from blocks
where miner is not null and size is not null group by miner"""


@register("size_by_miner", _MINER_SQL)
def _size_by_miner(spark, sf):
    return L.size_by_miner(src.from_tables(spark, sf).blocks)


@register("top10_miners", _MINER_SQL + "\norder by total_size desc, miner limit 10")
def _top10_miners(spark, sf):
    return L.top10_miners(src.from_tables(spark, sf).blocks)


# ---------------------------------------------------------------- J8 / JN2 / A7 / T4

_CONTRACT_GAS = f"""
select {M('t.block_timestamp')} as month, count(*) as tx_count,
       {O.sql_mean('t.gas', 'count(*)')} as avg_gas
from transactions t join contracts c on t.to_address = c.address
where t.block_timestamp is not null and t.gas is not null group by 1"""


@register("contract_gas_monthly", _CONTRACT_GAS)
def _contract_gas_monthly(spark, sf):
    d = src.from_tables(spark, sf)
    return L.contract_gas_monthly(d.transactions, d.contracts)


@register("contract_gas_sorted", f"select *, row_number() over (order by avg_gas desc, month) as rank from ({_CONTRACT_GAS}) m")
def _contract_gas_sorted(spark, sf):
    d = src.from_tables(spark, sf)
    return L.contract_gas_sorted(d.transactions, d.contracts)


# ---------------------------------------------------------------- J5 / JN5 / A10 / E10-E13 / F14

_TYPE_LABEL_SQL = ("case when {a} and {b} then 'ERC20+ERC721' when {a} then 'ERC20' "
                   "when {b} then 'ERC721' else 'Other' end")


def _contract_types_sql(key: str) -> str:
    label = _TYPE_LABEL_SQL.format(a="c.is_erc20", b="c.is_erc721")
    return f"""
select c.address as address, min({label}) as contract_type,
       count(*) as calls, cast(sum(t.value) as decimal(38,0)) as total_value,
       cast(sum(t.gas) as decimal(38,9)) as total_gas,
       {O.sql_mean('t.gas_price', 'count(t.gas_price)')} as avg_gas_price,
       cast(sum(coalesce(t.max_fee_per_gas, 0) + coalesce(t.max_priority_fee_per_gas, 0)) as decimal(38,0)) as total_fees,
       min(t.block_number - c.block_number) as contract_age,
       min(case when t.to_address is null or trim(t.to_address) = '' then 'Contract Creation'
                else 'Contract Interaction' end) as interaction_kind
from transactions t join contracts c on t.{key} = c.address
group by c.address having sum(t.value) > 0"""


@register("contract_types", _contract_types_sql("to_address"))
def _contract_types(spark, sf):
    d = src.from_tables(spark, sf)
    return L.contract_types(d.transactions, d.contracts)


@register("contract_types_by_sender", _contract_types_sql("from_address"))
def _contract_types_by_sender(spark, sf):
    d = src.from_tables(spark, sf)
    return L.contract_types(d.transactions, d.contracts, side="from")


@register("contract_type_label", f"""
select address, block_number, {_TYPE_LABEL_SQL.format(a='is_erc20', b='is_erc721')} as contract_type,
       case when is_erc20 or is_erc721
            then concat(cast(cast(is_erc20 as integer) as varchar), cast(cast(is_erc721 as integer) as varchar))
            else 'Other' end as type_code
from contracts""")
def _contract_type_label(spark, sf):
    from .functions import columns as C

    c = src.from_tables(spark, sf).contracts
    return c.select("address", "block_number",
                    C.contract_type_label("is_erc20", "is_erc721").alias("contract_type"),
                    C.contract_type_code("is_erc20", "is_erc721").alias("type_code"))


@register("contract_age", """
select c.address as address, min(t.block_number - c.block_number) as min_age,
       max(t.block_number - c.block_number) as max_age
from transactions t join contracts c on t.to_address = c.address
where t.block_number is not null and c.block_number is not null group by c.address""")
def _contract_age(spark, sf):
    d = src.from_tables(spark, sf)
    return L.contract_age_range(d.transactions, d.contracts)


@register("month_label", f"""
select number, {M('timestamp')} as month,
       strftime(make_timestamp(cast(timestamp as bigint) * 1000000), '%Y-%m') as month_key
from blocks where timestamp is not null""")
def _month_label(spark, sf):
    from pyspark.sql import functions as F
    from .functions import columns as C

    b = src.from_tables(spark, sf).blocks.where(F.col("timestamp").isNotNull())
    return b.select("number", C.month_label("timestamp").alias("month"),
                    F.date_format(C.month_start("timestamp"), "yyyy-MM").alias("month_key"))


# ---------------------------------------------------------------- J9 / J10 / JN3 / JN4 / A8 / A9

from .plans import scams as S  # noqa: E402
from .plans import wash as W  # noqa: E402

_SCAM_VALUE = """
select s.id as id, s.category as category, sum(t.value) as total_value
from transactions t join scams s on t.to_address = s.address
where t.to_address is not null and t.value is not null and s.address is not null
group by 1, 2"""


@register("value_by_scam", _SCAM_VALUE)
def _value_by_scam(spark, sf):
    d = src.from_tables(spark, sf)
    return S.value_by_scam(d.transactions, d.scams)


@register("top10_scams", _SCAM_VALUE + "\norder by total_value desc, id, category limit 10")
def _top10_scams(spark, sf):
    d = src.from_tables(spark, sf)
    return S.top10_scams(d.transactions, d.scams)


SQL_RAW_SCAM_SERIES = f"""
select {M('t.block_timestamp')} as month, s.category as category, sum(t.value) as total_value
from transactions t join scams s on t.to_address = s.address
where t.to_address is not null and t.value is not null and t.block_timestamp is not null
group by 1, 2"""


@register("scam_time_series", SQL_RAW_SCAM_SERIES)
def _scam_time_series(spark, sf):
    d = src.from_tables(spark, sf)
    return S.scam_time_series(d.transactions, d.scams)


@register("scam_join", """
select s.id as id, s.category as category, s.address as address, t.tx_count as tx_count,
       t.total_value as total_value
from (select to_address, count(*) as tx_count, sum(value) as total_value from transactions
      where to_address is not null and value is not null group by 1) t
join scams s on t.to_address = s.address""")
def _scam_join(spark, sf):
    d = src.from_tables(spark, sf)
    return S.scam_join(d.transactions, d.scams)


_CATEGORY_MAP_SQL = {
    "scam_category": "case when category = 'Scam' then 'Scamming' else category end",
    "scam_category_rollup": "case when category in ('Phishing', 'Fake ICO', 'Scamming') then 'Scam' else category end",
}


@register("scam_category", f"""
select id, address, category as original_category, {_CATEGORY_MAP_SQL['scam_category']} as category
from scams""")
def _scam_category(spark, sf):
    from .functions import columns as C

    s = src.from_tables(spark, sf).scams
    return s.select("id", "address", s["category"].alias("original_category"),
                    C.relabel_category("category").alias("category"))


@register("scam_category_rollup", f"""
select id, address, category as original_category, {_CATEGORY_MAP_SQL['scam_category_rollup']} as category
from scams""")
def _scam_category_rollup(spark, sf):
    from .functions import columns as C

    s = src.from_tables(spark, sf).scams
    return s.select("id", "address", s["category"].alias("original_category"),
                    C.rollup_category("category").alias("category"))


# ---------------------------------------------------------------- J13 / A11 / W1 / F12 / T5

_GROUPS = f"""
g as (select from_address, to_address, value, gas, gas_price, block_timestamp, count(*) as tx_count,
             {O.sql_mean('gas_price', 'count(gas_price)')} as avg_gas_price
      from transactions group by from_address, to_address, value, gas, gas_price, block_timestamp),
l as (select *, lag(to_address) over (partition by from_address
          order by block_timestamp nulls first, to_address nulls first, value nulls first,
                   gas nulls first, gas_price nulls first) as prev_to_address from g)"""


def _heuristics_sql(avg: str) -> str:
    return (f"coalesce(tx_count > 1 or gas_price > {avg} * 1.5 "
            "or (value = 0 and gas > 21000 and gas_price > 1000000000) "
            "or prev_to_address is null or prev_to_address <> to_address, false)")


_OUT_COLS = ("from_address, to_address, value, gas, gas_price, block_timestamp, tx_count, "
             "prev_to_address")


@register("transfer_groups", "with " + _GROUPS.split("),\nl as")[0].strip() + ")\nselect * from g")
def _transfer_groups(spark, sf):
    return W.transfer_groups(src.from_tables(spark, sf).transactions)


@register("prev_counterparty", "with " + _GROUPS + "\nselect * from l")
def _prev_counterparty(spark, sf):
    return W.prev_counterparty(src.from_tables(spark, sf).transactions)


@register("wash_heuristics", "with " + _GROUPS +
          f"\nselect {_OUT_COLS} from l where {_heuristics_sql('avg_gas_price')}")
def _wash_heuristics(spark, sf):
    return W.wash_heuristics(src.from_tables(spark, sf).transactions)


@register("wash_heuristics_sender_mean", "with " + _GROUPS + f""",
s as (select from_address as sender, {O.sql_mean('gas_price', 'count(gas_price)')} as sender_avg_gas_price
      from transactions group by 1)""" +
          f"\nselect {_OUT_COLS}, sender_avg_gas_price from l join s on l.from_address is not distinct from s.sender"
          f"\nwhere {_heuristics_sql('sender_avg_gas_price')}")
def _wash_heuristics_sender_mean(spark, sf):
    return W.wash_heuristics_sender_mean(src.from_tables(spark, sf).transactions)


@register("wash_heuristics_50", "with " + _GROUPS +
          f"\nselect from_address, to_address, value from l where {_heuristics_sql('avg_gas_price')}"
          "\norder by from_address nulls first, to_address nulls first, value nulls first, "
          "gas nulls first, gas_price nulls first, block_timestamp nulls first limit 50")
def _wash_heuristics_50(spark, sf):
    return W.wash_heuristics_50(src.from_tables(spark, sf).transactions)


# ---------------------------------------------------------------- J14 / W2 / F13 / A12 / T2

_RUNNING = """
c as (select block_number, from_address, to_address, value, block_timestamp,
             count(*) over (partition by block_number, from_address, to_address, value
                            order by block_timestamp nulls first) as block_count
      from transactions where block_number is not null and value is not null),
f as (select * from c where coalesce(block_count > 1 or from_address = to_address, false))"""

_RUNNING_COLS = ("\nselect block_number, from_address, to_address, value, block_timestamp, count(*) as n, "
                 "block_count from {} group by all")


@register("running_transfer_count", "with " + _RUNNING + _RUNNING_COLS.format("c"))
def _running_transfer_count(spark, sf):
    return W.running_transfer_count(src.from_tables(spark, sf).transactions)


@register("wash_flagged", "with " + _RUNNING + _RUNNING_COLS.format("f"))
def _wash_flagged(spark, sf):
    return W.wash_flagged(src.from_tables(spark, sf).transactions)


_BY_BLOCK_SENDER = ("\nselect block_number, from_address, cast(sum(value) as decimal(38,0)) as total_value"
                    " from f group by 1, 2")


@register("wash_by_block_sender", "with " + _RUNNING + _BY_BLOCK_SENDER)
def _wash_by_block_sender(spark, sf):
    return W.wash_by_block_sender(src.from_tables(spark, sf).transactions)


@register("wash_top100", "with " + _RUNNING + _BY_BLOCK_SENDER +
          "\norder by total_value desc, block_number, from_address limit 100")
def _wash_top100(spark, sf):
    return W.wash_top100(src.from_tables(spark, sf).transactions)


# ---------------------------------------------------------------- text path: S1 / E1 / E4 / F1-F10

from .operators import validate as V  # noqa: E402
from .sources import fixtures as FX  # noqa: E402
from .sources import text as TX  # noqa: E402


def _tx_split(spark, sf):
    return TX.split_fields(FX.as_text_file(spark, sf, "transactions", FX.transaction_lines))


@register("scan_text_lines", "select value, len(string_split(value, ',')) as n_fields from tx_lines")
def _scan_text_lines(spark, sf):
    from pyspark.sql import functions as F

    return _tx_split(spark, sf).select("value", F.size("fields").cast("bigint").alias("n_fields"))


@register("split_fields", f"""
select len(fields) as n_fields, {O.f(3)} as block_number, {O.f(5)} as from_address,
       {O.f(6)} as to_address, {O.f(7)} as value, {O.f(11)} as block_timestamp
from tx_split""")
def _split_fields(spark, sf):
    from pyspark.sql import functions as F

    s = _tx_split(spark, sf)
    return s.select(F.size("fields").cast("bigint").alias("n_fields"), TX.field(3).alias("block_number"),
                    TX.field(5).alias("from_address"), TX.field(6).alias("to_address"),
                    TX.field(7).alias("value"), TX.field(11).alias("block_timestamp"))


@register("typed_transactions", f"select {O.typed_tx_cols()} from tx_split where len(fields) = 15")
def _typed_transactions(spark, sf):
    return TX.typed_transactions(_tx_split(spark, sf).where(V.tx_arity()))


_TX_CHECKS = {
    "valid_tx_arity": V.tx_arity,
    "valid_tx_value_ts": V.tx_value_ts,
    "valid_tx_block_digits": V.tx_block_digits,
    "valid_tx_gas_price": V.tx_gas_price,
    "valid_tx_block_value": V.tx_block_value,
    "valid_tx_full": V.tx_full,
    "valid_tx_digits_value": V.tx_digits_value,
}
_TX_PRED_SQL = O.tx_predicates()


def _register_tx_check(name, pred):
    @register(name, f"select {O.typed_tx_cols()} from tx_split where {_TX_PRED_SQL[name]}")
    def _q(spark, sf):
        return TX.typed_transactions(_tx_split(spark, sf).where(pred()))


for _n, _p in _TX_CHECKS.items():
    _register_tx_check(_n, _p)


@register("valid_contract_arity", f"""
select {O.typed_contract_cols()} from contract_split where len(fields) = 6 and {O.f(0)} <> 'address'""")
def _valid_contract_arity(spark, sf):
    s = TX.split_fields(FX.as_text_file(spark, sf, "contracts", FX.contract_lines))
    return TX.typed_contracts(s.where(V.contract_arity() & (TX.field(0) != "address")))


@register("valid_block", f"""
select {O.typed_block_cols()} from block_split where len(fields) = 19 and {O.f(1)} <> 'hash'""")
def _valid_block(spark, sf):
    s = TX.split_fields(FX.as_text_file(spark, sf, "blocks", FX.block_lines))
    return TX.typed_blocks(s.where(V.block_line()))


@register("valid_scam_line", f"""
select {O.typed_scam_cols()} from scam_split where len(fields) = 9 and {O.sql_is_int(O.f(0))}""")
def _valid_scam_line(spark, sf):
    s = TX.split_scam_fields(FX.as_text_file(spark, sf, "scams", FX.scam_lines))
    return TX.typed_scams(s.where(V.scam_line()))


@register("interaction_kind", f"""
select case when to_address is null or trim(to_address) = '' then 'Contract Creation'
            else 'Contract Interaction' end as interaction_kind, count(*) as tx_count
from (select {O.typed_tx_cols()} from tx_split where {_TX_PRED_SQL['valid_tx_full']}) t
group by 1""")
def _interaction_kind(spark, sf):
    from pyspark.sql import functions as F
    from .functions import columns as C

    t = TX.typed_transactions(_tx_split(spark, sf).where(V.tx_full()))
    return t.groupBy(C.interaction_kind("to_address").alias("interaction_kind")) \
        .agg(F.count(F.lit(1)).alias("tx_count"))


@register("tx_pairs", f"""
select from_address, to_address, value
from (select {O.typed_tx_cols()} from tx_split where {_TX_PRED_SQL['valid_tx_digits_value']}) t""")
def _tx_pairs(spark, sf):
    t = TX.typed_transactions(_tx_split(spark, sf).where(V.tx_digits_value()))
    return S.tx_pairs(t)


@register("avg_value_text", f"""
select {M('block_timestamp')} as month,
       printf('%.6f', cast(sum(value) as double) / count(*) / 1e18) as avg_value_text
from transactions where block_timestamp is not null and value is not null group by 1""")
def _avg_value_text(spark, sf):
    """E5: the monthly mean as text, in whole coins with six decimals."""
    from pyspark.sql import functions as F

    m = L.monthly_avg_value(src.from_tables(spark, sf).transactions)
    return m.select("month", F.format_string("%.6f", F.col("avg_value") / F.lit(1e18)).alias("avg_value_text"))


@register("select_columns", "select to_address, gas, block_timestamp from transactions")
def _select_columns(spark, sf):
    """Column selection; only these three columns are read from the scan."""
    return src.from_tables(spark, sf).transactions.select("to_address", "gas", "block_timestamp")


# ---------------------------------------------------------------- scam registry: S4 / S5 / E2 / E7 / E9 / F11 / J11 / J12

from .plans import overhead as OV  # noqa: E402
from .session import scratch_path  # noqa: E402
from .sinks import writers as K  # noqa: E402
from .sources import documents as D  # noqa: E402

_ATTRS = "id, name, url, coin, category, subcategory, status"
_ENTRY_SQL = f"""
select min(address) as key, id, name, url, coin, category, subcategory, count(*) as n_addresses, status
from scams group by {_ATTRS}"""


def _entry_cols(entries):
    from pyspark.sql import functions as F

    r = F.col("record")
    return entries.select("key", r["id"].alias("id"), r["name"].alias("name"), r["url"].alias("url"),
                          r["coin"].alias("coin"), r["category"].alias("category"),
                          r["subcategory"].alias("subcategory"),
                          F.size(r["addresses"]).cast("bigint").alias("n_addresses"),
                          r["status"].alias("status"))


def _write_documents(spark, sf) -> str:
    return FX.written_once(spark, sf, "scam-registry", lambda p: FX.scam_documents(spark, sf).write.text(p))


@register("scan_scam_document", _ENTRY_SQL)
def _scan_scam_document(spark, sf):
    return _entry_cols(D.read_scam_registry(spark, _write_documents(spark, sf)))


@register("scan_scam_document_whole", _ENTRY_SQL.replace("min(address) as key", "concat(min(address), '-', id) as key"))
def _scan_scam_document_whole(spark, sf):
    """The registry as one document of several lines, with text ids."""
    path = FX.written_once(spark, sf, "scam-registry-whole",
                           lambda p: FX.scam_document_whole(spark, sf).write.text(p))
    return _entry_cols(D.read_scam_registry(spark, path, whole_file=True))


@register("scan_json", _ENTRY_SQL)
def _scan_json(spark, sf):
    return _entry_cols(D.registry_entries(D.read_json(spark, _write_documents(spark, sf))))


@register("valid_scam_record", """
select min(address) as key, id, category, count(*) as n_addresses
from scams where id is not null and category is not null group by """ + _ATTRS)
def _valid_scam_record(spark, sf):
    from pyspark.sql import functions as F

    # registry records of which six lack something required
    bad = spark.createDataFrame([(x,) for x in FX.BAD_REGISTRY_DOCUMENTS], "value string")
    e = S.parse_documents(FX.scam_documents(spark, sf).unionAll(bad))
    ok = e.where(V.valid_scam_record("record"))
    return ok.select("key", F.col("record.id").alias("id"), F.col("record.category").alias("category"),
                     F.size("record.addresses").cast("bigint").alias("n_addresses"))


_FLAT_SQL = f"""
select id as identity, name, url, coin, {_CATEGORY_MAP_SQL['scam_category']} as category,
       coalesce(subcategory, '') as subcategory, index, status, address
from scam_indexed"""


@register("scam_flatten", _FLAT_SQL)
def _scam_flatten(spark, sf):
    return S.flatten_registry(S.parse_documents(FX.scam_documents(spark, sf)))


@register("scam_pairs", f"""
select id, min(address) as first_address, max(address) as last_address, coin,
       {_CATEGORY_MAP_SQL['scam_category_rollup']} as category_group
from scams group by {_ATTRS}""")
def _scam_pairs(spark, sf):
    return S.scam_pairs(S.parse_documents(FX.scam_documents(spark, sf)))


# ---------------------------------------------------------------- J6 / E14-E16 / A13 / A14 / T6 / S3

def _len_sql(c: str) -> str:
    return f"coalesce(length(cast({c} as varchar)), 0)"


def _overhead_sql(first_block: bool) -> str:
    from .schemas import BLOCK_FIELDS, HEX_COLUMNS

    rest = [c for c in BLOCK_FIELDS if c not in HEX_COLUMNS]
    hex_row = " + ".join(_len_sql(c) for c in HEX_COLUMNS)
    rest_row = " + ".join(_len_sql(c) for c in rest)
    if first_block:
        sums = (f"select cast(arg_min({hex_row}, number) as bigint) as hex_chars, "
                f"cast(sum({_len_sql(rest[0])}) as bigint) as remaining_bytes from blocks")
    else:
        sums = (f"select cast(sum({hex_row}) as bigint) as hex_chars, "
                f"cast(sum({rest_row}) as bigint) as remaining_bytes from blocks")
    hex_mb = "(hex_chars / 4 / 1048576)"
    rest_mb = "(remaining_bytes / 1048576)"
    return (f"select hex_chars, remaining_bytes, {hex_mb} as total_hex_mb, {rest_mb} as remaining_mb, "
            f"{hex_mb} / ({hex_mb} + {rest_mb}) * 100 as space_saved_pct from ({sums}) s")


@register("data_overhead", _overhead_sql(False))
def _data_overhead(spark, sf):
    return OV.data_overhead(src.from_tables(spark, sf).blocks)


@register("data_overhead_first_block", _overhead_sql(True))
def _data_overhead_first_block(spark, sf):
    return OV.data_overhead_first_block(src.from_tables(spark, sf).blocks)


@register("scan_csv_infer", _overhead_sql(False))
def _scan_csv_infer(spark, sf):
    """S3: blocks written as CSV with header, read back with schema inference."""
    b = src.from_tables(spark, sf).blocks
    path = FX.written_once(spark, sf, "blocks-csv", lambda p: K.write_csv_header(b, b.columns, p, large=True))
    return OV.data_overhead(D.read_csv(spark, path, infer=True))


@register("scan_csv_header", "select * from transactions")
def _scan_csv_header(spark, sf):
    """Transactions as CSV with header, read back as text columns, then typed."""
    from pyspark.sql import functions as F
    from .functions import parsing as P
    from .schemas import TRANSACTION_FIELDS, TRANSACTIONS, all_strings

    tx = src.from_tables(spark, sf).transactions
    path = FX.written_once(spark, sf, "transactions-csv", lambda p: K.write_csv_header(tx, TRANSACTION_FIELDS, p, large=True))
    raw = D.read_csv(spark, path, schema=all_strings(TRANSACTION_FIELDS))
    cast = {"value": P.to_wei, "gas": P.to_price, "gas_price": P.to_price}
    cols = []
    for fld in TRANSACTIONS.fields:
        c = F.col(fld.name)
        if fld.name in cast:
            cols.append(cast[fld.name](c).alias(fld.name))
        elif fld.dataType.typeName() in ("long", "integer"):
            cols.append(P.to_long(c).cast(fld.dataType).alias(fld.name))
        else:
            cols.append(c.alias(fld.name))
    return raw.select(*cols)


# ---------------------------------------------------------------- sinks: K1-K4, K6; result readers: S6, S7

@register("sink_json", _J1_SQL)
def _sink_json(spark, sf):
    path = scratch_path(spark, "monthly-tx-count-json")
    K.write_json(L.monthly_tx_count(src.from_tables(spark, sf).transactions), path)
    return D.read_json(spark, path, "month string, tx_count bigint")


_J2_SQL = f"""
select {M('block_timestamp')} as month, count(*) as tx_count, sum(value) as total_value
from transactions where block_timestamp is not null and value is not null group by 1"""


@register("sink_csv_lines", f"""
select concat_ws(',', month, cast(tx_count as varchar), cast(total_value as varchar)) as value
from ({_J2_SQL}) m""")
def _sink_csv_lines(spark, sf):
    path = scratch_path(spark, "monthly-value-lines")
    K.write_csv_lines(L.monthly_avg_value(src.from_tables(spark, sf).transactions),
                      ["month", "tx_count", "total_value"], path)
    return spark.read.text(path)


@register("read_csv_result", _J2_SQL)
def _read_csv_result(spark, sf):
    path = scratch_path(spark, "monthly-value-result")
    K.write_csv_lines(L.monthly_avg_value(src.from_tables(spark, sf).transactions),
                      ["month", "tx_count", "total_value"], path)
    return D.read_csv_result(spark, path, "month string, tx_count bigint, total_value decimal(38,0)")


@register("sink_csv_header", _FLAT_SQL)
def _sink_csv_header(spark, sf):
    from .schemas import SCAM_CSV_FIELDS

    path = scratch_path(spark, "scams-csv")
    flat = S.flatten_registry(S.parse_documents(FX.scam_documents(spark, sf)))
    K.write_csv_header(flat, [*SCAM_CSV_FIELDS, "address"], path)
    schema = ("identity bigint, name string, url string, coin string, category string, "
              "subcategory string, index bigint, status string, address string")
    from pyspark.sql import functions as F

    back = D.read_csv(spark, path, schema=schema)
    # an empty field reads back as null; the flat table writes '' for "none"
    return back.withColumn("subcategory", F.coalesce("subcategory", F.lit("")))


@register("scam_registry_to_value", f"""
select s.id as id, s.category as category, sum(t.value) as total_value
from transactions t join (select id, {_CATEGORY_MAP_SQL['scam_category']} as category, address from scams) s
  on t.to_address = s.address
where t.to_address is not null and t.value is not null group by 1, 2""")
def _scam_registry_to_value(spark, sf):
    """J11's file read by J9: registry -> nine-field lines -> value by scam."""
    path = scratch_path(spark, "scam-lines")
    K.write_scam_lines(S.flatten_registry(S.parse_documents(FX.scam_documents(spark, sf))), path)
    listed = TX.typed_scams(TX.split_scam_fields(TX.read_lines(spark, path)).where(V.scam_line()))
    return S.value_by_scam(src.from_tables(spark, sf).transactions, listed)


@register("scam_lines_keep_text", f"""
select id, name || ', "the" shop' as name, url || ',x' as url,
       {_CATEGORY_MAP_SQL['scam_category']} as category, address from scams""")
def _scam_lines_keep_text(spark, sf):
    """K3: names and addresses of sites with commas and quotes, written as lines and read back."""
    from pyspark.sql import functions as F

    docs = FX.scam_documents(spark, sf)
    flat = S.flatten_registry(S.parse_documents(docs)).withColumns(
        {"name": F.concat("name", F.lit(', "the" shop')), "url": F.concat("url", F.lit(",x"))})
    path = scratch_path(spark, "scam-lines-text")
    K.write_scam_lines(flat, path)
    listed = TX.typed_scams(TX.split_scam_fields(TX.read_lines(spark, path)).where(V.scam_line()))
    return listed.select("id", "name", "url", "category", "address")


@register("sink_stamped_json", _J1_SQL)
def _sink_stamped_json(spark, sf):
    """K5: the monthly counts under a run-stamped folder, read back from there."""
    path = K.run_stamped_path(scratch_path(spark, "results"), "monthly-count")
    K.write_json(L.monthly_tx_count(src.from_tables(spark, sf).transactions), path)
    return D.read_json(spark, path, "month string, tx_count bigint")


@register("sink_metrics", _overhead_sql(False))
def _sink_metrics(spark, sf):
    path = scratch_path(spark, "overhead-metrics")
    K.write_json(OV.data_overhead(src.from_tables(spark, sf).blocks), path)
    return D.read_json(spark, path, "hex_chars bigint, remaining_bytes bigint, total_hex_mb double, "
                                    "remaining_mb double, space_saved_pct double")


@register("read_pair_list", f"""
select miner as key, cast(total_size as double) as number from ({_MINER_SQL}
order by total_size desc, miner limit 10) t""")
def _read_pair_list(spark, sf):
    path = scratch_path(spark, "top10-miners-pairs")
    K.write_pair_list(L.top10_miners(src.from_tables(spark, sf).blocks), ["miner"], "total_size", path)
    return D.read_pair_list(spark, path)


@register("format_metrics", "select "
          + ", ".join(f"format('{{:,.2f}}', cast({m} as double)) as {m}" for m in (
              "hex_chars", "remaining_bytes", "total_hex_mb", "remaining_mb", "space_saved_pct"))
          + f" from ({_overhead_sql(False)}) m")
def _format_metrics(spark, sf):
    """K6: the overhead metrics as formatted text."""
    return K.format_metrics(OV.data_overhead(src.from_tables(spark, sf).blocks))


# ---------------------------------------------------------------- streaming: J1 / J2 / J7 over arriving files

def _lines_in_files(spark, sf):
    # the export arriving as the files its tasks write
    return FX.transaction_lines(spark, sf)


@register("stream_monthly_stats", f"""
with j1 as (select {M('block_timestamp')} as month, count(*) as tx_count
            from (select {O.typed_tx_cols()} from tx_split where len(fields) = 15 and {O.sql_is_int(O.f(11))}) group by 1),
j2 as (select {M('block_timestamp')} as month, sum(value) as total_value,
              cast(sum(value) as double) / count(*) as avg_value
       from (select {O.typed_tx_cols()} from tx_split where {_TX_PRED_SQL['valid_tx_value_ts']}) group by 1),
j7 as (select {M('block_timestamp')} as month, {O.sql_mean('gas_price', 'count(*)')} as avg_gas_price
       from (select {O.typed_tx_cols()} from tx_split where {_TX_PRED_SQL['valid_tx_gas_price']})
       where gas_price is not null group by 1)
select month, tx_count, total_value, avg_value, avg_gas_price
from j1 left join j2 using (month) left join j7 using (month)""")
def _stream_monthly_stats(spark, sf):
    """J1/J2/J7 maintained by a streaming aggregation, a few files per core and micro-batch."""
    from .streaming import monthly as SM

    src_dir = scratch_path(spark, "tx-arrivals")
    K.compressed(_lines_in_files(spark, sf)).text(src_dir)
    out, ckpt = scratch_path(spark, "monthly-changelog"), scratch_path(spark, "monthly-stream-ckpt")
    stats = SM.monthly_stats(SM.transaction_stream(spark, src_dir, SM.files_per_batch(spark)))
    q = SM.start_monthly_changelog(stats, out, ckpt)
    q.awaitTermination()
    return SM.with_averages(SM.read_latest(spark, out))


# ---------------------------------------------------------------- jobs as run on the text exports
# Each original job read the CSV text and kept the lines its own check
# accepted; these variants run the same plans on the written text exports.

import re as _re  # noqa: E402



def _tx_text(spark, sf, check):
    return TX.typed_transactions(_tx_split(spark, sf).where(V.TX_CHECKS[check][0]()))


def _contracts_text(spark, sf):
    s = TX.split_fields(FX.as_text_file(spark, sf, "contracts", FX.contract_lines))
    return TX.typed_contracts(s.where(V.contract_arity() & (TX.field(0) != "address")))


def _scams_text(spark, sf):
    return TX.typed_scams(TX.split_scam_fields(FX.as_text_file(spark, sf, "scams", FX.scam_lines))
                          .where(V.scam_line()))


def _typed_blocks(lines):
    return TX.typed_blocks(TX.split_fields(lines).where(V.block_line()))


def _blocks_text(spark, sf):
    return _typed_blocks(FX.as_text_file(spark, sf, "blocks", FX.block_lines))


_TSF = O.f(11)
_TEXT_TX_SQL = {
    "tx_text_ts": f"len(fields) = 15 and {O.sql_is_int(_TSF)}",
    "tx_text_value_ts": _TX_PRED_SQL["valid_tx_value_ts"],
    "tx_text_services": f"{_TX_PRED_SQL['valid_tx_block_digits']} and {O.sql_is_big_int(O.f(7))}",
    "tx_text_gas_price": _TX_PRED_SQL["valid_tx_gas_price"],
    "tx_text_full": _TX_PRED_SQL["valid_tx_full"],
    "tx_text_block_value": _TX_PRED_SQL["valid_tx_block_value"],
}
for _name, _pred in _TEXT_TX_SQL.items():
    O.DERIVED[_name] = f"select {O.typed_tx_cols()} from tx_split where {_pred}"
O.DERIVED["contracts_text"] = (f"select {O.typed_contract_cols()} from contract_split "
                               f"where len(fields) = 6 and {O.f(0)} <> 'address'")
O.DERIVED["scams_text"] = (f"select {O.typed_scam_cols()} from scam_split "
                           f"where len(fields) = 9 and {O.sql_is_int(O.f(0))}")
O.DERIVED["blocks_text"] = (f"select {O.typed_block_cols()} from block_split "
                            f"where len(fields) = 19 and {O.f(1)} <> 'hash'")


def _on_text(sql: str, tx: str | None = None) -> str:
    """The same statement over the text-derived views."""
    out = sql
    if tx:
        out = _re.sub(r"\btransactions\b", tx, out)
    for view in ("contracts", "scams", "blocks"):
        out = _re.sub(rf"\b{view}\b", f"{view}_text", out)
    return out


_J2_FULL_SQL = f"""
select {M('block_timestamp')} as month, count(*) as tx_count, sum(value) as total_value,
       cast(sum(value) as double) / count(*) as avg_value
from transactions where block_timestamp is not null and value is not null group by 1"""


@register("monthly_tx_count_text", _on_text(_J1_SQL, "tx_text_ts"))
def _monthly_tx_count_text(spark, sf):
    """J1 as run: 15 fields and an integer timestamp."""
    return L.monthly_tx_count(_tx_text(spark, sf, "timestamp"))


@register("monthly_avg_value_text", _on_text(_J2_FULL_SQL, "tx_text_value_ts"))
def _monthly_avg_value_text(spark, sf):
    """J2 as run: F2 lines."""
    return L.monthly_avg_value(_tx_text(spark, sf, "value_ts"))


@register("top10_services_text", _on_text(_CONTRACT_TOTALS, "tx_text_services")
          + "\norder by total_value desc, address limit 10")
def _top10_services_text(spark, sf):
    """J3 as run: F3 transaction lines, F4 contract lines."""
    return L.top10_services(_tx_text(spark, sf, "services"), _contracts_text(spark, sf))


@register("top10_miners_text", _on_text(_MINER_SQL) + "\norder by total_size desc, miner limit 10")
def _top10_miners_text(spark, sf):
    """J4 as run: F5 block lines."""
    return L.top10_miners(_blocks_text(spark, sf))


@register("monthly_gas_price_text", _on_text(_gas_rank("month"), "tx_text_gas_price"))
def _monthly_gas_price_text(spark, sf):
    """J7 as run: F6 lines."""
    return L.monthly_gas_price(_tx_text(spark, sf, "gas_price"))


@register("top10_scams_text", _on_text(_SCAM_VALUE, "tx_text_full")
          + "\norder by total_value desc, id, category limit 10")
def _top10_scams_text(spark, sf):
    """J9 as run: F9 transaction lines, F8 scam lines."""
    return S.top10_scams(_tx_text(spark, sf, "full"), _scams_text(spark, sf))


@register("scam_time_series_text", _on_text(SQL_RAW_SCAM_SERIES, "tx_text_full"))
def _scam_time_series_text(spark, sf):
    """J10 as run: F9 transaction lines, F8 scam lines."""
    return S.scam_time_series(_tx_text(spark, sf, "full"), _scams_text(spark, sf))


_J14_TEXT = "with " + _RUNNING.replace("from transactions", "from tx_text_block_value") \
    + _BY_BLOCK_SENDER + "\norder by total_value desc, block_number, from_address limit 100"


@register("wash_top100_text", _J14_TEXT)
def _wash_top100_text(spark, sf):
    """J14 as run: F7 lines."""
    return W.wash_top100(_tx_text(spark, sf, "block_value"))


# ---------------------------------------------------------------- jobs on the typed copy
# The copy holds every line with its check flags, so a job finds in it what it
# would have kept of the text.

def _typed(spark, sf):
    def write(path):
        tx = FX.text_in_batches(spark, sf, "transactions", FX.transaction_lines)
        blocks = FX.text_in_batches(spark, sf, "blocks", FX.block_lines)
        K.write_typed_ledger((src.all_transactions(TX.split_fields(lines)) for lines in tx),
                             (_typed_blocks(lines) for lines in blocks),
                             _contracts_text(spark, sf), _scams_text(spark, sf), path)

    return src.from_parquet(spark, FX.written_once(spark, sf, "typed-ledger", write))


def _tx_typed(spark, sf, check):
    return src.checked(_typed(spark, sf).transactions.drop("month"), check)


@register("monthly_tx_count_typed", _on_text(_J1_SQL, "tx_text_ts"))
def _monthly_tx_count_typed(spark, sf):
    return L.monthly_tx_count(_tx_typed(spark, sf, "timestamp"))


@register("monthly_gas_price_typed", _on_text(_gas_rank("month"), "tx_text_gas_price"))
def _monthly_gas_price_typed(spark, sf):
    return L.monthly_gas_price(_tx_typed(spark, sf, "gas_price"))


@register("top10_services_typed", _on_text(_CONTRACT_TOTALS, "tx_text_services")
          + "\norder by total_value desc, address limit 10")
def _top10_services_typed(spark, sf):
    return L.top10_services(_tx_typed(spark, sf, "services"), _typed(spark, sf).contracts)


@register("wash_top100_typed", _J14_TEXT)
def _wash_top100_typed(spark, sf):
    return W.wash_top100(_tx_typed(spark, sf, "block_value"))
