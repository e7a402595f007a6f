"""DuckDB SQL for the correctness oracle.

The ledger views are rebuilt in DuckDB's dialect from the same driver tables
(``lineitem``, ``orders``, ``supplier`` registered as views), then each
query is stated in plain SQL. ``with_views`` prefixes a query with only the
views it references.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "transactions": """
select concat('0x', sha256(concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar), '-', cast(l_partkey as varchar)))) as hash,
       cast(l_linenumber as bigint) as nonce,
       concat('0x', sha256(cast(l_orderkey as varchar))) as block_hash,
       l_orderkey as block_number,
       cast(l_linenumber as bigint) as transaction_index,
       concat('a', cast(o_custkey as varchar)) as from_address,
       case when l_partkey % 50 <> 0 then concat('a', cast(l_suppkey as varchar)) end as to_address,
       case when l_quantity <> 50 and l_suppkey % 10 <> 2
            then cast(cast(l_quantity as decimal(18,0)) * cast('1000000000000000000' as decimal(19,0)) as decimal(38,0))
            else cast(0 as decimal(38,0)) end as value,
       cast(cast(21000 + l_quantity * 1000 as bigint) as decimal(28,9)) as gas,
       cast(cast(round(l_discount * 100) as bigint) * 1000000000 as decimal(28,9)) as gas_price,
       '0x' as input,
       cast(epoch(l_shipdate) as bigint) as block_timestamp,
       cast(round(l_tax * 100) as bigint) * 1000000000 as max_fee_per_gas,
       cast(1000000000 as bigint) as max_priority_fee_per_gas,
       cast(case when l_returnflag = 'R' then 2 else 0 end as integer) as transaction_type
from (select *, unnest(case when l_orderkey % 5 = 0 and l_linenumber = 1 then [1, 2] else [1] end) as copy
      from lineitem) join orders on l_orderkey = o_orderkey""",
    "blocks": """
select o_orderkey as number,
       concat('0x', sha256(cast(o_orderkey as varchar))) as hash,
       concat('0x', sha256(cast(o_orderkey - 1 as varchar))) as parent_hash,
       '0x0' as nonce,
       concat('0x', sha256(concat('u', cast(o_orderkey as varchar)))) as sha3_uncles,
       concat('0x', repeat(sha256(concat('l', cast(o_orderkey as varchar))), 8)) as logs_bloom,
       concat('0x', sha256(concat('t', cast(o_orderkey as varchar)))) as transactions_root,
       concat('0x', sha256(concat('s', cast(o_orderkey as varchar)))) as state_root,
       concat('0x', sha256(concat('r', cast(o_orderkey as varchar)))) as receipts_root,
       concat('a', cast(o_custkey as varchar)) as miner,
       cast(o_orderkey * 1000 as decimal(38,0)) as difficulty,
       cast(o_orderkey * 1000000 as decimal(38,0)) as total_difficulty,
       cast(round(o_totalprice) as bigint) as size,
       o_orderpriority as extra_data,
       cast(8000000 as bigint) as gas_limit,
       cast(round(o_totalprice) as bigint) as gas_used,
       cast(epoch(o_orderdate) as bigint) as timestamp,
       o_orderkey % 200 as transaction_count,
       cast(0 as bigint) as base_fee_per_gas
from orders""",
    "contracts": """
select concat('a', cast(s_suppkey as varchar)) as address, '0x' as bytecode, '' as function_sighashes,
       s_nationkey % 2 = 1 as is_erc20, s_nationkey % 3 = 0 as is_erc721,
       s_suppkey * 10 as block_number
from supplier where s_acctbal > 3000
union all
select concat('a', cast(s_suppkey as varchar)), '0x', '', s_nationkey % 2 = 1, false, s_suppkey * 10
from supplier where s_acctbal > 3000 and s_nationkey < 5""",
    "scams": """
select s_suppkey as id, s_name as name, concat('http://', s_name) as url, 'ETH' as coin,
       case s_nationkey % 3 when 0 then 'Phishing' when 1 then 'Scam' else 'Fake ICO' end as category,
       cast(null as varchar) as subcategory, concat('a', cast(s_suppkey as varchar)) as address,
       case when s_acctbal > 0 then 'Active' else 'Offline' end as status
from supplier where s_suppkey % 4 = 0
union all
select s_suppkey + 1000, s_name, concat('http://', s_name), 'ETH', 'Phishing', 'clone',
       concat('a', cast(s_suppkey as varchar)), 'Active'
from supplier where s_suppkey % 8 = 0""",
}

# views built on other views, in dependency order
DERIVED: dict[str, str] = {}


def month(col: str) -> str:
    """``MM/yyyy`` UTC label of an epoch-seconds column."""
    return f"strftime(make_timestamp(cast({col} as bigint) * 1000000), '%m/%Y')"


def _refs(sql: str, names) -> set[str]:
    return {n for n in names if re.search(rf"\b{n}\b", sql)}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it needs (transitively)."""
    order = [*VIEWS, *DERIVED]
    body = {**VIEWS, **DERIVED}
    need = _refs(sql, order)
    changed = True
    while changed:
        changed = False
        for n in list(need):
            extra = _refs(body[n], order) - need - {n}
            if extra:
                need |= extra
                changed = True
    ctes = [f"{n} as ({body[n]}\n)" for n in order if n in need]
    if not ctes:
        return sql
    head = sql.lstrip()
    if head[:5].lower() == "with ":
        # merge with the statement's own WITH list
        return "with " + ",\n".join(ctes) + ",\n" + head[5:]
    return "with " + ",\n".join(ctes) + "\n" + sql


# --------------------------------------------------------------------------
# Text renderings and line parsing, mirroring ``sources.text`` and
# ``functions.parsing``.
# --------------------------------------------------------------------------

def _patterns():
    from .functions.parsing import DIGITS_PATTERN, FLOAT_PATTERN, INT_PATTERN
    return INT_PATTERN, FLOAT_PATTERN, DIGITS_PATTERN


def _re(x: str, pat: str) -> str:
    return f"regexp_matches({x}, '{pat}')"


def sql_is_int(x: str) -> str:
    i, _, _ = _patterns()
    return f"coalesce({_re(x, i)} and try_cast(trim({x}) as bigint) is not null, false)"


def sql_is_float(x: str) -> str:
    _, f, _ = _patterns()
    return f"coalesce({_re(x, f)} and try_cast(trim({x}) as double) is not null, false)"


def sql_is_digits(x: str) -> str:
    _, _, d = _patterns()
    return f"coalesce({_re(x, d)}, false)"


def sql_to_long(x: str) -> str:
    i, _, _ = _patterns()
    return f"(case when {_re(x, i)} then try_cast(trim({x}) as bigint) end)"


def sql_to_wei(x: str) -> str:
    _, f, _ = _patterns()
    return (f"(case when {_re(x, f)} then coalesce(try_cast(trim({x}) as decimal(38,0)), "
            f"try_cast(try_cast(trim({x}) as double) as decimal(38,0))) end)")


def sql_to_price(x: str) -> str:
    _, f, _ = _patterns()
    return (f"(case when {_re(x, f)} then coalesce(try_cast(trim({x}) as decimal(28,9)), "
            f"try_cast(try_cast(trim({x}) as double) as decimal(28,9))) end)")


def sql_mean(x: str, n: str) -> str:
    """Mean of a price column: exact sums of whole parts and of billionths, divided last."""
    nanos = f"cast(cast({x} - floor({x}) as decimal(10,9)) * 1000000000 as bigint)"
    return (f"(cast(sum(cast(floor({x}) as decimal(38,0))) as double) "
            f"+ cast(sum({nanos}) as double) / 1000000000.0::double) / {n}")


def sql_is_wei(x: str) -> str:
    return f"({sql_is_float(x)} and {sql_to_wei(x)} is not null)"


def sql_is_big_int(x: str) -> str:
    i, _, _ = _patterns()
    return f"coalesce({_re(x, i)} and try_cast(trim({x}) as decimal(38,0)) is not null, false)"


def sql_to_flag(x: str) -> str:
    return (f"(case when lower(trim({x})) in ('1', 'true') then true "
            f"when lower(trim({x})) in ('0', 'false') then false end)")


def sql_blank_to_null(x: str) -> str:
    return f"(case when trim({x}) <> '' then {x} end)"


def f(i: int) -> str:
    """Field ``i`` (0-based) of the split line."""
    return f"fields[{i + 1}]"


def _lines_sql(view: str, fields: list[str], render=None) -> str:
    render = render or {}
    parts = ", ".join(f"coalesce(cast({render.get(c, c)} as varchar), '')" for c in fields)
    return f"select concat_ws(',', {parts}) as value from {view}"


def _values(lines: list[str]) -> str:
    rows = ", ".join("('" + x.replace("'", "''") + "')" for x in lines)
    return f"select * from (values {rows}) v(value)"


def _register_text_views() -> None:
    from .schemas import (BLOCK_FIELDS, CONTRACT_FIELDS, SCAM_LINE_FIELDS,
                          TRANSACTION_FIELDS)
    from .sources.fixtures import BAD_TRANSACTION_LINES

    prices = {c: f"cast({c} as bigint)" for c in ("gas", "gas_price")}
    DERIVED["tx_lines"] = (_lines_sql("transactions", TRANSACTION_FIELDS, prices)
                           + "\nunion all " + _values(BAD_TRANSACTION_LINES))
    DERIVED["tx_split"] = "select value, string_split(value, ',') as fields from tx_lines"
    DERIVED["block_lines"] = (_lines_sql("blocks", BLOCK_FIELDS)
                              + "\nunion all " + _values([",".join(BLOCK_FIELDS)]))
    DERIVED["block_split"] = "select value, string_split(value, ',') as fields from block_lines"
    flags = {"is_erc20": "cast(is_erc20 as integer)", "is_erc721": "cast(is_erc721 as integer)"}
    DERIVED["contract_lines"] = (_lines_sql("contracts", CONTRACT_FIELDS, flags)
                                 + "\nunion all " + _values([",".join(CONTRACT_FIELDS)]))
    DERIVED["contract_split"] = "select value, string_split(value, ',') as fields from contract_lines"
    DERIVED["scam_indexed"] = (
        "select *, row_number() over (partition by id, name, url, coin, category, subcategory, status "
        "order by address) - 1 as index from scams")
    DERIVED["scam_lines"] = (_lines_sql("scam_indexed", SCAM_LINE_FIELDS)
                             + "\nunion all " + _values([",".join(SCAM_LINE_FIELDS)]))
    DERIVED["scam_split"] = "select value, string_split(value, ',') as fields from scam_lines"


_register_text_views()


def typed_tx_cols() -> str:
    from .schemas import TRANSACTION_FIELDS as T

    def g(n):
        return f(T.index(n))
    longs = {"nonce", "block_number", "transaction_index", "block_timestamp",
             "max_fee_per_gas", "max_priority_fee_per_gas"}
    cols = []
    for n in T:
        if n in longs:
            cols.append(f"{sql_to_long(g(n))} as {n}")
        elif n in ("from_address", "to_address"):
            cols.append(f"{sql_blank_to_null(g(n))} as {n}")
        elif n in ("gas", "gas_price"):
            cols.append(f"{sql_to_price(g(n))} as {n}")
        elif n == "value":
            cols.append(f"{sql_to_wei(g(n))} as {n}")
        elif n == "transaction_type":
            cols.append(f"cast({sql_to_long(g(n))} as integer) as transaction_type")
        else:
            cols.append(f"{g(n)} as {n}")
    return ", ".join(cols)


def typed_block_cols() -> str:
    from .schemas import BLOCK_FIELDS as B

    longs = {"number", "size", "gas_limit", "gas_used", "timestamp", "transaction_count",
             "base_fee_per_gas"}
    cols = []
    for i, n in enumerate(B):
        if n in longs:
            cols.append(f"{sql_to_long(f(i))} as {n}")
        elif n in ("difficulty", "total_difficulty"):
            cols.append(f"{sql_to_wei(f(i))} as {n}")
        else:
            cols.append(f"{f(i)} as {n}")
    return ", ".join(cols)


def typed_contract_cols() -> str:
    return (f"{sql_blank_to_null(f(0))} as address, {f(1)} as bytecode, {f(2)} as function_sighashes, "
            f"{sql_to_flag(f(3))} as is_erc20, {sql_to_flag(f(4))} as is_erc721, "
            f"{sql_to_long(f(5))} as block_number")


def typed_scam_cols() -> str:
    return (f"{sql_to_long(f(0))} as id, {f(1)} as name, {f(2)} as url, {f(3)} as coin, "
            f"{f(4)} as category, {f(5)} as subcategory, {sql_blank_to_null(f(6))} as address, "
            f"{f(8)} as status")


def tx_predicates() -> dict[str, str]:
    """SQL of the transaction line checks F1-F3, F6, F7, F9, F10."""
    from .schemas import TRANSACTION_FIELDS as T

    def g(n):
        return f(T.index(n))
    arity = "len(fields) = 15"
    f7 = f"{arity} and {sql_is_int(g('block_number'))} and {sql_is_wei(g('value'))}"
    return {
        "valid_tx_arity": arity,
        "valid_tx_value_ts": f"{arity} and {sql_is_wei(g('value'))} and {sql_is_int(g('block_timestamp'))}",
        "valid_tx_block_digits": f"{arity} and {sql_is_digits(g('block_number'))}",
        "valid_tx_gas_price": f"{arity} and {sql_is_float(g('gas_price'))} and {sql_is_int(g('block_timestamp'))}",
        "valid_tx_block_value": f7,
        "valid_tx_full": f"{f7} and {sql_is_int(g('block_timestamp'))}",
        "valid_tx_digits_value": f"{arity} and {sql_is_digits(g('block_timestamp'))} and {sql_is_wei(g('value'))}",
    }
