"""Explicit schemas of the ledger tables.

Column order is the export's field order: text lines are addressed by
position, so ``*_FIELDS`` lists double as the positional layout.
"""

from __future__ import annotations

from pyspark.sql import types as T

WEI = T.DecimalType(38, 0)
# Gas and gas prices: every 64-bit integer, and nine digits of a fraction.
PRICE = T.DecimalType(28, 9)

# Field order of the ledger CSV exports.
TRANSACTION_FIELDS = [
    "hash", "nonce", "block_hash", "block_number", "transaction_index",
    "from_address", "to_address", "value", "gas", "gas_price", "input",
    "block_timestamp", "max_fee_per_gas", "max_priority_fee_per_gas",
    "transaction_type",
]
BLOCK_FIELDS = [
    "number", "hash", "parent_hash", "nonce", "sha3_uncles", "logs_bloom",
    "transactions_root", "state_root", "receipts_root", "miner", "difficulty",
    "total_difficulty", "size", "extra_data", "gas_limit", "gas_used",
    "timestamp", "transaction_count", "base_fee_per_gas",
]
CONTRACT_FIELDS = [
    "address", "bytecode", "function_sighashes", "is_erc20", "is_erc721", "block_number",
]
# Flat scam table as written by the JSON-to-CSV job, plus the address column.
SCAM_CSV_FIELDS = [
    "identity", "name", "url", "coin", "category", "subcategory", "index", "status",
]
# Nine-field scam lines read by the scam value jobs: 0 id, 4 category, 6 address.
SCAM_LINE_FIELDS = [
    "id", "name", "url", "coin", "category", "subcategory", "address", "index", "status",
]
# Columns holding hashes / bloom filters that the storage-overhead job measures.
HEX_COLUMNS = ["sha3_uncles", "logs_bloom", "transactions_root", "state_root", "receipts_root"]

TRANSACTIONS = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("nonce", T.LongType()),
    T.StructField("block_hash", T.StringType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("transaction_index", T.LongType()),
    T.StructField("from_address", T.StringType()),
    T.StructField("to_address", T.StringType()),
    T.StructField("value", WEI),
    T.StructField("gas", PRICE),
    T.StructField("gas_price", PRICE),
    T.StructField("input", T.StringType()),
    T.StructField("block_timestamp", T.LongType()),
    T.StructField("max_fee_per_gas", T.LongType()),
    T.StructField("max_priority_fee_per_gas", T.LongType()),
    T.StructField("transaction_type", T.IntegerType()),
])

# One scam-registry document: ``result`` maps an address to a scam record.
# Ids come as numbers or as text; they are read as text and typed afterwards.
SCAM_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("coin", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()),
    T.StructField("addresses", T.ArrayType(T.StringType())),
    T.StructField("status", T.StringType()),
])
SCAM_DOCUMENT = T.StructType([
    T.StructField("result", T.MapType(T.StringType(), SCAM_RECORD)),
])


def all_strings(fields: list[str]) -> T.StructType:
    """Schema reading every field as text (CSV scans before validation)."""
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])
