"""Ledger analytics on Spark: typed ledger tables, validation, and the
monthly, contract, miner, scam, wash-trade and storage-overhead jobs as
DataFrame plans."""

__version__ = "0.1.0"
