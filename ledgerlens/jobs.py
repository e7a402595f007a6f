"""Run one analysis job on ledger export files.

    python -m ledgerlens.jobs monthly-count --transactions s3a://data/transactions.csv \\
        --out s3a://results

Inputs are the exports as the original jobs read them: CSV text
(transactions, blocks, contracts, nine-field scam lines) and the scam registry
JSON; ``--typed`` instead names a typed parquet copy made by ``convert``.
Results go to ``<out>/ethereum_<job>_<run stamp>/`` in the original shapes:
a JSON pair list for bounded top-k / monthly results, ``key,value`` lines,
CSV with header, or JSON rows for unbounded tables. Object-store settings are
ordinary Spark options (``--conf spark.hadoop.fs.s3a.endpoint=...``).
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import validate as V
from .plans import ledger as L
from .plans import overhead as OV
from .plans import scams as S
from .plans import wash as W
from .schemas import BLOCK_FIELDS, SCAM_CSV_FIELDS, TRANSACTION_FIELDS, all_strings
from .sinks import writers as K
from .sources import documents as D
from .sources import ledger as src
from .sources import text as TX


@dataclass
class Inputs:
    spark: SparkSession
    args: argparse.Namespace

    def _need(self, name: str) -> str:
        path = getattr(self.args, name)
        if not path:
            raise SystemExit(f"--{name.replace('_', '-')} is required for this job")
        return path

    def _typed(self, name: str) -> DataFrame | None:
        if self.args.typed:
            return getattr(src.from_parquet(self.spark, self.args.typed), name)
        return None

    @property
    def tx_split(self) -> DataFrame:
        """Split transaction lines; from CSV with header, the named columns."""
        path = self._need("transactions")
        if self.args.csv_header:
            table = D.read_csv(self.spark, path, schema=all_strings(TRANSACTION_FIELDS))
            return TX.from_columns(table, TRANSACTION_FIELDS)
        return TX.split_fields(TX.read_lines(self.spark, path))

    def tx(self, check: str) -> DataFrame:
        """Typed transactions that the job's own line check keeps, the same from
        text and from a typed copy."""
        t = self._typed("transactions")
        if t is not None:
            return src.checked(t.drop("month"), check)
        return TX.typed_transactions(self.tx_split.where(V.TX_CHECKS[check][0]()))

    @property
    def blocks(self) -> DataFrame:
        t = self._typed("blocks")
        if t is not None:
            return t
        split = TX.split_fields(TX.read_lines(self.spark, self._need("blocks")))
        return TX.typed_blocks(split.where(V.block_line()))

    @property
    def blocks_csv(self) -> DataFrame:
        """Blocks as the storage job reads them: CSV with header."""
        return D.read_csv(self.spark, self._need("blocks"), infer=self.args.infer_schema,
                          schema=None if self.args.infer_schema else _block_text_schema())

    @property
    def contracts(self) -> DataFrame:
        t = self._typed("contracts")
        if t is not None:
            return t
        split = TX.split_fields(TX.read_lines(self.spark, self._need("contracts")))
        return TX.typed_contracts(split.where(V.contract_arity() & (TX.field(0) != "address")))

    @property
    def scams(self) -> DataFrame:
        t = self._typed("scams")
        if t is not None:
            return t
        split = TX.split_scam_fields(TX.read_lines(self.spark, self._need("scams")))
        return TX.typed_scams(split.where(V.scam_line()))

    @property
    def registry(self) -> DataFrame:
        return D.read_scam_registry(self.spark, self._need("scam_registry"),
                                    whole_file=self.args.whole_file_registry)


def _block_text_schema():
    return all_strings(BLOCK_FIELDS)


Writer = Callable[[Inputs, str], None]


def _pairs(build, keys, value, order=None) -> Writer:
    return lambda i, out: K.write_pair_list(build(i), keys, value, out,
                                            order=[F.col(c) for c in order] if order else None)


def _json(build) -> Writer:
    return lambda i, out: K.write_json(build(i), out)


def _overhead(i: Inputs, out: str) -> None:
    K.write_json(OV.data_overhead(i.blocks_csv), f"{out}/metrics")
    K.write_json(OV.data_overhead_first_block(i.blocks_csv), f"{out}/first_block_metrics")


def _scam_pairs(i: Inputs, out: str) -> None:
    K.write_json(S.tx_pairs(i.tx("digits_value")), f"{out}/transactions")
    K.write_json(S.scam_pairs(i.registry), f"{out}/scams")


def _scam_csv(i: Inputs, out: str) -> None:
    flat = S.flatten_registry(i.registry)
    K.write_csv_header(flat, [*SCAM_CSV_FIELDS, "address"], f"{out}/table")
    K.write_scam_lines(flat, f"{out}/lines")        # the input of the scam value jobs


# job name -> writer of its result folder
JOBS: dict[str, Writer] = {
    "monthly-count": _pairs(lambda i: L.monthly_tx_count(i.tx("timestamp")), ["month"], "tx_count",
                            order=["month"]),
    "monthly-value": lambda i, out: K.write_csv_lines(
        L.monthly_avg_value(i.tx("value_ts")), ["month", "avg_value"], out),
    "top-services": _pairs(lambda i: L.top10_services(i.tx("services"), i.contracts),
                           ["address"], "total_value"),
    "top-miners": _pairs(lambda i: L.top10_miners(i.blocks), ["miner"], "total_size"),
    "contract-types": _json(lambda i: L.contract_types(i.tx("arity"), i.contracts,
                                                       side=i.args.side)),
    "data-overhead": _overhead,
    "gas-price": _pairs(lambda i: L.monthly_gas_price(i.tx("gas_price")), ["month"],
                        "avg_gas_price", order=["month"]),
    "contract-gas": _pairs(lambda i: L.contract_gas_monthly(i.tx("timestamp"), i.contracts),
                           ["month"], "avg_gas"),
    "top-scams": _pairs(lambda i: S.top10_scams(i.tx("full"), i.scams),
                        ["id", "category"], "total_value"),
    "scam-series": _json(lambda i: S.scam_time_series(i.tx("full"), i.scams)),
    "scam-registry-csv": _scam_csv,
    "scam-pairs": _scam_pairs,
    "wash-50": _json(lambda i: W.wash_heuristics_50(i.tx("arity"))),
    "wash-heuristics": _json(lambda i: W.wash_heuristics(i.tx("arity"))),
    "wash-top100": _pairs(lambda i: W.wash_top100(i.tx("block_value")),
                          ["block_number", "from_address"], "total_value"),
}


def convert(i: Inputs, out: str) -> None:
    """Text exports -> typed parquet copy (transactions partitioned by month).

    Every line of the right number of fields is kept, so each job finds in the
    copy what it would have kept of the text.
    """
    K.write_typed_ledger(src.all_transactions(i.tx_split), i.blocks, i.contracts, i.scams, out)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerlens.jobs", description=__doc__.split("\n")[0])
    p.add_argument("job", choices=[*JOBS, "convert"])
    p.add_argument("--out", required=True, help="result folder (a run-stamped sub-folder is made)")
    for name in ("transactions", "blocks", "contracts", "scams", "scam-registry", "typed"):
        p.add_argument(f"--{name}")
    p.add_argument("--csv-header", action="store_true",
                   help="transactions are CSV with a header (quotes honoured) instead of plain lines")
    p.add_argument("--infer-schema", action="store_true", help="CSV schema inference for blocks")
    p.add_argument("--side", choices=["to", "from"], default="to",
                   help="contract-types: match contracts with the receiver or the sender")
    p.add_argument("--whole-file-registry", action="store_true",
                   help="the registry is one JSON document per file")
    p.add_argument("--no-stamp", action="store_true", help="write to --out directly")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    args = parse_args(argv)
    if spark is None:
        from .session import build_session
        spark = build_session(app_name=f"ledgerlens-{args.job}")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    inputs = Inputs(spark, args)
    if args.job == "convert":
        convert(inputs, args.out)
        return args.out
    write = JOBS[args.job]
    out = args.out if args.no_stamp else K.run_stamped_path(args.out, args.job)
    write(inputs, out)
    return out


if __name__ == "__main__":
    print(main())
