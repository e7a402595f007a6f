"""Ledger-shaped tables derived from the driver's TPC-H-like tables.

The ledger exports the jobs were written for are not shipped, so the four
ledger tables are derived column by column from ``lineitem``, ``orders`` and
``supplier`` (a line item is a transaction, an order is a block, some
suppliers are contracts and some are reported scams). Everything is a lazy
DataFrame over the parquet scans: Catalyst prunes the columns a job does not
use, so e.g. the SHA-256 hash columns are never computed for a job that only
needs timestamps.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRANSACTION_FIELDS, WEI
from ..session import data_files, delete_files, free_scratch, path_version, scratch_path, session_key, shuffles_freed
from ..sinks import writers as K

WEI_PER_UNIT = "1000000000000000000"
GWEI = 1_000_000_000


_TABLES: dict[tuple[str, str], tuple[tuple, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the driver data, opened once per session and file state.

    Opening a parquet path lists the files and reads the footers for the
    schema (a small job each time); the DataFrame is lazy and immutable, so
    every query of a session reuses the one handle.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key, version = (session_key(spark), path), path_version(spark, path)
    held = _TABLES.get(key)
    if held is None or held[0] != version or held[1].sparkSession is not spark:
        held = _TABLES[key] = (version, spark.read.parquet(path))
    return held[1]


def _sha(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.sha2(c, 256))


def _epoch(c: Column) -> Column:
    # Driver timestamps are zone-less; the session runs in UTC.
    return F.unix_seconds(c.cast("timestamp"))


def _addr(c: Column) -> Column:
    return F.concat(F.lit("a"), c.cast("string"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item; the order is its block.

    So that every rule has something to decide, some items are sent twice,
    some have no receiver and some move no value.
    """
    li = table(spark, sf_dir, "lineitem")
    twice = (F.col("l_orderkey") % 5 == 0) & (F.col("l_linenumber") == 1)
    li = li.withColumn("copy", F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"),
                      F.col("l_linenumber").cast("string"),
                      F.col("l_partkey").cast("string"))
    return j.select(
        _sha(key).alias("hash"),
        F.col("l_linenumber").cast("bigint").alias("nonce"),
        _sha(F.col("l_orderkey").cast("string")).alias("block_hash"),
        F.col("l_orderkey").alias("block_number"),
        F.col("l_linenumber").cast("bigint").alias("transaction_index"),
        _addr(F.col("o_custkey")).alias("from_address"),
        F.when(F.col("l_partkey") % 50 != 0, _addr(F.col("l_suppkey"))).alias("to_address"),
        F.when((F.col("l_quantity") != 50) & (F.col("l_suppkey") % 10 != 2),
               F.col("l_quantity").cast("decimal(18,0)") * F.lit(WEI_PER_UNIT).cast("decimal(19,0)"))
        .otherwise(F.lit(0)).cast(WEI).alias("value"),
        (F.lit(21000) + F.col("l_quantity") * 1000).cast("bigint").alias("gas"),
        (F.round(F.col("l_discount") * 100).cast("bigint") * GWEI).alias("gas_price"),
        F.lit("0x").alias("input"),
        _epoch(F.col("l_shipdate")).alias("block_timestamp"),
        (F.round(F.col("l_tax") * 100).cast("bigint") * GWEI).alias("max_fee_per_gas"),
        F.lit(GWEI).cast("bigint").alias("max_priority_fee_per_gas"),
        F.when(F.col("l_returnflag") == "R", 2).otherwise(0).cast("int").alias("transaction_type"),
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block per order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ks = k.cast("string")
    return o.select(
        k.alias("number"),
        _sha(ks).alias("hash"),
        _sha((k - 1).cast("string")).alias("parent_hash"),
        F.lit("0x0").alias("nonce"),
        _sha(F.concat(F.lit("u"), ks)).alias("sha3_uncles"),
        F.concat(F.lit("0x"), F.repeat(F.sha2(F.concat(F.lit("l"), ks), 256), 8)).alias("logs_bloom"),
        _sha(F.concat(F.lit("t"), ks)).alias("transactions_root"),
        _sha(F.concat(F.lit("s"), ks)).alias("state_root"),
        _sha(F.concat(F.lit("r"), ks)).alias("receipts_root"),
        _addr(F.col("o_custkey")).alias("miner"),
        (k * 1000).cast(WEI).alias("difficulty"),
        (k * 1000000).cast(WEI).alias("total_difficulty"),
        F.round(F.col("o_totalprice")).cast("bigint").alias("size"),
        F.col("o_orderpriority").alias("extra_data"),
        F.lit(8000000).cast("bigint").alias("gas_limit"),
        F.round(F.col("o_totalprice")).cast("bigint").alias("gas_used"),
        _epoch(F.col("o_orderdate")).alias("timestamp"),
        (k % 200).alias("transaction_count"),
        F.lit(0).cast("bigint").alias("base_fee_per_gas"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a large balance are contracts; some addresses repeat.

    Flags are kept as the export's 0/1 integers here; typed readers turn them
    into booleans.
    """
    s = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 3000)
    addr = _addr(F.col("s_suppkey")).alias("address")
    first = s.select(
        addr, F.lit("0x").alias("bytecode"), F.lit("").alias("function_sighashes"),
        (F.col("s_nationkey") % 2).alias("is_erc20"),
        F.when(F.col("s_nationkey") % 3 == 0, 1).otherwise(0).alias("is_erc721"),
        (F.col("s_suppkey") * 10).alias("block_number"),
    )
    repeated = s.where(F.col("s_nationkey") < 5).select(
        addr, F.lit("0x").alias("bytecode"), F.lit("").alias("function_sighashes"),
        (F.col("s_nationkey") % 2).alias("is_erc20"),
        F.lit(0).alias("is_erc721"),
        (F.col("s_suppkey") * 10).alias("block_number"),
    )
    return first.unionAll(repeated)


def scams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (scam id, address); some addresses sit under two scams."""
    s = table(spark, sf_dir, "supplier")
    cat = (F.when(F.col("s_nationkey") % 3 == 0, "Phishing")
           .when(F.col("s_nationkey") % 3 == 1, "Scam")
           .otherwise("Fake ICO"))
    first = s.where(F.col("s_suppkey") % 4 == 0).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.concat(F.lit("http://"), F.col("s_name")).alias("url"), F.lit("ETH").alias("coin"),
        cat.alias("category"), F.lit(None).cast("string").alias("subcategory"),
        _addr(F.col("s_suppkey")).alias("address"),
        F.when(F.col("s_acctbal") > 0, "Active").otherwise("Offline").alias("status"),
    )
    second = s.where(F.col("s_suppkey") % 8 == 0).select(
        (F.col("s_suppkey") + 1000).alias("id"), F.col("s_name").alias("name"),
        F.concat(F.lit("http://"), F.col("s_name")).alias("url"), F.lit("ETH").alias("coin"),
        F.lit("Phishing").alias("category"), F.lit("clone").alias("subcategory"),
        _addr(F.col("s_suppkey")).alias("address"), F.lit("Active").alias("status"),
    )
    return first.unionAll(second)


# --------------------------------------------------------------------------
# Text renderings: CSV lines as the exports would hold them.
# --------------------------------------------------------------------------

def _csv_line(df: DataFrame, fields: list[str]) -> DataFrame:
    # concat_ws skips nulls, which would change the field count: blank them.
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    return df.select(F.concat_ws(",", *parts).alias("value"))


# Malformed transaction lines mixed into every text fixture.
# Each is a 15-field line unless its purpose is a wrong field count.
_GOOD = ["0xh", "1", "0xb", "7", "1", "a1", "a2", "5", "21000", "1000000000",
         "0x", "1500000000", "0", "0", "0"]


def _variant(**changes: str) -> str:
    fields = list(_GOOD)
    for name, value in changes.items():
        fields[TRANSACTION_FIELDS.index(name)] = value
    return ",".join(fields)


BAD_TRANSACTION_LINES: list[str] = [
    ",".join(TRANSACTION_FIELDS),                 # header line
    ",".join(_GOOD[:14]),                         # 14 fields
    ",".join(_GOOD + ["x"]),                      # 16 fields
    "",                                           # empty line
    _variant(value="abc"),
    _variant(value="1d"),
    _variant(value="0x1p3"),
    _variant(block_timestamp="1.5"),
    _variant(block_timestamp=""),
    _variant(block_number="-1"),
    _variant(value="1_000"),
    _variant(value=" 12 "),
    _variant(to_address=""),
    _variant(value="nan"),
    _variant(gas_price="2.5e9"),
    _variant(gas_price="1500000000.0", gas="2.1e4"),
    _variant(value="1.5"),
    _variant(gas_price="1.5", gas="21000.7"),
    _variant(gas_price="0.4"),
    _variant(gas_price="0.1234567894", block_number="x"),
    _variant(gas_price="1e25"),
]


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions.csv`` as raw lines: header, every row, malformed lines."""
    good = _csv_line(transactions(spark, sf_dir), TRANSACTION_FIELDS)
    bad = spark.createDataFrame([(x,) for x in BAD_TRANSACTION_LINES], "value string").coalesce(1)
    return good.unionAll(bad)


def block_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..schemas import BLOCK_FIELDS

    header = spark.createDataFrame([(",".join(BLOCK_FIELDS),)], "value string")
    return _csv_line(blocks(spark, sf_dir), BLOCK_FIELDS).unionAll(header)


def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..schemas import CONTRACT_FIELDS

    header = spark.createDataFrame([(",".join(CONTRACT_FIELDS),)], "value string")
    return _csv_line(contracts(spark, sf_dir), CONTRACT_FIELDS).unionAll(header)


def scam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine-field scam lines: id,name,url,coin,category,subcategory,address,index,status."""
    from ..schemas import SCAM_LINE_FIELDS
    from pyspark.sql import Window

    s = scams(spark, sf_dir)
    # position of the address within its scam, as the flattening job numbers it
    w = Window.partitionBy("id", "name", "url", "coin", "category", "subcategory", "status") \
        .orderBy("address")
    s = s.withColumn("index", F.row_number().over(w) - 1)
    header = spark.createDataFrame([(",".join(SCAM_LINE_FIELDS),)], "value string")
    return _csv_line(s, SCAM_LINE_FIELDS).unionAll(header)


_WRITTEN: dict[tuple[str, str, str], tuple[tuple, str]] = {}


def _written_key(spark: SparkSession, sf_dir: str, name: str) -> tuple[tuple[str, str, str], tuple]:
    root = sf_dir.rstrip("/")
    version = tuple(path_version(spark, f"{root}/{n}.parquet") for n in ("lineitem", "orders", "supplier"))
    return (session_key(spark), root, name), version


def written_once(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path that ``write(path)`` has filled, once per session and state of the
    tables, under the shared checkpoint folder."""
    key, version = _written_key(spark, sf_dir, name)
    held = _WRITTEN.get(key)
    if held is None or held[0] != version:
        path = scratch_path(spark, name)
        write(path)
        held = _WRITTEN[key] = (version, path)
    return held[1]


def _write_text(spark: SparkSession, sf_dir: str, name: str, build, path: str) -> None:
    """Transactions and blocks, mostly hashes, are written compressed; the lists that
    joins may broadcast stay as long as they are, so that their file sizes tell."""
    lines = build(spark, sf_dir)
    with shuffles_freed(spark):
        (K.compressed(lines) if name in ("transactions", "blocks") else lines.write).text(path)


def as_text_file(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write a text rendering once and scan it back, so text jobs read real
    files (as the exports are) instead of recomputing the rendering for every
    field they parse."""
    return spark.read.text(written_once(spark, sf_dir, f"{name}-text",
                                        lambda path: _write_text(spark, sf_dir, name, build, path)))


# Files that the cores take in so many rounds of tasks are one batch.
BATCH_ROUNDS = 2


def _batch_limits(spark: SparkSession) -> tuple[int, int, int]:
    """Files that a batch has at least, its bytes beyond those, and what opening a file
    counts as, by the scan's own settings."""
    size = lambda key: spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(f"spark.sql.files.{key}"))
    tasks = BATCH_ROUNDS * spark.sparkContext.defaultParallelism
    return tasks, tasks * size("maxPartitionBytes"), size("openCostInBytes")


def text_in_batches(spark: SparkSession, sf_dir: str, name: str, build) -> Iterator[DataFrame]:
    """The lines of :func:`as_text_file` in parts, for one reader that is done with a
    part when it asks for the next.

    An export that this session holds is one part and stays. Otherwise it is written
    for this reader alone, comes a batch of files at a time, and the files of a batch
    are deleted when the reader is done with it, so the whole export does not lie
    beside all that is made of it."""
    key, version = _written_key(spark, sf_dir, f"{name}-text")
    if key in _WRITTEN and _WRITTEN[key][0] == version:
        yield as_text_file(spark, sf_dir, name, build)
        return
    path = scratch_path(spark, f"{name}-text")
    try:
        _write_text(spark, sf_dir, name, build, path)
        least, most, each = _batch_limits(spark)
        batch, held = [], 0
        for file, size in data_files(spark, path):
            if len(batch) >= least and held + size + each > most:
                yield spark.read.text(batch)
                delete_files(spark, batch)
                batch, held = [], 0
            batch.append(file)
            held += size + each
        yield spark.read.text(batch)
    finally:
        free_scratch(spark, path)


def scam_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scam registry as JSON text, one ``{"result": {address: record}}`` per line.

    The registry format is a map keyed by an address whose records carry all
    addresses of one scam. Writing one small document per scam (keyed by its
    first address) keeps the registry splittable; the reader also accepts a
    single whole-file document.
    """
    s = scams(spark, sf_dir)
    attrs = ["id", "name", "url", "coin", "category", "subcategory", "status"]
    rec = s.groupBy(*attrs).agg(F.array_sort(F.collect_list("address")).alias("addresses"))
    doc = F.struct(F.create_map(F.col("addresses")[0], _RECORD()).alias("result"))
    return rec.select(F.to_json(doc).alias("value"))


def _RECORD() -> Column:
    return F.struct("id", "name", "url", "coin", "category", "subcategory", "addresses", "status")


def scam_document_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as one document of several lines, with text ids and a key
    per scam (one record by nature: for bounded registries)."""
    attrs = ["id", "name", "url", "coin", "category", "subcategory", "status"]
    rec = scams(spark, sf_dir).groupBy(*attrs).agg(F.array_sort(F.collect_list("address")).alias("addresses"))
    rec = rec.withColumn("id", F.col("id").cast("string"))
    entry = F.concat(F.lit('  "'), F.col("addresses")[0], F.lit("-"), F.col("id"), F.lit('": '), F.to_json(_RECORD()))
    one = rec.agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return one.select(F.concat(F.lit('{"result": {\n'), F.array_join("e", ",\n"), F.lit("\n}\n}")).alias("value"))


# Registry records that lack something required.
BAD_REGISTRY_DOCUMENTS: list[str] = [
    '{"result": {"b1": {"name": "n", "url": "u", "coin": "ETH", "category": "Scam", "addresses": ["b1"], "status": "Active"}}}',
    '{"result": {"b2": {"id": 2, "name": "n", "coin": "ETH", "category": "Scam", "addresses": ["b2"], "status": "Active"}}}',
    '{"result": {"b3": {"id": 3, "name": "n", "url": "u", "coin": "ETH", "category": "Scam", "addresses": [], "status": "Active"}}}',
    '{"result": {"b4": {"id": 4, "name": "n", "url": "u", "coin": "ETH", "category": "Scam", "status": "Active"}}}',
    '{"result": {"b5": {"id": "x", "name": "n", "url": "u", "coin": "ETH", "category": "Scam", "addresses": ["b5"], "status": "Active"}}}',
    '{"result": {"b6": null}}',
]
