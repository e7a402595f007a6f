"""Large exports are written compressed, in bounded files, and hold every line;
the typed copy is written where its rows are read."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlens import catalog
from ledgerlens.schemas import TRANSACTION_FIELDS
from ledgerlens.session import ensure_checkpoint_dir, scratch_path, shuffles_freed
from ledgerlens.sinks import writers as K
from ledgerlens.sources import documents as D
from ledgerlens.sources import fixtures as FX


def lines(spark, n=700):
    i = F.col("id").cast("string")
    return spark.range(n, numPartitions=2).select(F.concat(F.lit("0x"), F.sha2(i, 256), F.lit(","), i).alias("value"))


def texts(df):
    return sorted(r[0] for r in df.collect())


def test_compressed_files_are_bounded_and_whole(spark, monkeypatch):
    monkeypatch.setattr(K, "FILE_ROWS", 100)
    path, plain = scratch_path(spark, "gz"), scratch_path(spark, "plain")
    K.compressed(lines(spark)).text(path)
    lines(spark).write.text(plain)
    files = glob.glob(f"{path.removeprefix('file:')}/part-*")
    assert len(files) == 8 and all(f.endswith(".gz") for f in files)
    assert max(spark.read.text(f).count() for f in files) == 100
    assert texts(spark.read.text(path)) == texts(lines(spark)) == texts(spark.read.text(plain))


@pytest.mark.parametrize("name, build", [("transactions", FX.transaction_lines), ("blocks", FX.block_lines)])
def test_text_exports_are_compressed(spark, small, name, build):
    got = FX.as_text_file(spark, small, name, build)
    assert all(f.endswith(".gz") for f in got.inputFiles())
    assert texts(got) == texts(build(spark, small))


def test_lists_that_may_be_broadcast_keep_their_size(spark, small):
    assert not any(f.endswith(".gz") for f in FX.as_text_file(spark, small, "scams", FX.scam_lines).inputFiles())


def test_csv_with_header_is_compressed_where_large(spark, monkeypatch):
    monkeypatch.setattr(K, "FILE_ROWS", 100)
    df = lines(spark).select("value", F.length("value").cast("string").alias("n"))
    path = scratch_path(spark, "csv-gz")
    K.write_csv_header(df, ["n", "value"], path, large=True)
    back = D.read_csv(spark, path)
    assert all(f.endswith(".csv.gz") for f in back.inputFiles()) and len(back.inputFiles()) == 8
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.select("n", "value").collect()))


def transactions(spark, n=900):
    """Rows of one month in three tasks, some without a timestamp."""
    cols = {c: F.lit(None).cast("string") for c in TRANSACTION_FIELDS}
    cols |= {"hash": F.sha2(F.col("id").cast("string"), 256), "block_number": F.col("id"),
             "block_timestamp": F.when(F.col("id") % 100 != 7, F.lit(1_500_000_000))}
    return spark.range(n, numPartitions=3).select(*[c.alias(k) for k, c in cols.items()])


def test_typed_copy_is_written_without_a_shuffle(spark):
    root = scratch_path(spark, "typed")
    small = spark.range(3).select(F.col("id").alias("x"))
    tx = transactions(spark)
    K.write_typed_ledger(tx, small, small, small, root)
    at = root.removeprefix("file:")
    months = glob.glob(f"{at}/transactions/month=*")
    assert len(months) == 2                          # with and without a timestamp
    for month in months:                             # a file per task that holds rows of the month
        assert len(glob.glob(f"{month}/*.parquet")) == 3
    for f in glob.glob(f"{at}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        assert not meta.num_row_groups or meta.row_group(0).column(0).compression == "ZSTD"
    back = spark.read.parquet(f"{root}/transactions").select(*tx.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, tx.collect()))


@pytest.fixture
def tables(spark, small):
    """A folder of tables from which this session holds no export."""
    root = scratch_path(spark, "tables")
    for n in ("lineitem", "orders", "supplier"):
        spark.read.parquet(f"{small}/{n}.parquet").write.parquet(f"{root}/{n}.parquet")
    return root


def exports(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return set(glob.glob(f"{base}/transactions-text-*") + glob.glob(f"{base}/blocks-text-*"))


def test_an_export_goes_as_it_is_read(spark, tables, monkeypatch):
    monkeypatch.setattr(K, "FILE_ROWS", 100)
    monkeypatch.setattr(FX, "_batch_limits", lambda spark: (1, 10_000, 1_000))
    seen, left = [], []
    for part in FX.text_in_batches(spark, tables, "transactions", lambda spark, sf: lines(spark)):
        folder = os.path.dirname(part.inputFiles()[0]).removeprefix("file://")
        left.append(len(glob.glob(f"{folder}/part-*")))
        seen += texts(part)
    assert sorted(seen) == texts(lines(spark))
    assert left[0] == 8 and len(left) >= 4 and left == sorted(set(left), reverse=True)
    assert not os.path.exists(folder)


def test_a_batch_keeps_the_cores_busy(spark, tables, monkeypatch):
    """Files larger than a task's share are a task each."""
    monkeypatch.setattr(K, "FILE_ROWS", 100)
    monkeypatch.setattr(FX, "_batch_limits", lambda spark: (5, 1, 1))
    parts = FX.text_in_batches(spark, tables, "transactions", lambda spark, sf: lines(spark))
    assert [len(part.inputFiles()) for part in parts] == [5, 3]


def test_an_export_that_is_held_stays(spark, tables):
    build = lambda spark, sf: lines(spark)
    held = FX.as_text_file(spark, tables, "blocks", build)
    parts = [texts(part) for part in FX.text_in_batches(spark, tables, "blocks", build)]
    assert parts == [texts(lines(spark))] == [texts(held)]


def test_an_export_goes_when_its_reader_fails(spark, tables):
    before = exports(spark)
    parts = FX.text_in_batches(spark, tables, "transactions", lambda spark, sf: lines(spark))
    next(parts)
    assert len(exports(spark) - before) == 1
    parts.close()
    assert exports(spark) == before


def test_the_typed_copy_leaves_no_export(spark, tables):
    before = exports(spark)
    got = catalog.QUERIES["monthly_tx_count_typed"](spark, tables).collect()
    assert exports(spark) == before
    assert sorted(got) == sorted(catalog.QUERIES["monthly_tx_count_text"](spark, tables).collect())


def test_typed_copy_in_parts(spark):
    root, small = scratch_path(spark, "typed-parts"), spark.range(3).select(F.col("id").alias("x"))
    tx, asked = transactions(spark), []

    def parts(name, df, n):
        for i in range(n):
            asked.append((name, i))
            yield df.where(F.pmod(F.hash(df.columns[0]), F.lit(n)) == i)

    for _ in range(2):                               # the second copy replaces the first
        K.write_typed_ledger(parts("tx", tx, 3), parts("blocks", small, 2), small, small, root)
    assert asked == 2 * [("tx", 0), ("tx", 1), ("tx", 2), ("blocks", 0), ("blocks", 1)]
    back = spark.read.parquet(f"{root}/transactions").select(*tx.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, tx.collect()))
    for name in ("blocks", "contracts", "scams"):
        assert sorted(r.x for r in spark.read.parquet(f"{root}/{name}").collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="earlier part"):
        K.write_typed_ledger(parts("tx", tx, 3), small, small, small, root, mode="ignore")


def test_hashes_of_the_typed_copy_take_half_their_length(spark):
    root, small = scratch_path(spark, "typed-hashes"), spark.range(3).select(F.col("id").alias("x"))
    blocks = spark.range(20_000, numPartitions=1).select(
        F.concat(F.lit("0x"), F.sha2(F.col("id").cast("string"), 256)).alias("hash"))
    K.write_typed_ledger(transactions(spark), blocks, small, small, root)
    (file,) = glob.glob(f"{root.removeprefix('file:')}/blocks/*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).total_compressed_size < 33.5 * 20_000
    assert spark.read.parquet(f"{root}/blocks").exceptAll(blocks).count() == 0


def test_shuffle_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with pytest.raises(KeyError), shuffles_freed(spark):
        assert spark.conf.get(key) == "true"
        raise KeyError
    assert spark.conf.get(key, None) == before
