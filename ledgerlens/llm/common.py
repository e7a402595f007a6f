"""Helpers shared by the corpus operators.

Every operator takes a DataFrame plus column names and reads only those
columns, under names of its own (or free ones, where it passes the input's
columns on), so extra or clashing columns of the input never matter. Intermediate results that must survive a lost executor (and cut
lineage) are Parquet tables in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import free_scratch, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``name`` of the folder, by Spark's reader only (any URI)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions_for(df: DataFrame, target_bytes: int = 64 << 20) -> int:
    """Shuffle partitions for ``df``: the session's number, or more where the
    planner's size estimate asks for more to stay near ``target_bytes`` each."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, min(-(-estimate // target_bytes), 1_000_000))


def ascii_lower(c):
    """A-Z lower-cased, every other character kept."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_class(c, modulus: int = 4):
    """crc32 of an id's decimal text modulo ``modulus`` (null id: null)."""
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(modulus))


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch of about ``max_bytes`` each (one row at least)."""
    step = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


class Memory(dict):
    """Bytes by text, made on demand and held up to a number of bytes.

    When ``max_bytes`` are held, what is known becomes the older half: texts in
    use come back from there, the others are forgotten the next time. So at most
    twice ``max_bytes`` are held. Texts above ``longest`` characters never are.
    """

    ENTRY_BYTES = 190                    # of a dictionary entry and the heads of two objects

    def __init__(self, make: Callable[[str], bytes], max_bytes: int, longest: int = 256) -> None:
        super().__init__()
        self.make, self.max_bytes, self.longest = make, max_bytes, longest
        self.older: dict[str, bytes] = {}
        self.held = 0

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.make(text)
            if len(text) > self.longest:
                return found
        size = self.ENTRY_BYTES + (len(text) if text.isascii() else 4 * len(text)) + len(found)
        if self.held + size > self.max_bytes:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += size
        self[text] = found
        return found


def gapless_rank(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the 0-based rank of a row inside ``group`` by ``order``.

    No group is gathered in one task. Rows are range-partitioned by (group,
    order, row id) -- the row id splits runs of equal rows -- and written with
    their position in the partition; the rows of a group in earlier partitions
    are then added from one small table with a row per (partition, group).
    That table has at most partitions + groups rows, which bounds the broadcast.
    ``df`` should be narrow: it is shuffled and written once.
    """
    keys = [group, *order, "_ll_row"]
    ranged = (df.withColumn("_ll_row", F.monotonically_increasing_id())
              .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_ll_row"))
    rows = materialize(ranged.withColumn("_ll_seq", F.monotonically_increasing_id()), "rank")
    part = F.shiftrightunsigned("_ll_seq", 33).alias("_ll_part")
    counts = (rows.groupBy(F.col(group).alias("_ll_group"), part)
              .agg(F.min("_ll_seq").alias("_ll_first"), F.count(F.lit(1)).alias("_ll_n")))
    earlier = (Window.partitionBy("_ll_group").orderBy("_ll_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("_ll_group", "_ll_part", (
        F.coalesce(F.sum("_ll_n").over(earlier), F.lit(0)) - F.col("_ll_first")).alias("_ll_base"))
    hit = (F.col(group) == F.col("_ll_group")) & (F.shiftrightunsigned("_ll_seq", 33) == F.col("_ll_part"))
    return (rows.join(F.broadcast(base), hit)
            .select(*df.columns, (F.col("_ll_seq") + F.col("_ll_base")).cast("bigint").alias(name)))


def connected_components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of an undirected edge list.

    ``component`` is the smallest node reachable. Alternating large-star and
    small-star steps: each takes a minimum per node (combined before the
    shuffle) and a join whose two sides are plain written tables, so adaptive
    execution can split a node that holds a large share of the edges. The
    working set never exceeds twice the edges, nothing is collected, and each
    step is a written table, so a lost executor repeats one step only; the
    tables of a finished round are deleted.
    Null ends and self loops are ignored; an empty edge list gives no rows.
    """
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
         .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    spark = edges.sparkSession
    made: list[str] = []

    def write(df: DataFrame) -> DataFrame:
        made.append(scratch_path(spark, name))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    e = write(e)
    before = _digest(e)
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = write(_star(both, larger=True, write=write))
        e = write(_star(e, larger=False, write=write))
        now = _digest(e)
        for path in made[:-1]:                     # all but the round's result
            free_scratch(spark, path)
        del made[:-1]
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))


def _digest(e: DataFrame) -> tuple:
    """Row count and order-free checksum of an edge list."""
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(e: DataFrame, larger: bool, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One star step; edges ``(u, v)``, for the small star with ``v < u``."""
    least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = write(least)
    joined = e.join(least, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionAll(least.select("u", F.col("m").alias("v"))))
    return out.where("u != v").distinct()
