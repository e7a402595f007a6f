"""Token ids in a compressed plane format.

A data set is a Parquet table of chunk records, written by Spark's committer
(so lost tasks are redone and half-written files never show). The id stream of
one range of documents is cut into blocks of a fixed number of ids; a block is
transposed into byte planes (or bit planes), each plane is compressed with
zstandard, and the planes follow a small header in ``blob``. The other columns
are the chunk index: ``part`` and ``chunk`` order the stream, ``first`` is the
position of the chunk in its part, ``n`` its ids, ``plane_bytes`` the compressed
size of each plane, and ``docs`` the documents whose ids it holds (id, ordinal in
the part, offset in the chunk, ids in this chunk). Reading the index alone
never touches the blobs; any chunk can be decoded by itself.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions_for, pieces
from .tokens import encoder, vocabulary_path

BLOCK_IDS = 65_536
END_ID = 0
LEVEL = 3
MAGIC = b"IDPL"
HEADER = struct.Struct("<4sBBI")        # magic, version, planes, ids

_DOC = "struct<doc_id:bigint,ordinal:bigint,offset:int,n:int>"
SCHEMA = f"part int, chunk int, first bigint, n int, plane_bytes array<int>, blob binary, docs array<{_DOC}>"
_ARROW = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n", pa.int32()),
    ("plane_bytes", pa.list_(pa.int32())), ("blob", pa.binary()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("ordinal", pa.int64()),
                                 ("offset", pa.int32()), ("n", pa.int32())]))),
])


def encode_block(ids: np.ndarray, bits: bool = False, level: int = LEVEL) -> tuple[bytes, list[int]]:
    """A block of unsigned 32-bit ids as ``(blob, compressed bytes per plane)``."""
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)
    else:
        planes = rows.T
    squeeze = zstandard.ZstdCompressor(level=level)
    frames = [squeeze.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    sizes = [len(f) for f in frames]
    head = HEADER.pack(MAGIC, 1, len(frames), len(ids)) + struct.pack(f"<{len(sizes)}I", *sizes)
    return head + b"".join(frames), sizes


def decode_block(blob: bytes) -> np.ndarray:
    """The ids of a block; a blob that is not one raises ``ValueError``."""
    magic, version, count, n = HEADER.unpack_from(blob)
    if magic != MAGIC or version != 1 or count not in (4, 32):
        raise ValueError("not an id block")
    at = HEADER.size
    sizes = struct.unpack_from(f"<{count}I", blob, at)
    at += 4 * count
    width = n if count == 4 else (n + 7) // 8
    expand = zstandard.ZstdDecompressor()
    planes = np.empty((count, width), dtype=np.uint8)
    for p, size in enumerate(sizes):
        planes[p] = np.frombuffer(expand.decompress(blob[at:at + size], max_output_size=width), np.uint8)
        at += size
    if count == 32:
        rows = np.packbits(np.unpackbits(planes, axis=1, count=n).T, axis=1, bitorder="little")
    else:
        rows = planes.T
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


class _Writer:
    """Cuts one part's id stream into chunk records."""

    def __init__(self, part: int, block: int, bits: bool, level: int) -> None:
        self.part, self.block, self.bits, self.level = part, block, bits, level
        self.chunk = self.first = self.docs = 0
        self._fresh()

    def _fresh(self) -> None:
        """Start a chunk: its packed ids so far, their number, and whose they are."""
        self.held: list[bytes] = []
        self.n = 0
        self.ids: list[int | None] = []
        self.ordinals, self.offsets, self.counts = [], [], []

    def _take(self, doc_id: int | None, packed: bytes, n: int) -> None:
        self.held.append(packed)
        self.ids.append(doc_id)
        self.ordinals.append(self.docs)
        self.offsets.append(self.n)
        self.counts.append(n)
        self.n += n

    def add(self, doc_id: int | None, packed: bytes) -> Iterator[pa.RecordBatch]:
        """Take the packed ids of one document; give the chunks they fill."""
        left = len(packed) // 4
        while self.n + left >= self.block:
            n = self.block - self.n
            self._take(doc_id, packed[:4 * n], n)
            yield self.flush()
            packed, left = packed[4 * n:], left - n
        if left:
            self._take(doc_id, packed, left)
        self.docs += 1

    def flush(self) -> pa.RecordBatch:
        blob, sizes = encode_block(np.frombuffer(b"".join(self.held), dtype="<u4"), self.bits, self.level)
        docs = pa.StructArray.from_arrays(
            [pa.array(self.ids, pa.int64()), pa.array(self.ordinals, pa.int64()),
             pa.array(self.offsets, pa.int32()), pa.array(self.counts, pa.int32())],
            fields=list(_ARROW.field("docs").type.value_type))
        row = pa.RecordBatch.from_arrays(
            [pa.array([self.part], pa.int32()), pa.array([self.chunk], pa.int32()), pa.array([self.first], pa.int64()),
             pa.array([self.n], pa.int32()), pa.array([sizes], pa.list_(pa.int32())), pa.array([blob], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)], schema=_ARROW)
        self.chunk, self.first = self.chunk + 1, self.first + self.n
        self._fresh()
        return row


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              vocabulary: str | None = None, block: int = BLOCK_IDS, bits: bool = False,
              level: int = LEVEL) -> None:
    """Encode every text and write the ids under ``path`` in ascending id order.

    One end id (0) follows each document. A null or empty text is the end id
    alone; null ids come first; rows of one id follow each other in input
    order and each keep their own ids. The text is range-partitioned by (id,
    row), so a repeated id is split too; a task streams its documents and
    holds one block of ids at a time besides one document.
    """
    path_of_vocabulary = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = encoder(path_of_vocabulary).packed
        end = np.array([END_ID], dtype="<u4").tobytes()
        writer = _Writer(TaskContext.get().partitionId(), block, bits, level)
        for batch in batches:
            for b in pieces(batch):
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    yield from writer.add(doc_id, packed(text or "") + end)
        if writer.n:
            yield writer.flush()

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    keys = ["doc_id", "_ll_row"]
    (narrow.withColumn("_ll_row", F.monotonically_increasing_id())
     .repartitionByRange(partitions_for(narrow), *keys).sortWithinPartitions(*keys)
     .select("doc_id", "text").mapInArrow(run, SCHEMA).write.parquet(path))


# Fixed value: the reflected CRC-32 polynomial.
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two reflected polynomials modulo the CRC polynomial."""
    p = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            p ^= b
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
    return p


def crc_join(left: int, right: int, right_bytes: int) -> int:
    """CRC-32 of two byte strings put together, from the CRC-32 of each."""
    power, square, n = 1 << 31, 1 << 30, right_bytes * 8
    while n:
        if n & 1:
            power = _times(square, power)
        square = _times(square, square)
        n >>= 1
    return _times(power, left) ^ right


@F.pandas_udf(T.LongType())
def _crc_of(parts: pd.Series) -> pd.Series:
    """CRC-32 of a document from its pieces (position, ids, crc); null: null."""
    def join(pieces_of_doc) -> int | None:
        if pieces_of_doc is None:
            return None
        ordered = sorted((int(p["first"]), int(p["n"]), int(p["crc"])) for p in pieces_of_doc)
        crc = ordered[0][2]
        for _, n, right in ordered[1:]:
            crc = crc_join(crc, right, 4 * n)
        return crc

    return pd.Series([join(p) for p in parts], dtype="Int64")


def part_starts(index: DataFrame) -> DataFrame:
    """``(part, start)``: ids in all earlier parts, by blocks of parts."""
    sums = (index.groupBy("part").agg(F.sum("n").alias("ids"))
            .withColumn("stretch", F.floor(F.col("part") / 1024)))
    before = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = sums.groupBy("stretch").agg(F.sum("ids").alias("all")).select(
        "stretch", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("stretch").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("earlier", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return sums.join(stretches, "stretch").select("part", (F.col("base") + F.col("earlier")).alias("start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: ``doc_id, start, n_tokens, ids_crc32``.

    Chunks are decoded independently; the checksum of a document that spans
    chunks is joined from those of its pieces, so no task needs all ids of a
    document or of a part.
    """
    chunks = spark.read.schema(SCHEMA).parquet(path)
    out = pa.schema([("part", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()),
                     ("first", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, firsts, blobs = (batch.column(i).to_pylist() for i in range(3))
            for row, (part, first, blob) in enumerate(zip(parts, firsts, blobs)):
                data = memoryview(decode_block(blob).tobytes())
                doc_id, ordinal, offset, n = batch.column(3).slice(row, 1).flatten().flatten()
                at, count = (x.to_numpy().astype(np.int64) for x in (offset, n))
                crcs = [zlib.crc32(data[a:z]) for a, z in zip((4 * at).tolist(), (4 * (at + count)).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), part, np.int32)), ordinal, doc_id, pa.array(first + at),
                     pa.array(count), pa.array(crcs, pa.int64())], schema=out)

    found = chunks.select("part", "first", "blob", "docs").mapInArrow(
        run, "part int, ordinal bigint, doc_id bigint, first bigint, n bigint, crc bigint")
    docs = found.groupBy("part", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
        F.collect_list(F.struct("first", "n", "crc")).alias("parts"))
    # one row per part: at most as many as the writer had range partitions
    starts = F.broadcast(part_starts(chunks.select("part", "n")))
    # only documents that span chunks have pieces to join
    joined = _crc_of(F.when(F.size("parts") > 1, F.col("parts")))
    return docs.join(starts, "part").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens",
        F.coalesce(joined, F.col("parts")[0]["crc"]).alias("ids_crc32"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(part, chunk, first, ids)``: the decoded id array of every chunk."""
    chunks = spark.read.schema(SCHEMA).parquet(path).select("part", "chunk", "first", "blob")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                ids = [decode_block(x).astype(np.int64) for x in b.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(ids, type=pa.list_(pa.int64()))],
                    names=["part", "chunk", "first", "ids"])

    return chunks.mapInArrow(run, "part int, chunk int, first bigint, ids array<bigint>")
