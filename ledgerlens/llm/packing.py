"""Packing into optimal length buckets with token-budget batches.

Documents longer than the context are cut into segments. The exact histogram
of segment lengths (at most ``max_length`` numbers) goes through a dynamic
programme that chooses the bucket boundaries with the least padding; inside a
bucket, segments fill batches of a token budget.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, materialize, pieces
from .tokens import encoder, vocabulary_path

MAX_LENGTH = 4_096
BUCKETS = 16
BATCH_TOKENS = 65_536


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens)`` of whole texts, with one end id each."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = encoder(path).packed
        for batch in batches:
            for b in pieces(batch):
                n = [len(packed(t or "")) // 4 + 1 for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_tokens"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, n_tokens bigint")


def optimal_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding.

    ``best[j]`` is the least padded size of all items up to length j in k
    buckets; the last bucket runs from some i to j and pads to length j.
    Ties take the smallest i; no lengths give no boundaries.
    """
    order = np.argsort(lengths)
    size = np.asarray(lengths, dtype=np.int64)[order]
    before = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64)[order])])
    m = len(size)
    if not m:
        return []
    best = size * before[1:]                                   # one bucket
    cuts: list[np.ndarray] = []
    for _ in range(min(buckets, m) - 1):
        now, cut = best.copy(), np.full(m, -1)
        for j in range(1, m):
            cost = best[:j] - size[j] * before[1:j + 1]
            i = int(cost.argmin())
            total = cost[i] + size[j] * before[j + 1]
            if total < now[j]:
                now[j], cut[j] = total, i
        best = now
        cuts.append(cut)
    out, j = [], m - 1
    for cut in reversed(cuts):
        out.append(int(size[j]))
        if cut[j] < 0:                                         # fewer buckets do as well
            continue
        j = int(cut[j])
    out.append(int(size[j]))
    return sorted(set(out))


def segments(lengths: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """``(doc_id, segment, start, length)``: documents cut at ``max_length`` tokens."""
    last = F.greatest(F.floor((F.col("n_tokens") - 1) / max_length), F.lit(0))
    cut = lengths.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("segment"))
    start = F.col("segment") * max_length
    return cut.select("doc_id", "segment", start.alias("start"),
                      F.least(F.col("n_tokens") - start, F.lit(max_length)).cast("int").alias("length"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH,
         buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """One row per segment: its bucket, batch and place.

    Columns: ``doc_id, segment, start`` (first token of the segment in the
    document), ``length``, ``bucket`` (index), ``bucket_length`` (padded
    length), ``batch`` (number inside the bucket), ``position`` (place in the
    batch) and ``padding``. A batch holds as many segments as fit
    ``batch_tokens`` at the padded length, at least one. Segments are dealt to
    batches in a fixed hash order, so a batch mixes documents. Null and empty
    texts have length 1 (the end id); repeated ids keep a row each; an empty
    table gives no rows.
    """
    lengths = materialize(token_counts(docs, id_col, text_col, vocabulary), "token-counts")
    parts = segments(lengths, max_length)
    histogram = parts.groupBy("length").count().collect()      # at most max_length rows
    bounds = optimal_boundaries([r["length"] for r in histogram], [r["count"] for r in histogram], buckets)
    bounds = bounds or [max_length]
    held = F.array(*[F.lit(b) for b in bounds])
    bucket = F.size(F.filter(held, lambda b: b < F.col("length")))
    placed = parts.select("doc_id", "segment", "start", "length", bucket.alias("bucket"),
                          F.xxhash64(F.lit("pack"), "doc_id", "segment").alias("mix"))
    ranked = gapless_rank(placed, "bucket", ["mix", "doc_id", "segment", "length"], "rank")
    width = F.element_at(held, F.col("bucket") + 1)
    rows = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / width)).cast("bigint")
    return ranked.select(
        "doc_id", "segment", "start", "length", "bucket", width.alias("bucket_length"),
        F.floor(F.col("rank") / rows).cast("bigint").alias("batch"), (F.col("rank") % rows).alias("position"),
        (width - F.col("length")).alias("padding"))
