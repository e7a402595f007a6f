import math
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import sharding
from ledgerlens.session import scratch_path


def test_digest_and_slots(frame):
    rows = [(i, "é" * (i % 50)) for i in range(900)] + [(None, None), (7, "again"), (7, "again"), (1000, "x" * 100_000)]
    got = sharding.assign_shards(frame(rows)).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < 40 and r.law == "key" and r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
    assert sharding.assign_shards(frame([])).count() == 0


def test_shares_follow_weights_and_growth_moves_few(spark):
    n = 40_000
    weights = [1.0, 2.0, 0.5, 1.5]
    moved = spark.range(n).select(sharding.shard_of(F.col("id"), weights).alias("a"),
                                  sharding.shard_of(F.col("id"), [*weights, 1.0]).alias("b"))
    counts = {(r.a, r.b): r["count"] for r in moved.groupBy("a", "b").count().collect()}
    assert all(b in (a, 4) for a, b in counts)
    for i, w in enumerate(weights):
        share = sum(c for (a, _), c in counts.items() if a == i) / n
        assert share == pytest.approx(w / sum(weights), abs=0.01)
    assert sum(c for (_, b), c in counts.items() if b == 4) / n == pytest.approx(1 / 6, abs=0.01)
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [1.0, 0.0])


def test_written_shards_hold_every_row(spark, small_docs):
    path = scratch_path(spark, "shards-test")
    sharding.write_shards(small_docs, path)
    back = spark.read.parquet(path)
    assert back.count() == small_docs.count()
    assert back.where(F.col("shard") != sharding.shard_of(F.col("doc_id"), (1.0,) * 40)).count() == 0


def test_no_python_in_the_plan(frame):
    plan = sharding.assign_shards(frame([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def winner(key, weights):
    """The winning shard by the public xxhash library: seed 42, then each value in turn."""
    best = None
    for i, w in enumerate(weights):
        seed = xxhash.xxh64_intdigest(b"rendezvous", seed=42)
        if key is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=seed)
        h = xxhash.xxh64_intdigest(struct.pack("<i", i), seed=seed)
        score = -math.log(((h >> 11) + 0.5) / 2 ** 53) / w
        if best is None or score < best[0]:
            best = score, i
    return best[1]


def test_winner_equals_a_second_hash(frame):
    rows = [(i * 7919, "t") for i in range(400)] + [(None, "t"), (-5, "t"), (2 ** 62, "t")]
    got = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.assign_shards(frame(rows)).collect()}
    assert got == {k: (winner(k, [1.0] * 40), winner(k, [1.0] * 41)) for k, _ in rows}
    weights = [1.0, 3.0, 0.25]
    some = frame(rows).select("doc_id", sharding.shard_of(F.col("doc_id"), weights).alias("s")).collect()
    assert all(r.s == winner(r.doc_id, weights) for r in some)
