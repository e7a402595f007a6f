import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import simhash


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprint_matches_brute_force_and_spark_hash(spark):
    for t in ["", "one", "one two", "A b C d A b C", "é x y\tz\nz y", "To " * 500]:
        assert simhash.fingerprint(t.encode()) == brute(t)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint(long.encode()) == brute(long)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


def test_every_pair_within_the_threshold_meets(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(300)] + [0]
    points = set(base)
    for x in base:
        for bits in (1, 2, 3):
            points.add(x ^ sum(1 << b for b in rng.sample(range(64), bits)))
    points = sorted(points)
    want = {tuple(sorted((simhash.np.uint64(a).astype(np.int64).item(), np.uint64(b).astype(np.int64).item())))
            for i, a in enumerate(points) for b in points[i + 1:] if (a ^ b).bit_count() <= 2}
    df = spark.createDataFrame([(np.uint64(p).astype(np.int64).item(),) for p in points], "fp bigint")
    for blocks in (simhash.TWO_BLOCKS, simhash.THREE_BLOCKS):
        got = [(r.a, r.b) for r in simhash.links(df, 2, blocks).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_replicas_are_never_broadcast(spark):
    """The planner takes a fingerprint's replicas for one row; with the default threshold they went to the driver."""
    df = spark.range(2000).select(F.xxhash64("id").alias("fp"))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) >= 10 << 20
    found = simhash.links(df)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()      # as it ran
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_nulls_repeats_and_keep_one(frame):
    words = "the quick brown fox jumps over a lazy dog and then sleeps for hours in warm sun".split()
    text = " ".join(words * 12)
    rows = [(5, text), (3, text), (9, text + " x"), (None, None), (7, ""), (8, " \n"), (4, "other words entirely here"),
            (4, "other words entirely here"), (4, "a different text under one id"), (None, "lonely text without any id")]
    found = simhash.near_duplicates(frame(rows)).collect()
    fps = [brute(t) for _, t in rows]
    ids = list(range(len(rows)))
    group = {i: min(j for j in ids if (fps[i] ^ fps[j]).bit_count() <= 2) for i in ids}
    want = sorted(((rows[i][0], fps[i], min((rows[j][0] for j in ids if group[j] == group[i]
                                             and rows[j][0] is not None), default=None)) for i in ids), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=str) == want
    kept = simhash.keep_one(frame(rows)).collect()
    assert sorted((brute(r.text) for r in kept)) == sorted(
        fps[min((i for i in ids if group[i] == g), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))]
        for g in set(group.values()))
    assert simhash.near_duplicates(frame([])).count() == 0


def test_links_on_documents(spark, small_docs):
    rows = [(r.doc_id, brute(r.text)) for r in small_docs.collect()]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(rows):
        for j, b in rows[k + 1:]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(small_docs).collect()}
    assert got == {i: (fp, find(i)) for i, fp in rows}
