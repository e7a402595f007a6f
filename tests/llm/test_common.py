import random

from pyspark.sql import functions as F

from ledgerlens.llm.common import connected_components, gapless_rank


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2060)]
    edges += [(5, 5), (5, None), (None, 7), (9, 10), (9, 10), (10, 9)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_rank_is_gapless_with_a_hot_group_and_equal_rows(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id") % 3).alias("g"),
                                  (F.col("id") % 11).alias("k"))
    rows = gapless_rank(df, "g", ["k"], "slot").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.g, []).append((r.slot, r.k))
    assert len(rows) == 5000
    for members in groups.values():
        members.sort()
        assert [s for s, _ in members] == list(range(len(members)))
        assert [k for _, k in members] == sorted(k for _, k in members)


def test_clashing_internal_names(spark):
    """Columns named like the operators' own stay as they are."""
    from ledgerlens.llm import lines, simhash

    passage = "\n".join(f"line {i} of a passage that repeats" for i in range(12))
    rows = [(1, passage, "a", 7, "r", "x"), (2, f"start\n{passage}\nend", "b", 8, "s", "y"), (3, "other text", "c", 9, "t", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _ll_id string, _ll_hash int, _ll_runs string, _ll_ranges string")
    out = lines.dedup_lines(docs, runs_col=None)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i][2:] for i in (1, 2, 3)] == [r[2:] for r in rows] and got[2].text == "start\nend"
    twice = lines.dedup_lines(lines.dedup_lines(docs))           # the ranges of the second call replace the first's
    assert {r.doc_id: r.text for r in twice.collect()} == {i: r.text for i, r in got.items()}
    kept = simhash.keep_one(docs.unionAll(docs))                 # the second text is near the first
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_finished_rounds_are_deleted(spark):
    from ledgerlens import session

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int")
    before = len(session._SCRATCH.get(session.session_key(spark), []))
    found = connected_components(edges, "a", "b", "rounds")
    assert {r.component for r in found.collect()} == {0} and found.count() == 41
    assert len(session._SCRATCH[session.session_key(spark)]) - before <= 1
