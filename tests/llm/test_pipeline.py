"""The stages against plain Python on a small table with planted cases."""

import pytest

import corpus_pipeline
from ledgerlens.llm import simhash
from ledgerlens.llm.tokens import encoder, vocabulary_path
from ledgerlens.session import scratch_path
from test_decontaminate import brute as contaminated
from test_lines import brute as without_repeats
from test_simhash import brute as fingerprint


@pytest.fixture(scope="module")
def folder(spark):
    sf = "/root/testdata/sf0.001"
    out = scratch_path(spark, "pipeline-test")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = docs.where("length(text) > 800 and lang = 'en'").orderBy("doc_id").first()
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()
    passage = " ".join(f"planted{i}" for i in range(60))
    extra = [(10_001, first.text, "en", "s", None), (10_002, first.text + " more", "en", "s", 5),
             (10_003, f"before {item.text} after", "en", "s", 9), (10_004, passage, "en", "s", 9),
             (10_005, f"{passage}\n{first.text[:200]} and a new end", "en", "s", 9),
             (10_006, "", "en", "s", 0), (10_007, None, None, None, None), (10_002, first.text + " more", "en", "s", 5)]
    docs.unionAll(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{out}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [n for n, _ in corpus_pipeline.STAGES] and len(stages) == 5

    def step(name, docs):
        out = scratch_path(spark, name)
        stages[name](spark, docs, folder).write.parquet(out)
        return spark.read.parquet(out)

    good = step("quality_classifier", docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    known = [i for i in labels if labels[i] == 1]
    assert good.columns == columns and sum(i in kept for i in known) >= 0.97 * len(known)
    assert sum(i in kept for i in labels if labels[i] == 0) <= 0.1 * len(labels)

    clean = step("line_dedup", good)
    rows = sorted({(r.doc_id, r.text) for r in good.collect()}, key=str)
    want = without_repeats([(i, t) for i, t in rows], 50)
    assert clean.columns == columns and clean.count() == good.count()
    assert all(r.text == want[r.doc_id] and r.n_chars == (None if r.text is None else len(r.text)) for r in clean.collect())

    single = step("simhash_near_dedup", clean)
    fps = sorted({(r.doc_id, fingerprint(r.text)) for r in clean.collect()})
    group = {}
    for i, f in fps:
        near = {group[j] for j, g in fps if j in group and (f ^ g).bit_count() <= 2}
        root = min(near, default=i)
        group[i] = root
        group.update({j: root for j in group if group[j] in near})
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(group.values()))

    safe = step("benchmark_decontamination", single)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {r[0] for r in contaminated([(r.doc_id, r.text) for r in single.collect()], items) if r[-1]}
    assert safe.columns == columns and dirty
    assert {r.doc_id for r in safe.collect()} == {r.doc_id for r in single.collect()} - dirty

    packed = step("packing", safe).collect()
    packer = encoder(vocabulary_path()).packed
    lengths = {}
    for r in packed:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {r.doc_id: len(packer(r.text or "")) // 4 + 1 for r in safe.collect()}
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


def test_empty_documents(spark, folder):
    out = scratch_path(spark, "pipeline-empty")
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{out}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").where("false").write.parquet(f"{out}/{t}.parquet")
    assert corpus_pipeline.run(spark, out).count() == 0
    assert simhash.keep_one(spark.read.parquet(f"{out}/documents.parquet")).count() == 0


def test_extra_columns_and_a_very_long_text(spark, folder):
    """Columns named like the operators' own pass through the stages; a long text stays whole."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(200_000))
    rows = [(1, long, "en", "s", len(long), "a", 1, "r"), (2, "a short text of its own", "en", "s", 23, "b", 2, "q"),
            (3, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "_ll_id string, _ll_hash int, _ll_runs string")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("line_dedup", "simhash_near_dedup", "benchmark_decontamination"):
        got = stages[name](spark, docs, folder)
        assert got.columns == docs.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str), name
    assert stages["quality_classifier"](spark, docs, folder).columns == docs.columns
    packed = stages["packing"](spark, docs, folder).collect()
    assert len([r for r in packed if r.doc_id == 1]) > 100 and sum(r.doc_id == 3 for r in packed) == 1
