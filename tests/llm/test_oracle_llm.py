"""Corpus queries against their DuckDB statements, and what has none."""

import pytest

import __spark_entry__ as E
from ledgerlens.llm import registry, simhash
from oracle_harness import compare


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, duck_small, small, name):
    res = compare(spark, duck_small, name, registry.QUERIES[name], registry.SQL[name], small)
    assert res["cols_match"] and res["match"], res


def test_all_are_registered():
    names = E.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names


# The columns that the queries' contracts fix, by operator.
COLUMNS = {
    "op1": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op2": "doc_id bigint, fingerprint string, component_id bigint",
    "op3": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op4": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op5": "page_id bigint, host string, path string, rule string, verdict string",
    "op6": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op8": "doc_id bigint, held_out boolean, score double, predicted int",
    "op12": "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, "
            "restored_sha256 string",
    "op13": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
}


def test_audit_columns(spark, small):
    got = registry.QUERIES["op11_source_divergence_audit"](spark, small)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith("op11_")))
def test_one_row_per_document(spark, small, small_docs, name):
    table = "pages" if name.startswith("op5_") else "documents"
    rows = spark.read.parquet(f"{small}/{table}.parquet").count()
    got = registry.QUERIES[name](spark, small)
    fixed = dict(c.rsplit(" ", 1) for c in COLUMNS.get(name.split("_")[0], "doc_id bigint").split(", "))
    assert fixed.items() <= dict(got.dtypes).items()
    if name.startswith("op2_"):
        assert {r.doc_id: r.fingerprint for r in got.collect()} == {
            r.doc_id: f"{simhash.fingerprint((r.text or '').encode()):016x}" for r in small_docs.collect()}
    key = "page_id" if table == "pages" else "doc_id"
    assert got.select(key).distinct().count() == rows
    if not name.startswith("op9_"):
        assert got.count() == rows
