"""The corpus queries ``opN_*`` and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (audit, decontaminate, divergence, fim, langid, lines, packing, planes, quality, sentencepieces,
               sharding, simhash, urls)
from ..session import scratch_path
from .common import crc_class, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bit_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written in the plane format and read back."""
    path = scratch_path(spark, "id-planes")
    planes.write_ids(table(spark, sf_dir, "documents"), path)
    return planes.read_documents(spark, path)


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@query
def op3_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return divergence.judge(docs, divergence.references(docs))


@query
def op4_compression_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.learn(docs))
    held_out = F.coalesce(crc_class(F.col("doc_id")) == langid.HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score",
                        "margin", "rejected")


@query
def op5_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page by rules and redirect aliases."""
    return urls.judge(table(spark, sf_dir, "pages"))


SQL["op5_redirect_equivalence"] = urls.SQL


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"),
                                             table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


SQL["op6_benchmark_decontamination"] = decontaminate.SQL


@query
def op7_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occurred earlier."""
    deduped = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("all")))
    deleted = F.expr("aggregate(_ll_runs, 0L, (n, r) -> n + r.b - r.a + 1)")
    return deduped.select("doc_id", F.size(F.split("all", "\n", -1)).cast("bigint").alias("n_lines"),
                          F.coalesce(deleted, F.lit(0)).cast("bigint").alias("n_deleted"), "text")


SQL["op7_line_winnowing"] = lines.SQL


@query
def op8_quality_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every segment of every document."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document over 40 shards, and its shard of 41."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@query
def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of sources, and the terms that set each source apart."""
    return audit.audit(table(spark, sf_dir, "documents"))


SQL["op11_source_divergence_audit"] = audit.SQL


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and arranged for fill-in-middle, and put together again."""
    made = fim.transform(table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("form"), F.col("output"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


SQL["op12_fill_in_middle"] = fim.SQL


@query
def op13_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text they decode to."""
    coded = sentencepieces.encode(table(spark, sf_dir, "documents"), decoded=True)
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(digits, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
