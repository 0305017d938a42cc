"""Registered queries of the subpackage: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from loanloom.llm import (
    attention_lm, centroids, check_sql, conversation_repair, decontaminate, hilbert, jaccard_join, kneser_ney, license_scan, pieces,
    quality_rules, suffix_dedup, token_counts, toxicity,
)
from loanloom.llm.tokenizers import byte_bpe, pieces as piece_model

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(mod: int):
    """crc32 of doc_id as text, modulo ``mod``; a null id counts as 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)), F.lit(0))


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(remainder(5) != 0))
    out = toxicity.scores(docs, model)
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_hilbert_shards")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    placed = hilbert.shards(table(spark, folder, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


@query("op3_suffix_dedup", check_sql.SUFFIX_DEDUP)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup.deduplicated(table(spark, folder, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_jaccard_join", check_sql.JACCARD_JOIN)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"), size=4, percent=85)


@query("op5_winnowing", check_sql.WINNOWING)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


@query("op6_kneser_ney")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_sentencepiece")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trips(table(spark, folder, "documents"), piece_model())


@query("op8_quality_rules")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    out = quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.array_join("broken", ",").alias("broken_rules"))


@query("op9_attention_lm")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return attention_lm.scores(table(spark, folder, "documents").select("doc_id", "text"), remainder(10) == 0, *byte_bpe())


@query("op10_token_counts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    none = F.lit(None).cast("array<int>")
    held = docs.select("doc_id", "text", none.alias("lengths"), none.alias("tree"), token_counts.derived_edits().alias("edits"))
    out = token_counts.updated(held, *byte_bpe())
    return out.select("doc_id", "n_before", "n_tokens", "n_encoded", F.char_length("text").cast("long").alias("n_chars"),
                      F.size("lengths").cast("long").alias("n_leaves"))


@query("op11_conversation_repair", check_sql.CONVERSATION_REPAIR)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    found = conversation_repair.digests(conversation_repair.damaged(given)).withColumnRenamed("conv_id", "of")
    whole = given.select("conv_id").distinct()
    out = whole.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    # no rows after damage: nothing to repair
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query("op12_license_scan", check_sql.LICENSE_SCAN)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    out = license_scan.labelled(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op13_centroids", check_sql.CENTROIDS)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    out = centroids.clustered(table(spark, folder, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    CHECKS["pipeline"] = corpus_pipeline.ORACLE_SQL
