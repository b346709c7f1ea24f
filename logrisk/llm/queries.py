"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logrisk.llm import (
    bpe,
    decontamination,
    fill_middle,
    fingerprints,
    html_text,
    merkle,
    mixing,
    near_dedup,
    pii,
    suffix_dedup,
    token_counts,
    topk_search,
    toxicity,
)
from logrisk.llm.oracles import LLM_ORACLES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return cleaned.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_text.extract(_table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.encode(pii.span_text(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        pii.span_text(F.concat("base", "added")).alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.transform(_table(spark, sf_dir, "documents"))
    restored = fill_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(restored, "UTF-8"), 256).alias("restored_sha256"),
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle.verify_documents(_table(spark, sf_dir, "documents"))
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


LLM_QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_main_text": op3_main_text,
    "op4_top_k": op4_top_k,
    "op5_token_counts": op5_token_counts,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_personal_data": op7_personal_data,
    "op8_toxicity": op8_toxicity,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_source_mix": op10_source_mix,
    "op11_fill_middle": op11_fill_middle,
    "op12_decontamination": op12_decontamination,
    "op13_manifest": op13_manifest,
}
