"""A training corpus from raw documents, in stages that each store what they keep.

Toxic documents go, one document of each class of near duplicates stays, personal data and terms
that give it away are replaced, sources are mixed to their target weights, and what is left is
encoded. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logrisk.llm import bpe, mixing, near_dedup, pii, toxicity
from logrisk.sources.scratch import materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model of the folder's ``labels``."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each class."""
    return near_dedup.representatives(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their texts sanitised."""
    return pii.sanitize(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids, decoded_sha256`` of every document of the mix."""
    encoded = bpe.encode_documents(docs, carried=["source"])
    return encoded.select(
        "doc_id",
        "source",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("personal-data", replace_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Models, alignments and the tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
