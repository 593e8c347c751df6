"""Corpus preparation: documents to packed training windows, in five stages.

Each stage reads what its predecessor wrote, works on all of it, and hands on
the columns of ``documents`` (the last one: packed pieces).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import host_rules, jaccard_join, mixing, packing, secrets
from vitrine.llm.common import free_name, stage, table
from vitrine.llm.queries import tokenizer_path

# The whole corpus is the budget, and no document is read more than twice.
MIX_SHARE, MIX_EPOCHS = 1.0, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their host's verdict reject go."""
    verdict = free_name(docs, "verdict")
    return (host_rules.host_rules(docs, verdict).where(F.col(verdict)["kept"])
            .select(*docs.columns))


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; ``n_chars`` follows."""
    spans = free_name(docs, "spans")
    found = secrets.scan(docs, spans, docs.columns)
    masked = found.withColumn("text", secrets.redacted(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind))
                                   .otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document comes once for each epoch that reads it."""
    mixed = free_name(docs, "mixed")
    return mixing.mix(docs, mixed, share=MIX_SHARE, max_epochs=MIX_EPOCHS).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of several context tiers, as pieces with their ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_dedup), ("secrets", secret_scan),
          ("mixing", mix_sources), ("packing", pack_windows)]

# The shingle classes, the trained models and the vocabulary are beyond SQL; the
# stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
