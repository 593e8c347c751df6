"""The registered ``opN_<name>`` queries: each applies one operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import (chat, hard_negatives, host_rules, jaccard_join, license_scan, mixing, oracle, packing,
                         quality_trees, secrets, spotsigs, substring_dedup, warc, whitening)
from vitrine.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = oracle.ORACLE_SQL


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """Where the public vocabulary file lies."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 256 to 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "tier", "sequence_tokens",
                         "step_group")


@register
def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the base rules and their hosts' verdicts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return host_rules.host_rules(docs, "verdict", drop_text=True).select(
        "doc_id", *[f"verdict.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "base_failed", "kept")])


@register
def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of all documents, their edited texts and successors."""
    both = spotsigs.edited_and_next(table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("sigs")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        spotsigs.likeness(F.col("sigs"), F.col("next.sigs")).alias("near_next"))


@register
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: the base kinds, and what the models add."""
    found = secrets.scan(table(spark, sf_dir, "documents"), "spans", ["doc_id"])
    base = F.filter(F.col("spans"), lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter(F.col("spans"), lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"))


@register
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of domains, languages and sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, "mixed").select("doc_id", "mixed.*")


@register
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC files, found again through the capture index and read back."""
    pages = table(spark, sf_dir, "pages")
    folder = shared_folder(spark, "warc")
    warc.write_index(warc.write_archives(pages, folder), folder)
    wanted = pages.select(warc.url_key(F.col("url")).alias("url_key"),
                          F.col("page_id").cast("long").alias("id")).distinct()
    records = warc.read_records(warc.lookup(wanted, folder), folder, payloads=False)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", "refers_to")


@register
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations rendered from every participant's perspective."""
    return chat.rotate(table(spark, sf_dir, "conversations"))


@register
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by trees learned from the labels."""
    docs = table(spark, sf_dir, "documents")
    return quality_trees.score(docs, quality_trees.train(docs, table(spark, sf_dir, "labels")))


@register
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License wording in all documents."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a shingle likeness of 0.75 or more."""
    return jaccard_join.components(table(spark, sf_dir, "documents"))


@register
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows that start earlier elsewhere."""
    return substring_dedup.digest(substring_dedup.dedup(table(spark, sf_dir, "documents")))


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four leading whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth embedding, searched in all of them."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                           .otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)
