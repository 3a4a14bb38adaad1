"""Documents to packed training sequences, as stages that each read what the last one wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haltwise.llm import common, jaccard, packing, quality, secrets

# no SQL: the classifier is fitted, and the last stage uses a tokenizer
ORACLE_SQL = None


def _key(text_hash: Column) -> Column:
    """A document's row: its id, which may be null or repeated, and the hash of its text."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), text_hash)


def _staying(docs: DataFrame, decided: DataFrame, once: bool = False) -> DataFrame:
    """The rows of `docs` that `decided` (doc_id, text_hash) names, with `once` each one time."""
    name = common.unused(docs, "_key")
    named = decided.select(_key(F.col("text_hash")).alias(name)).distinct()
    keyed = docs.withColumn(name, _key(F.xxhash64("text"))).join(named, name, "left_semi")
    # the join has dealt the rows by their key already
    return (keyed.dropDuplicates([name]) if once else keyed).select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps."""
    labels = common.table(spark, sf_dir, "labels")
    decided = common.save(quality.score(docs, labels).filter("kept"), "kept")
    return _staying(docs, decided)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by shingles: that of the smallest id, and of the
    smallest text hash under that id; ids may be null or repeated, and a null one is the last.
    Documents without words all stay but for repeated rows."""
    found = jaccard.jaccard_components(docs)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    first = (
        found.filter("n_shingles > 0")
        .groupBy("component")
        .agg(F.min_by(F.struct("doc_id", "text_hash"), order).alias("least"))
        .select("least.*")
    )
    decided = found.filter("n_shingles = 0").select("doc_id", "text_hash").unionByName(first)
    decided = common.save(decided, "first")
    return _staying(docs, decided, once=True)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    _, ledger = secrets.scan_documents(docs)
    masked = secrets.redact(docs, ledger, secrets.RULES)
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of packed sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
