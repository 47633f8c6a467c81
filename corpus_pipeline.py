"""From documents to packed sequences: five stages, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import bounded, table
from quayside.llm.minhash import near_duplicates
from quayside.llm.packing import pack
from quayside.llm.perplexity import quality_rules
from quayside.llm.suffix_dedup import remove_repeats
from quayside.llm.toxicity import score_toxicity
from quayside.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# The least number of words of a repeated passage: over 50.
PASSAGE_WORDS = 51


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = score_toxicity(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the perplexity band reject go."""
    bounded(spark)
    return quality_rules(docs.select(*COLUMNS), keep=COLUMNS).where("kept").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays, of rows repeated entirely one."""
    bounded(spark)
    docs = docs.select(*COLUMNS)
    first = near_duplicates(docs).groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
    first = first.select(F.col("r.doc_id").alias("_id"), F.col("r.text_hash").alias("_hash")).distinct()
    hashed = docs.withColumn("_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = hashed.join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_h"]).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, or of 400 bytes, that occur elsewhere too are cut out of every text; all documents stay, if empty."""
    bounded(spark)
    left = remove_repeats(docs.select(*COLUMNS), keep=COLUMNS, words=PASSAGE_WORDS)
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest, packed."""
    bounded(spark)
    return pack(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_copies", near_copies),
    ("passages", passages),
    ("packing", packed),
]
# SQL can express neither the classifier nor the language model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
