"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, middle, whitening
from quayside.llm.bpe import encode_documents
from quayside.llm.common import table
from quayside.llm.licenses import scan_licenses
from quayside.llm.minhash import near_duplicates
from quayside.llm.packing import pack
from quayside.llm.perplexity import quality_rules
from quayside.llm.suffix_dedup import PASSAGE_WORDS, remove_repeats
from quayside.llm.suffix_tree import score_documents
from quayside.llm.syncmers import fingerprint_documents
from quayside.llm.toxicity import score_toxicity
from quayside.llm.wrappers import extract


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The contract's bytes, and beside them what documents have of passages of over 50 words.
    return remove_repeats(table(spark, sf_dir, "documents"), words=PASSAGE_WORDS, cut_passages=False).drop("kept", "kept_text")


def op2_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", F.col("n_copies"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digests(middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_closed_syncmers, op3_packing, op4_html_extraction, op5_byte_bpe,
        op6_toxicity, op7_suffix_tree, op8_license_scan, op9_quality_rules, op10_ngram_jaccard,
        op11_fill_in_middle, op12_embedding_whitening, op13_benchmark_decontamination,
    )
}
# The others cannot be written in SQL, or not as the contract has them; tests compare them with brute force.
SQL: dict[str, str] = {
    "op11_fill_in_middle": """
WITH given AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
hashed AS (SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM given),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
pieces AS (SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(units[b + 1:n], ''), '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM pieces""",
    "op13_benchmark_decontamination": r"""
WITH item_words AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc_words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
windows AS (SELECT DISTINCT item_id, array_to_string(w[i:i + k - 1], ' ') AS x, k FROM (
    SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)),
places AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
met AS (SELECT doc_id, i, p.k, item_id FROM places p JOIN windows v ON p.x = v.x AND p.k = v.k),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM met) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
}
