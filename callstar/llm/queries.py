"""Queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callstar.llm import (op1_wrapper, op2_exact, op3_pack, op4_toxicity, op5_langid, op6_decontaminate, op7_rotate, op8_hilbert, op9_pii,
                          op10_jaccard, op11_warc, op12_collocations, op13_merkle)
from callstar.llm.common import table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_wrapper.main_texts(table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_exact.exact_groups(table(spark, sf_dir, "documents")).drop("uid")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_pack.pack_documents(table(spark, sf_dir, "documents"))


def op4_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_langid.identify(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_rotate.rotate(table(spark, sf_dir, "conversations"))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_hilbert.shard_documents(table(spark, sf_dir, "documents"))


def op9_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_pii.find(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_jaccard.jaccard_groups(table(spark, sf_dir, "documents")).drop("uid", "kept")


def op11_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_collocations.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_merkle.manifest(table(spark, sf_dir, "documents")).drop("position", "witness")


QUERIES = {f.__name__: f for f in (op1_main_text, op2_exact_dedup, op3_packing, op4_toxicity_scores, op5_language_id, op6_decontamination, op7_perspectives, op8_hilbert_shards, op9_weak_pii, op10_ngram_jaccard,
                                   op11_warc_salvage, op12_phrase_collocations, op13_merkle_manifest)}

#: Exact duplicates need no fingerprint in SQL: grouping by the text is the definition.
EXACT_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (SELECT doc_id, text, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) AS r FROM d)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(text) AS text_sha256 FROM f
"""

ORACLES = {"op2_exact_dedup": EXACT_SQL, "op7_perspectives": op7_rotate.ORACLE, "op10_ngram_jaccard": op10_jaccard.ORACLE,
           "op11_warc_salvage": op11_warc.ORACLE,
           "op12_phrase_collocations": op12_collocations.ORACLE, "op13_merkle_manifest": op13_merkle.ORACLE}
