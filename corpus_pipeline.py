"""Corpus pipeline: the stages a document table goes through, each on all that the one before kept.

Every stage but the last returns the columns of its input. ``docs`` is a file
scan in each stage (``run`` writes and rereads it), so row ids are the same in
every evaluation.

Defined cases: null and empty texts have no letter, so language ID lets them go;
of repeated rows one stays; of equal texts
the largest doc_id stays, of linked ones the smallest; very long texts are read
whole; other columns are carried along to the last stage; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstar.llm import op2_exact, op3_pack, op5_langid, op6_decontaminate, op10_jaccard
from callstar.llm.common import fresh, stage, table, with_row_id


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` (a file scan) whose row id is in ``kept.uid``; ids are unique, so no key is hot."""
    row = fresh(docs, "row_uid")
    return with_row_id(docs, row).join(kept.withColumnRenamed("uid", row), row, "left_semi").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; rejected ones (no letters, or far from every language) go."""
    model = op5_langid.fit(docs, op5_langid.part(3) != 1)
    return docs.filter(~op5_langid.predictor(docs, model)(F.col("text"))["rejected"])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (the one with the largest doc_id)."""
    return keep_rows(docs, op2_exact.exact_groups(docs).filter("kept").select("uid"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents (the one with the smallest doc_id)."""
    return keep_rows(docs, op10_jaccard.jaccard_groups(docs).filter("kept").select("uid"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op6_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that are left."""
    return op3_pack.pack_documents(docs)


Stage = tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]
STAGES: list[Stage] = [("language_id", language_id), ("exact_dedup", exact_dedup), ("ngram_jaccard", ngram_jaccard),
                       ("decontamination", decontamination), ("packing", packing)]

#: Centroids, edit-distance search and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
