"""Corpus pipeline: quality classifier, exact dedup, MinHash near-dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes to the shared folder and reads again as the next stage's
``docs``. All stages but the last return the columns of ``docs`` for the rows they keep. Null ids, null and empty texts, ties, repeated
rows, empty tables and further columns are treated as each operator's docstring says; rows with a null id are kept by every filter but the classifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm.common import table, written
from tidewright.llm.decontaminate import decontaminate
from tidewright.llm.exact_dedup import exact_dedup
from tidewright.llm.near_dedup import near_duplicates
from tidewright.llm.packing import pack_documents
from tidewright.llm.quality import classify_quality


def _keep(docs: DataFrame, verdicts: DataFrame, condition: str, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id has a verdict that meets the condition; each row once."""
    good = verdicts.filter(condition).select(key).distinct()
    return docs.join(good, docs[key].eqNullSafe(good[key]), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return _keep(docs, classify_quality(docs, table(spark, sf_dir, "labels")), "predicted = 1")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return _keep(docs, exact_dedup(docs), "kept")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (shingles of five words, similarity 0.8) one document stays."""
    return _keep(docs, near_duplicates(docs), "kept")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return _keep(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")), "not contaminated")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, each with its sequence and place."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: A trained classifier, an approximate search and a packing are not SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
