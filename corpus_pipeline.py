"""From raw documents to packed sequences, in stages that each read what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiq.llm import decontam, langid, linededup, packing, simhash
from civiq.llm.common import materialize, read_table, remainder
from civiq.session import apply_settings

ORACLE_SQL = None
LEAST_CONFIDENCE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language the model gives less than ``LEAST_CONFIDENCE``, go."""
    apply_settings(spark)
    model = langid.train(docs.where(remainder(F.col("doc_id"), 3) != 1))
    return langid.keep_identified(docs, model, LEAST_CONFIDENCE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later lines that match an earlier one go; a document goes that has no line with a word left."""
    apply_settings(spark)
    return linededup.deduplicate(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles of a similarity of 0.8 or more the first stays."""
    apply_settings(spark)
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item within its error budget go."""
    apply_settings(spark)
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, each with its sequence and place in it."""
    apply_settings(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_dedup),
    ("decontamination", decontamination), ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = read_table(apply_settings(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
