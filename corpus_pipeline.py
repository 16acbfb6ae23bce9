"""The corpus pipeline: five operators in turn, each working on all that the one before kept.

``run`` gives the mix: one row for each document that is taken, with its number of copies and the words they make.
Stages are written to shared storage in between, so a lost executor costs the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirework.llm.decontamination import decontaminate
from quirework.llm.line_dedup import dedup_documents
from quirework.llm.mixing import pareto_mix
from quirework.llm.shared import release, stage
from quirework.llm.toxicity import reject_toxic
from quirework.llm.vertical_join import drop_near_duplicates
from quirework.session import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated trees call toxic go."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose set of words is like an earlier line's, at a similarity of 0.8, go from their texts."""
    return dedup_documents(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, at five-word shingles and a similarity of 0.8, the smallest id stays."""
    return drop_near_duplicates(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80% of a benchmark item's five-word shingles go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: doc_id, source, size, source_size, target, copies and taken of each document taken."""
    return pareto_mix(docs).where("copies > 0")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
]

#: SQL cannot express the trees of the first stage; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. A stage's table is deleted once the next one is written; the last one before the mix stays, as
    the result is read from it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
            if before is not None:
                release(before)
            before = docs
    return docs
