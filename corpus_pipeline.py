"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import decontamination, jaccard_join, packing, pii, toxicity
from palimpsest.llm.common import table
from palimpsest.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring at or above the threshold go; learned from the labelled documents that are left here."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, carry=tuple(COLUMNS)).filter(f"score < {toxicity.THRESHOLD}").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity stays: the one with the smallest id."""
    return jaccard_join.deduplicated(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of words that hold a benchmark window are cut from the texts."""
    return decontamination.cut(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus: every piece of every text left, with its bytes and its place in a training sequence."""
    return packing.packed(docs, with_tokens=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", cut_benchmark),
    ("pii", redact_pii),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The learned toxicity stage, the index search and the packing have no SQL form.
ORACLE_SQL = None
