"""The corpus pipeline: its stages in order, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logtables.llm.common import remainder, stored, table
from logtables.llm.decontamination import decontaminate
from logtables.llm.minhash import drop_near_duplicates
from logtables.llm.packing import pack_documents
from logtables.llm.quality import fit_quality, keep_quality
from logtables.llm.queries import public_vocabulary
from logtables.llm.toxicity import drop_toxic, fit_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5. The model learns from labelled documents of the stage's input."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return drop_toxic(docs, model)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.7. The model learns from labelled documents of the stage's input."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    return keep_quality(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 and more, on five words, connect."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty lie in a window of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces with their places in sequences."""
    return pack_documents(docs, public_vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality classifier", quality),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]
#: Training, tokenising and similarity of whole texts have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
