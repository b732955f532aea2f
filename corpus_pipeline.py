"""A training corpus from `documents`: five stages, each over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import cleared, documents, scratch, staged
from tidemark.llm.decontam import drop_leaks
from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.jaccard import similar_dedup
from tidemark.llm.packing import pack
from tidemark.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal documents, the one with the largest doc_id."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, the one with the smallest doc_id: SimHash with multi-index hashing proposes links,
    exact Jaccard similarity of 5-word shingles >= 0.8 confirms them, a prefix filter finds the rest."""
    return similar_dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("SimHash near-dedup", near), ("decontamination", decontaminate), ("packing", packing)]

#: SQL has neither the classifier nor the fingerprints; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written before the next reads it,
    and then what the stage needed on the way, its input too, is deleted."""
    docs, before = documents(spark, sf_dir), ()
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name.replace(' ', '-')}")
        with cleared(spark, *before):
            docs = staged(stage(spark, docs, sf_dir), name, path)
        before = (path,)
    return STAGES[-1][1](spark, docs, sf_dir)
