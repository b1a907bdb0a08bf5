"""Corpus pipeline: documents pass through the stages in order, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from strata.sources.files import scratch_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counterfactual-regularised classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later copies of repeated line runs of 50 words or more; whole copies go."""
    return line_dedup.dedup_lines(docs, keep_emptied=False)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 over five-word shingles."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than 5 % lie in benchmark passages of 13 words."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in bins of 2048 words, no source and no equal text twice in a bin."""
    return packing.pack(docs, packing.word_size(), packing.text_cluster())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_bins),
]

# Stages hold learned scores and similarity joins that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the documents of ``sf_dir``; each result is stored as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
