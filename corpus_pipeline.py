"""The corpus pipeline: five stages from raw documents to a weighted mixture.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each stage's rows to the shared checkpoint
folder as Parquet and reads them again, so a stage works on what its predecessor kept and a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastegrid.llm import decontaminate, lines, minhash, queries, toxicity
from tastegrid.session import configure, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field scores below 0.5; it learns from the labelled ones that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels, queries.crc_mod("doc_id", 5) != 0))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one has; one that loses all of them goes."""
    return lines.without_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicate texts."""
    return minhash.one_per_class(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window like a benchmark item."""
    return decontaminate.without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: chosen documents with their domain, tokens and copies."""
    return queries.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_documents),
    ("decontamination", decontaminated),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # SQL cannot express the random field, ProbMinHash and SimHash stages


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
