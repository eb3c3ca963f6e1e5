"""From documents to training pieces: toxic documents go, repeated line runs go, one document of each group of near copies stays,
sources are mixed to their weights, and what is left is encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kontora.llm import line_runs, mixing, near_dups, pieces, toxicity
from kontora.llm.common import documents, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go; the machine is fitted on the labelled ones among ``docs``."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words or more go; so do documents that lose their last word."""
    return line_runs.deduplicated(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group linked by 0.8 of five-word shingles stays."""
    return near_dups.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document and epoch of the mix, with the words it takes."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row of the mix; a document that several epochs take has other draws in each."""
    return pieces.encoded(docs, copies=True)


STAGES = [
    ("toxicity", drop_toxic), ("line dedup", dedup_lines), ("MinHash near-dedup", dedup_near),
    ("mixing sources", mix_sources), ("SentencePiece encoding", encode),
]

#: Hashed features, registers and permutations are beyond SQL; the tests check each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
