"""A cleaning pipeline over ``documents``, stage by stage through stored Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridfill.llm import decontaminate, line_dedup, near_dedup, packing, quality
from gridfill.llm.common import stored
from gridfill.llm.queries import tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on them and the labels, finds neither low nor toxic."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their sources' boilerplate lines."""
    return line_dedup.drop_boilerplate(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked at similarity 0.8 over five words: that with the least id."""
    return near_dedup.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed into sequences of up to 2048 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), tokenizer_file())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None
"""The classifier and the tokenizer are beyond SQL; ``tests/llm`` holds the stages against plain Python."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
