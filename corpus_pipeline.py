"""A training corpus from raw documents: language, exact copies, near copies, mixture of sources, sampled pieces.

Each stage reads what the stage before wrote. Null texts count as empty and leave with the language stage, as no language
can be told; rows without a key are judged by their texts. Of equal rows (key and text) one is left from the second stage
on. An empty table gives an empty result with the last stage's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import exact_dedup, language, mixing, near_dedup, sampled_pieces
from tidewire.session import fresh_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows whose language is unknown or uncertain."""
    return language.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one row of each group of equal texts, that with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one row of each class of near copies, that with the largest doc_id."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows of docs in the order of the mix, through the files in order of name."""
    return mixing.in_mixed_order(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each text with its slot and place in the mix, worked out again from the rows, as Spark does not
    read the files of the stage before in order. mix_slot, mix_place and sample give the order of the mix."""
    return sampled_pieces.sample_segmentations(mixing.in_mixed_order(docs, places=True), carried=mixing.PLACES)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Models and samples decide, which SQL can't express; tests hold the rows against a brute-force run of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written to the shared folder and read again.

    The rows come as Spark reads them; their order in the mix is that of mix_slot, mix_place and sample.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"llm/pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
