"""Registered queries of the operators that read texts through models."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm import language, near_dedup, pii_tagger, sampled_pieces
from tidewire.llm.common import span_digest, table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii_tagger.find_personal_data(docs, pii_tagger.train(pii_tagger.training_windows(docs)))
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(pii_tagger.KINDS) for x in (k, i)))
    ranked = lambda xs: F.sort_array(F.transform(xs, lambda x: F.struct(rank[x["kind"]], x["start"], x["stop"], x["kind"].alias("kind"))))
    named = lambda xs: F.transform(ranked(xs), lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"]))
    base = F.filter("spans", lambda x: x["base"])
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in pii_tagger.KINDS),
        span_digest(named(base))[1].alias("base_sha256"), span_digest(named(F.col("spans")))[0].alias("spans"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs)).drop("name")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents")).drop("name")


def op10_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_pieces.sample_segmentations(table(spark, sf_dir, "documents"))


QUERIES = {"op1_pii": op1_pii, "op10_sampled_pieces": op10_sampled_pieces, "op8_language_id": op8_language_id, "op9_near_dedup": op9_near_dedup}
ORACLES: dict[str, str] = {}
