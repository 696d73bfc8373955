"""Landed payloads: (source_name, url, status, body, fetched_at), one row per fetched document."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.functions.links import root_domain

PAYLOAD_SCHEMA = "source_name string, url string, status int, body string, fetched_at timestamp"


def registry_frame(spark: SparkSession, feeds: list[tuple[str, str]]) -> DataFrame:
    """(rank, source_name, url, format) of an ordered feed list."""
    names, urls = zip(*feeds)
    frame = spark.createDataFrame(pa.table({"rank": pa.array(range(len(feeds)), pa.int32()), "source_name": names, "url": urls}))
    return frame.withColumn("format", feed_format(F.col("url")))


def feed_format(url: Column) -> Column:
    """json for feed addresses with 'api' in them, else rss."""
    return F.when(F.contains(url, F.lit("api")), F.lit("json")).otherwise(F.lit("rss"))


def ok_payloads(payloads: DataFrame) -> DataFrame:
    return payloads.where(F.col("status") == 200)


def split_corrupt(parsed: DataFrame, corrupt: str = "_corrupt") -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) payloads of a parse with a corrupt-record column; one bad feed stops no other."""
    return parsed.where(F.col(corrupt).isNull()), parsed.where(F.col(corrupt).isNotNull())


def quarantined(parsed: DataFrame) -> DataFrame:
    """The payloads whose body could not be read, as they came, with reason: failed (by status), empty or unreadable."""
    payload = [c for c in parsed.columns if c not in ("doc", "_corrupt")]
    reason = F.when(F.col("status") != 200, "failed").when(F.trim("_corrupt") == "", "empty").otherwise("unreadable")
    return parsed.where(F.col("_corrupt").isNotNull() | (F.col("status") != 200)).select(*payload, reason.alias("reason"))


def read_payload_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Continuous intake of payload files, keyed by root domain."""
    stream = spark.readStream.schema(PAYLOAD_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return with_domain(stream)


def with_domain(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("domain", root_domain(F.col("url")))
