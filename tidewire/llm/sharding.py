"""Weighted rendezvous hashing of record keys over shards, with gapless slots.

Each shard i of weight w scores a key with -w / ln(u), where u in (0, 1) is a hash of key and shard; the best score wins.
A shard that is added wins only the keys that it scores best, so rows move into it alone. Slots number the rows of each
shard without gaps, through counts per bucket of the key's hash, so that no task ever sorts a whole shard.

A null key takes its place by its text; null texts count as empty. Repeated rows get different slots of one shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewire.llm.common import stored, whole_text

#: Hex digits of the key's hash that make a bucket: 4,096 buckets a shard.
BUCKET_DIGITS = 3
#: Shards that one call may have.
MAX_SHARDS = 1024
_HASH_DIGITS = 13


def _unit(key: Column, shard: int) -> Column:
    """A number strictly between 0 and 1 from the key's and shard's hash."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, _HASH_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_HASH_DIGITS)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, that wins a text key; the lower one of equal scores. Weights are positive."""
    if not 1 < len(weights) <= MAX_SHARDS or min(weights) <= 0:
        raise ValueError(f"2 to {MAX_SHARDS} positive weights are needed")
    scores = [F.struct((F.lit(-float(w)) / F.ln(_unit(key, i))).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)]
    return -F.greatest(*scores)["shard"]


def assign_shards(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot; with grown weights also grown_shard."""
    texts = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5("text")))
    rows = stored(
        texts.select(
            "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"),
            shard_of(name, weights).alias("shard"),
            (shard_of(name, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
            F.substring(F.md5(name), 1, BUCKET_DIGITS).alias("bucket")),
        "shards",
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "bucket").count().select(
        "shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32"))
    # The rows lie by shard and bucket already, for their numbers within.
    return rows.withColumn("within", within).join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"), "grown_shard")
