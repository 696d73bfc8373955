"""Exact duplicates by progressive refinement: length, then a hash of the prefix, then a hash of the whole text.

After each of the first two levels, the keys that several rows share are marked in a bitmap of fixed size, which the next
scan looks up in place. A row whose bit is unset is alone for certain, so its text is neither hashed further nor moved; a
row whose bit is set by chance is only refined once more, and the last level decides by SHA-256 alone. Texts are never
shuffled to find copies: only lengths, hashes and ids are.

Null texts count as empty, so they equal each other and the empty text. Rows without a key take part; a group of such rows
alone has a null keep id. Rows that repeat key and text are one document's repeats: exactly one of them is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewire.llm.common import ROW, packed, stored, unpacked, whole_text
from tidewire.llm.keymap import key_map, maybe_in

#: Characters whose hash is the second level.
PREFIX_CHARS = 256


def _shared(rows: DataFrame, *key: Column) -> Column:
    """The map of the keys that more than one row has."""
    names = [f"k{i}" for i in range(len(key))]
    counts = rows.select(*(k.alias(name) for k, name in zip(key, names))).groupBy(*names).count()
    return key_map(counts.where("count > 1").select(*names))


def _may_repeat(texts: DataFrame) -> Column:
    """Whether a row (column text) may have a copy, after the levels of length and prefix."""
    length, prefix = F.octet_length("text"), F.xxhash64(F.substring("text", 1, PREFIX_CHARS))
    same_length = texts.where(maybe_in(_shared(texts, length), length))
    return maybe_in(_shared(same_length, length, prefix), length, prefix)


def copy_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id (largest key of the equal texts), group_size, kept, text_sha256.

    text_sha256 is null for rows that the first levels found alone, unless digest_all asks for it.
    """
    texts = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    full = F.sha2("text", 256)
    rows = stored(
        texts.withColumn("candidate", _may_repeat(texts)).select(
            "doc_id", "candidate", (full if digest_all else F.when(F.col("candidate"), full)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row")),
        "exact-keys",
    )
    lowest = F.lit(-(2**63)) if dict(texts.dtypes)["doc_id"] == "bigint" else F.lit("")
    groups = rows.where("candidate").groupBy(F.col("text_sha256").alias("content")).agg(
        F.max("doc_id").alias("keep"), F.max_by("row", F.coalesce("doc_id", lowest)).alias("keep_row"), F.count(F.lit(1)).alias("size"))
    # Rows found alone get a value of their own, which matches no group and spreads them.
    content = F.when(F.col("candidate"), F.col("text_sha256")).otherwise(F.concat(F.lit("row "), F.col("row")))
    return rows.withColumn("content", content).join(groups, "content", "left").select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts, the one with the largest key. Only rows that may have a copy move."""
    rows = packed(docs, doc_id=F.col(key), text=whole_text(text))
    marked = rows.withColumn("candidate", _may_repeat(rows)).drop("text")
    texts = F.coalesce(F.col(ROW)[text], F.lit(""))
    candidates = marked.where("candidate").select(ROW, "doc_id", F.sha2(texts, 256).alias("content"))
    keepers = candidates.groupBy("content").agg(F.max("doc_id").alias("keep"))
    kept = candidates.join(keepers, "content").where(F.col("doc_id").eqNullSafe(F.col("keep")))
    once = kept.groupBy("content").agg(F.first(ROW).alias(ROW))
    return unpacked(marked.where("not candidate").select(ROW).unionByName(once.select(ROW)))
