"""Order-aware duplicate removal.

Each operator shrinks a group before it shuffles: the row_number() = 1 windows run as a group limit in every map
task first, the time-bucketed ones send one row per key and bucket. A key with a third of all rows stays small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewire import fixed_values as fixed
from tidewire.functions.names import author_from_id, valid_author
from tidewire.functions.text import non_empty


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def first_seen_orgs(items: DataFrame) -> DataFrame:
    """items(src_rank, item_pos, id, author, ...): first item of each author, ignoring case."""
    authored = items.withColumn("author", author_from_id(F.col("author"), F.col("id")))
    usable = authored.where(valid_author(F.col("author")))
    return first_per_key(usable, [F.lower("author")], ["src_rank", "item_pos"])


def first_seen_products(items: DataFrame) -> DataFrame:
    """First item of each id, case-sensitive; blank ids are skipped."""
    return first_per_key(items.where(non_empty(F.col("id")).isNotNull()), ["id"], ["src_rank", "item_pos"])


def seen_anti(items: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet."""
    return items.join(seen.select(key), key, "left_anti")


def dedup_signatures(items: DataFrame, seen: DataFrame | None, signature: str, order: Sequence[str | Column]) -> DataFrame:
    """First row of each signature that the store does not hold yet."""
    fresh = first_per_key(items, [signature], order)
    return fresh if seen is None else seen_anti(fresh, seen, signature)


def dedup_ttl(
    sightings: DataFrame, signature: str, ts: str = "ts", tie: str = "event_id", days: int = fixed.DEDUP_TTL_DAYS
) -> DataFrame:
    """Sightings without another one of the same signature in the days before; each sighting renews the term.

    Within a bucket as long as the term, only the first row can stay, and its predecessor is the last row of the
    bucket before. So one row per signature and bucket decides, however many sightings there are.
    """
    span = days * 86400
    bucket = F.floor(F.unix_micros(ts) / F.lit(span * 1_000_000))
    first = F.min(F.struct(F.col(ts), F.col(tie), F.struct(*sightings.columns).alias("row")))
    buckets = sightings.groupBy(F.col(signature).alias("_sig"), bucket.alias("_bucket")).agg(
        first.alias("_first"), F.max(ts).alias("_last")
    )
    before = F.lag("_last").over(Window.partitionBy("_sig").orderBy("_bucket"))
    gap = F.unix_micros(F.col("_first")[ts]) - F.unix_micros(F.col("_before"))
    kept = buckets.withColumn("_before", before).where(F.col("_before").isNull() | (gap > span * 1_000_000))
    return kept.select("_first.row.*")


def change_between(
    rows: DataFrame, key: str, ts: str, tie: str, value: str, bucket: str = "day", name: str = "change"
) -> DataFrame:
    """rows + the value's change since the key's previous row by (ts, tie), NULL for the first.

    A long history is cut into calendar buckets: rows look back inside their bucket, and the bucket's first row
    takes the last value of the bucket before from a table with one row per key and bucket.
    """
    cut = rows.withColumn("_bucket", F.date_trunc(bucket, ts))
    closing = cut.groupBy(F.col(key), F.col("_bucket")).agg(
        F.max(F.struct(F.col(ts), F.col(tie), F.col(value).alias("value"))).alias("_close")
    )
    before = F.lag("_close.value").over(Window.partitionBy(key).orderBy("_bucket"))
    opening = closing.select(F.col(key).alias("_key"), F.col("_bucket").alias("_edge"), before.alias("_opening"))
    inside = F.lag(value).over(Window.partitionBy(key, "_bucket").orderBy(ts, tie))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_bucket").eqNullSafe(F.col("_edge"))
    joined = cut.withColumn("_inside", inside).join(opening, same, "left")
    changed = joined.withColumn(name, F.col(value) - F.coalesce("_inside", "_opening"))
    return changed.drop("_bucket", "_inside", "_key", "_edge", "_opening")
