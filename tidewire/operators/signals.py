"""Freshness, record counts and telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewire.functions.dates import is_fresh
from tidewire.functions.names import is_blank


def fresh_only(rows: DataFrame, moment: str, now, hours: int = 24) -> DataFrame:
    return rows.where(is_fresh(F.col(moment), now, hours))


def drop_blank(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(~is_blank(F.col(name)))


def union_sources(*sources: DataFrame) -> DataFrame:
    """Rows of every source, duplicates kept."""
    union = sources[0]
    for other in sources[1:]:
        union = union.unionByName(other)
    return union


def count_by_source(records: DataFrame, registry: DataFrame, source: str = "source_name") -> DataFrame:
    """Accepted records per registered source, 0 for sources without any."""
    counts = records.groupBy(source).agg(F.count("*").alias("records"))
    joined = registry.select(source).distinct().join(counts, source, "left")
    return joined.select(source, F.coalesce("records", F.lit(0)).alias("records"))


def count_total(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("records"))


def telemetry(rows: DataFrame, moment: str, source: str) -> DataFrame:
    """Rows per hour and source."""
    hourly = rows.groupBy(F.window(moment, "1 hour").alias("w"), F.col(source)).agg(F.count("*").alias("records"))
    return hourly.select(F.col("w.start").alias("hour"), source, "records")
