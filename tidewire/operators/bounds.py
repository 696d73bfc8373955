"""Size checks that come before any broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows_within(df: DataFrame, limit: int) -> list | None:
    """The rows, when there are at most limit of them; else None. Never fetches more than limit + 1."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None
