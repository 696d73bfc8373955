"""Sorts, limits and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def sort_names(names: DataFrame, column: str = "raw_name") -> DataFrame:
    return names.orderBy(column)


def limit_target(accepted: DataFrame, target: int, order: Sequence[str | Column] = ("src_rank", "item_pos")) -> DataFrame:
    """First target accepted rows in arrival order."""
    return accepted.orderBy(*order).limit(target)


def page_offset(rows: DataFrame, start: int, size: int, order: Sequence[str | Column]) -> DataFrame:
    """One page by offset; empty behind the last row. Deep pages sort all rows before them: see page_after."""
    return rows.orderBy(*order).offset(start).limit(size)


def page_after(rows: DataFrame, published: str, tie: str, last: tuple | None, size: int) -> DataFrame:
    """The page behind the last row shown, newest first; costs the same at any depth."""
    if last is not None:
        moment, key = F.lit(last[0]), F.lit(last[1])
        rows = rows.where((F.col(published) < moment) | ((F.col(published) == moment) & (F.col(tie) > key)))
    return sort_recent(rows, published, tie).limit(size)


def sort_recent(rows: DataFrame, published: str, tie: str) -> DataFrame:
    return rows.orderBy(F.desc(published), tie)


def sample_head(mapping: DataFrame, count: int = 10) -> DataFrame:
    return mapping.orderBy("raw_name").limit(count)
