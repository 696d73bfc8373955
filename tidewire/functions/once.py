"""Costly values that are to be worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df + name. Filters on the new column stay above it: the optimizer moves no filter through an explode,
    while it would copy the expression of a plain column into every filter and projection that uses it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def bind(value: Column, build: Callable[[Column], Column]) -> Column:
    """build(value), with the value worked out once however often build uses it; for use inside lambdas."""
    return F.get(F.transform(F.array(value), build), F.lit(0))
