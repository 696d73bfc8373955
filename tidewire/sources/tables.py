"""CSV tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def read_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """All columns as text; None when nothing is stored at the path."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    try:
        return spark.read.options(**options).csv(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def csv_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One named column without NULLs; empty when the file or the column is missing."""
    table = read_csv(spark, path)
    if table is None or column not in table.columns:
        return spark.createDataFrame([], "value string")
    value = F.col(f"`{column}`")
    return table.select(value.alias("value")).where(value.isNotNull())
