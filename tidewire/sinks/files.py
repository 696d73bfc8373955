"""Record files: whole replacement, appended batches, reuse, graph tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.model import to_export
from tidewire.sources.tables import read_csv

_CSV = {
    "header": True, "quote": '"', "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, record_type: str, path: str) -> None:
    """Replace the stored records."""
    to_export(df, record_type).write.mode("overwrite").options(**_CSV).csv(path)


def append_csv(df: DataFrame, record_type: str, path: str, batch_id: int, fresh: bool = False) -> None:
    """One batch into its own folder; writing it again after a failure replaces it instead of doubling it.

    fresh=True starts a new run: all batches stored before go.
    """
    rows = to_export(df, record_type)
    if fresh:
        rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").options(**_CSV).partitionBy("batch_id").csv(path)
    else:
        rows.write.mode("overwrite").options(**_CSV).csv(f"{path}/batch_id={batch_id}")


def reuse_or_compute(
    spark: SparkSession, path: str, record_type: str, target: int, compute: Callable[[], DataFrame]
) -> DataFrame:
    """All stored records when there are at least target, else computed and stored ones."""
    stored = read_csv(spark, path)
    if stored is not None and stored.limit(target).count() >= target:
        return stored
    write_csv(compute(), record_type, path)
    return read_csv(spark, path)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Node and edge tables, one folder per label and per type, ready for a graph loader."""
    nodes.write.mode("overwrite").partitionBy("label").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").partitionBy("type").parquet(f"{path}/edges")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")
