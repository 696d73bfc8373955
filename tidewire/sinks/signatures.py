"""A store of seen signatures that one run writes and the next reads.

One folder per batch, in it one per shard (the first digits of the signature's SHA-256), files sorted by signature. There are no
Parquet bloom filters: joins don't read them, and each takes 1 MB of a file however small. A look-up asks the store for the signatures of the new rows, so Spark prunes the shards that none of them
falls into before it opens a file; the rest is a join on shard and signature, in which no side is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.operators.dedup import dedup_signatures

#: Hex digits of a shard's name: 256 shards a batch.
SHARD_DIGITS = 2
_STORED = "sig string, batch long, shard string"


def _shard(signature: Column) -> Column:
    return F.substring(F.sha2(signature.cast("binary"), 256), 1, SHARD_DIGITS)


class SignatureStore:
    """The store in one folder. Batches are numbered by the caller, in rising order."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def stored(self, before: int) -> DataFrame:
        """(sig, batch, shard) of all batches with a smaller number; none where the folder is new."""
        try:
            rows = self.spark.read.schema(_STORED).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], _STORED)
        return rows.where(F.col("batch") < before)

    def seen(self, signatures: DataFrame, before: int) -> DataFrame:
        """Which of the signatures (one column) earlier batches stored, each once."""
        name = signatures.columns[0]
        asked = signatures.where(F.col(name).isNotNull()).select(F.col(name).cast("string").alias("sig")).withColumn("shard", _shard(F.col("sig")))
        hits = self.stored(before).join(asked, ["shard", "sig"], "left_semi")
        return hits.select(F.col("sig").alias(name)).distinct()

    def unseen(self, items: DataFrame, signature: str, order: Sequence[str | Column], batch: int) -> DataFrame:
        """The first row of each signature that no earlier batch stored. What the batch itself or later ones store changes nothing."""
        return dedup_signatures(items, self.seen(items.select(signature), batch), signature, order)

    def write(self, rows: DataFrame, signature: str, batch: int) -> None:
        """Store the signatures of rows as a batch; written again, it takes the place of the first. Null signatures are left out."""
        sigs = rows.where(F.col(signature).isNotNull()).select(F.col(signature).cast("string").alias("sig")).withColumn("shard", _shard(F.col("sig")))
        sorted_ = sigs.hint("rebalance", "shard").sortWithinPartitions("shard", "sig")
        sorted_.write.mode("overwrite").partitionBy("shard").parquet(f"{self.path}/batch={batch}")
