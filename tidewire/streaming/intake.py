"""Fresh-only admission, restart-safe appends and hourly telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.functions.dates import is_fresh


def admit_fresh(stream: DataFrame, moment: str = "ts", arrival: str = "arrival_ts", hours: int = 24) -> DataFrame:
    """Events at most hours older than their arrival and not ahead of it; the watermark serves later stateful steps."""
    return stream.withWatermark(moment, f"{hours} hours").where(is_fresh(F.col(moment), F.col(arrival), hours))


def append_stream(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Append everything available to a Parquet store. The checkpoint and the sink's log make a restart exact."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def count_hours(stream: DataFrame, moment: str, source: str, path: str, checkpoint: str) -> StreamingQuery:
    """Streaming telemetry: rows per hour and source of each batch, in a folder of its own that a repeated batch overwrites.

    No state is kept and no late row is lost; read_hours adds the batches up.
    """

    def store(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy(F.date_trunc("hour", moment).alias("hour"), source).agg(F.count("*").alias("records"))
        counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_hours(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(hour, source, records) over all batches so far."""
    return spark.read.parquet(path).groupBy("hour", source).agg(F.sum("records").alias("records"))
