"""Model-hub lists to item rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.functions.once import compute_once

ITEM = "struct<id:string,author:string,downloads:bigint,likes:bigint,tags:array<string>>"
_JSON = {"mode": "PERMISSIVE"}


def with_defaults(item: Column) -> list[Column]:
    """The item's fields; missing counts are 0, a missing tag list is empty."""
    return [
        F.coalesce(item["id"], F.lit("")).alias("id"),
        item["author"].alias("author"),
        F.coalesce(item["downloads"], F.lit(0)).alias("downloads"),
        F.coalesce(item["likes"], F.lit(0)).alias("likes"),
        F.coalesce(item["tags"], F.array().cast("array<string>")).alias("tags"),
    ]


def parse_lists(payloads: DataFrame) -> DataFrame:
    """payloads + doc (the list) and _corrupt, which holds the body of what is no readable list."""
    listed = F.when(F.ltrim("body").startswith("["), F.from_json("body", f"array<{ITEM}>", _JSON))
    parsed = compute_once(payloads, "doc", listed)
    return parsed.withColumn("_corrupt", F.when(F.col("doc").isNull(), F.coalesce("body", F.lit(""))))


def hub_items(payloads: DataFrame) -> DataFrame:
    """Items of JSON list bodies, with the payload's other columns and item_pos."""
    kept = [c for c in payloads.columns if c != "body"]
    items = parse_lists(payloads).where(F.col("_corrupt").isNull()).select(*kept, F.posexplode("doc").alias("item_pos", "it"))
    return items.select(*kept, "item_pos", *with_defaults(F.col("it")))


def read_hub_files(spark: SparkSession, path: str) -> DataFrame:
    """The same items from files that hold one JSON array each."""
    schema = spark.sql(f"SELECT CAST(NULL AS {ITEM}) AS i").schema["i"].dataType
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select(*with_defaults(F.struct(*rows.columns)))
