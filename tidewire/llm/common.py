"""What the operators of this subpackage share: tables, stored intermediates, null texts, packed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.llm.keymap import key_map, maybe_in
from tidewire.session import dropping_shuffles, fresh_path

#: Column that holds a whole input row while an operator works, so that no column of the input can clash with its own.
ROW = "packed_input_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """df, written to the shared folder (with the writer's options) and read back: worked out once, and safe from lost executors."""
    path = fresh_path(df.sparkSession, f"llm/{label}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, label: str, **options: str) -> DataFrame:
    """stored, and the shuffle files that it took are gone with it, so that those of steps in a row don't add up on disk."""
    with dropping_shuffles(df.sparkSession):
        return stored(df, label, **options)


def whole_text(text: str) -> Column:
    """The column, with null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """Each row as one struct, beside the named values taken from it."""
    return df.select(F.struct("*").alias(ROW), *(value.alias(name) for name, value in named.items()))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def row_name(key: str, text: str) -> Column:
    """A hash that rows share only if their keys and texts are equal; null keys and texts have their place in it."""
    return F.md5(F.concat_ws(" ", F.coalesce(F.col(key).cast("string"), F.lit("none")), F.md5(whole_text(text))))


def without(df: DataFrame, names: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of df whose name (row_name) is not in the column "name" of a stored table. Only rows that may be in it move."""
    rows = packed(df, name=row_name(key, text))
    marked = rows.withColumn("maybe", maybe_in(key_map(names.select("name")), F.col("name")))
    checked = marked.where("maybe").join(names.select("name"), "name", "left_anti")
    return unpacked(marked.where("not maybe").select(ROW).unionByName(checked.select(ROW)))


def span_digest(spans: Column) -> tuple[Column, Column]:
    """(joined text, lower-case hex SHA-256) of an array of span strings."""
    joined = F.array_join(spans, ",")
    return joined, F.sha2(joined, 256)
