"""Record types, their column contracts and the record envelope.

Inside, records are nested (source, content) and missing values are NULL. Flat dotted columns and the "" and 0
that stand for missing values exist only in the export projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewire import fixed_values as fixed
from tidewire.functions.dates import fmt_iso, now_literal

_S, _L, _I, _B, _D = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_HEAD = (("schemaVersion", _S), ("recordType", _S))
_SOURCE = (("source.name", _S), ("source.url", _S))

# Ordered export columns of each record type.
CONTRACTS: dict[str, T.StructType] = {
    "RESEARCH_PAPER": _schema(
        *_HEAD, ("content.title", _S), ("content.authors", _S), ("content.paper_url", _S), ("content.github_url", _S),
        ("content.github_stars", _L), ("content.published_date", _S),
    ),
    "NEWS": _schema(*_HEAD, *_SOURCE, ("content.title", _S), ("content.published_date", _S), ("collectedAt", _S)),
    "JOB": _schema(
        *_HEAD, ("content.company", _S), ("content.date", _S), ("content.is_remote", _B), ("content.role_family", _S)
    ),
    "STARTUP": _schema(
        *_HEAD, *_SOURCE, ("content.entityName", _S), ("content.data.employeeCount", _I), ("collectedAt", _S)
    ),
    "PRODUCT": _schema(
        *_HEAD, *_SOURCE, ("content.startupName", _S), ("content.pricingModel", _S), ("collectedAt", _S)
    ),
    "ENTITY_MAPPING": _schema(("raw_name", _S), ("canonical_name", _S), ("match_type", _S), ("score", _D)),
}


class ContractError(ValueError):
    """Columns differ from the record type's contract."""


def head(record_type: str) -> list[Column]:
    return [F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"), F.lit(record_type).alias("recordType")]


def source(name: Column, url: Column) -> Column:
    return F.struct(name.alias("name"), url.alias("url")).alias("source")


def content(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()]).alias("content")


def collected_at(now) -> Column:
    return fmt_iso(now_literal(now)).alias("collectedAt")


def flatten_record(df: DataFrame) -> DataFrame:
    """Every nested field as one column named by its dotted path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here))

    return df.select(*leaves(df.schema, ()))


def to_contract(df: DataFrame, record_type: str) -> DataFrame:
    """Flat columns in contract order and type; columns missing or left over are an error."""
    flat = flatten_record(df)
    wanted = CONTRACTS[record_type]
    missing = [n for n in wanted.names if n not in flat.columns]
    extra = [n for n in flat.columns if n not in wanted.names]
    if missing or extra:
        raise ContractError(f"{record_type}: missing {missing}, not in contract {extra}")
    return flat.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])


def to_export(df: DataFrame, record_type: str) -> DataFrame:
    """The contract as text, missing values written as "" and flags as True or False."""

    def text(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        shown = F.initcap(column.cast("string")) if isinstance(field.dataType, T.BooleanType) else column.cast("string")
        return F.coalesce(shown, F.lit("")).alias(field.name)

    return to_contract(df, record_type).select(*[text(f) for f in CONTRACTS[record_type].fields])
