"""API payloads and nested JSON."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unwrap_payloads(payloads: DataFrame, column: str, schema: str | None = None) -> DataFrame:
    """One row per record of the JSON payloads in ``column``, as the fields of ``schema``.

    A list holds records, an object holds them under ``results`` (a list, or one record as an
    object), and an object without ``results`` is one record. Without a schema one distributed pass infers it. Malformed JSON stops the job.
    """
    body = F.col("_payload")
    inner = F.try_variant_get(body, "$.results", "variant")
    is_one = F.schema_of_variant(inner).startswith("OBJECT")
    results = F.when(is_one, F.array(inner)).otherwise(
        F.variant_get(body, "$.results", "array<variant>")
    )
    records = payloads.select(
        F.parse_json(F.col(column)).alias("_payload"),
        F.col(column).rlike(r"^\s*\[").alias("_is_list"),
    ).select(
        F.explode(
            F.when(F.col("_is_list"), body.cast("array<variant>")).otherwise(
                F.coalesce(results, F.array(body))
            )
        ).alias("_record")
    )
    if schema is None:
        schema = _inferred_schema(records, "_record")
    struct = schema if schema.lower().startswith("struct<") else f"struct<{schema}>"
    return records.select(F.variant_get("_record", "$", struct).alias("_record")).select("_record.*")


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as top-level columns with joined names; arrays stay arrays."""
    columns = []
    for field in df.schema:
        columns += _leaves(F.col(f"`{field.name}`"), field.name, field.dataType, separator)
    return df.select(columns)


def parse_and_flatten(df: DataFrame, column: str, schema: str, separator: str = ".") -> DataFrame:
    """Parse a JSON string column and flatten it next to the other columns."""
    return flatten(df.withColumn(column, F.from_json(F.col(column), schema)), separator)


def _leaves(column, name: str, data_type: T.DataType, separator: str) -> list:
    if not isinstance(data_type, T.StructType):
        return [column.alias(name)]
    leaves = []
    for field in data_type:
        child = column.getField(field.name)
        leaves += _leaves(child, f"{name}{separator}{field.name}", field.dataType, separator)
    return leaves


def _inferred_schema(records: DataFrame, column: str) -> str:
    """The merged record type as DDL. Mixed numbers are doubles, untyped or mixed values strings."""
    merged = records.agg(F.schema_of_variant_agg(F.col(column))).first()[0]
    if not merged.startswith("OBJECT<"):
        raise ValueError(f"payload records are not JSON objects: {merged}")
    return _spark_type(merged)


_NAME_OR_TYPE = re.compile(r"`(?:[^`]|``)*`|[^,:<>\s]+(?=\s*:)|[A-Z_]+(?:\(\d+,\s*\d+\))?")


def _spark_type(merged: str) -> str:
    """The merged variant type with Spark's type names; field names, quoted or not, stay."""

    def mapped(match: re.Match) -> str:
        word = match[0]
        if word.startswith("`"):
            return word
        if re.match(r"\s*:", merged[match.end() :]):
            return f"`{word}`"
        if word.startswith("DECIMAL("):
            return "DOUBLE"
        return {"VOID": "STRING", "VARIANT": "STRING", "OBJECT": "STRUCT"}.get(word, word)

    return _NAME_OR_TYPE.sub(mapped, merged)
