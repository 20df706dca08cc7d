"""Readers: a SourceSpec in, a lazy DataFrame out."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.dates import days_before
from stratum.sources.payloads import flatten, unwrap_payloads
from stratum.sources.registry import FLAT_FILE_FORMATS, SourceSpec, expand_environment

logger = logging.getLogger("stratum.readers")

Reader = Callable[[SparkSession, SourceSpec], DataFrame]

# The texts a CSV field may hold for "missing".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


JDBC_FETCH_ROWS = "10000"


class UnknownSourceType(ValueError):
    """No reader is registered for the type of a source."""


MALFORMED = "_malformed_line"
_CORRUPT = "_corrupt_line"


def csv_options(spec: SourceSpec) -> dict:
    options = {"header": True, "mode": "FAILFAST", "escape": '"', "enforceSchema": False, **spec.options}
    return {key: value for key, value in options.items() if key != "quarantine"}


def json_options(spec: SourceSpec) -> dict:
    """A document per file, or one record per line (and then splittable) with the option ``lines``."""
    options = {key: value for key, value in spec.options.items() if key != "lines"}
    lines = str(spec.options.get("lines", "false")).lower() == "true"
    return {"multiLine": not lines, "mode": "FAILFAST", **options}


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def typed_columns(names: Sequence[str], schema: str | None) -> list[Column]:
    """Text fields with missing-value tokens as null, declared columns converted by name.

    Columns that are not declared stay as text, behind the declared ones; a declared column the data
    lacks is an error.
    """
    declared = T.StructType.fromDDL(schema).fields if schema else []
    absent = [field.name for field in declared if field.name not in names]
    if absent:
        raise ValueError(f"the header lacks the declared columns {', '.join(absent)}")
    known = {field.name for field in declared}
    return [
        *[_cleaned(field.name).try_cast(field.dataType).alias(field.name) for field in declared],
        *[_cleaned(name).alias(name) for name in names if name not in known],
    ]


def typed_fields(raw: DataFrame, schema: str | None) -> DataFrame:
    return raw.select(*typed_columns(raw.columns, schema))


def read_csv(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """CSV with a header, columns matched by name, none left out.

    Fields are read as text, missing-value tokens become null, and declared columns are converted
    with ``try_cast``, so that ids keep leading zeros and one bad number does not lose its row. A line
    with too few fields is filled up with nulls. One with too many stops the read; with the option
    ``quarantine`` its surplus is cut off and a column ``_malformed_line`` keeps the line. Files stay
    splittable; set the option ``multiLine`` for fields that contain line breaks.
    """
    options = {**csv_options(spec), "mode": "PERMISSIVE"}
    names = spark.read.options(**options).csv(spec.path).columns
    schema = T.StructType([*text_schema(names).fields, T.StructField(_CORRUPT, T.StringType())])
    # A parser that skips columns does not see how many fields a line has.
    whole = {**options, "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false"}
    lines = spark.read.options(**whole).schema(schema).csv(spec.path)
    line = F.coalesce(F.col(_CORRUPT), _text(names[0]))  # Spark refuses to read the raw line alone
    surplus = F.when(_fields_in(F.col(_CORRUPT), options) > len(names), line)
    typed = typed_columns(names, spec.schema)
    if str(spec.options.get("quarantine", "false")).lower() == "true":
        return lines.select(*typed, surplus.alias(MALFORMED))
    refused = F.raise_error(F.concat(F.lit("a line has too many fields: "), surplus))
    return lines.filter(F.when(surplus.isNotNull(), refused.cast("boolean")).otherwise(True)).select(*typed)


def _fields_in(line: Column, options: dict) -> Column:
    """Number of fields of a line; separators between quotes are part of a field."""
    quote, separator = options.get("quote", '"'), options.get("sep", options.get("delimiter", ","))
    bare = line
    if quote:
        q = re.escape(quote)
        bare = F.regexp_replace(line, f"(?s){q}(?:[^{q}]|{q}{q})*+{q}", "")
    without = F.replace(bare, F.lit(separator), F.lit(""))
    return (F.length(bare) - F.length(without)) / len(separator) + 1


def read_json(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """A JSON array of records per file, or JSON lines."""
    reader = spark.read.options(**json_options(spec))
    return (reader.schema(spec.schema) if spec.schema else reader).json(spec.path)


def read_flat_file(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.format not in FLAT_FILE_FORMATS:
        raise ValueError(f"no reader for files of format {spec.format}")
    return (read_csv if spec.format == "csv" else read_json)(spark, spec)


def read_api_payloads(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Landed response pages, any number of files, one payload each; nested records flattened."""
    if not spec.path:
        raise ValueError(f"source {spec.name} needs the path of its landed payloads")
    pages = spark.read.text(spec.path, wholetext=True)
    return flatten(unwrap_payloads(pages, "value", spec.schema))


def read_database(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The result of a query, by one task per part.

    ``partitionColumn`` with bounds splits a number, date or timestamp evenly. ``splitColumn`` with
    ``splitAt``, a JSON list of values in order, splits any column at these values, for keys that are
    not even or not numbers. Without either one task reads everything, which is logged.
    """
    options = jdbc_options(spec)
    if "splitColumn" in options:
        column, values = options.pop("splitColumn"), json.loads(options.pop("splitAt"))
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=split_predicates(column, values), properties=options)
    if "partitionColumn" not in options:
        logger.warning("%s: no partitionColumn and no splitColumn, one task reads the whole query", spec.name)
    return spark.read.format("jdbc").options(**options).load()


def split_predicates(column: str, values: Sequence[str | int | float]) -> list[str]:
    """Conditions that part the rows at the ascending values: each row, null included, meets one."""
    if not values:
        return ["1 = 1"]
    cuts = [f"'{v.replace(chr(39), chr(39) * 2)}'" if isinstance(v, str) else str(v) for v in values]
    if len(set(cuts)) < len(cuts) or list(values) != sorted(values):
        raise ValueError(f"the values to split {column} at must ascend")
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def jdbc_options(spec: SourceSpec) -> dict[str, str]:
    """Options of the JDBC reader.

    With ``partitionColumn`` (plus bounds and ``numPartitions``) the query is wrapped as a derived
    table, because Spark splits tables but not queries. Rows are fetched in batches; some drivers
    would otherwise hold a whole result in memory.
    """
    if not spec.connection_string or not spec.query:
        raise ValueError(f"source {spec.name} needs connection_string and query")
    options = {"url": spec.connection_string, "fetchsize": JDBC_FETCH_ROWS, **spec.options}
    if "partitionColumn" in options:
        needed = {"lowerBound", "upperBound", "numPartitions"} - options.keys()
        if needed:
            raise ValueError(f"source {spec.name} lacks {', '.join(sorted(needed))}")
        options["dbtable"] = f"({spec.query}) source_query"
    elif "splitColumn" in options:
        if "splitAt" not in options:
            raise ValueError(f"source {spec.name} lacks splitAt")
        options["dbtable"] = f"({spec.query}) source_query"
    else:
        options["query"] = spec.query
    return options


_READERS: dict[str, Reader] = {
    "flat_file": read_flat_file,
    "rest_api": read_api_payloads,
    "database": read_database,
}


def register_reader(source_type: str, reader: Reader) -> None:
    """Add or replace the reader of a source type."""
    _READERS[source_type] = reader


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.type not in _READERS:
        raise UnknownSourceType(f"no reader for sources of type {spec.type}")
    return _READERS[spec.type](spark, expand_environment(spec))


def incremental_extract(
    df: DataFrame,
    columns: list[str],
    updated_at: str = "updated_at",
    as_of: date | str | None = None,
    days: int = 1,
) -> DataFrame:
    """The given columns of rows updated since ``days`` days before ``as_of``."""
    return df.filter(F.col(updated_at) >= days_before(as_of, days)).select(*columns)


def _text(name: str) -> Column:
    return F.col(f"`{name}`")


def _cleaned(name: str) -> Column:
    return F.when(~_text(name).isin(*NULL_TOKENS), _text(name))
