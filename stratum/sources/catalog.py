"""Tables named in the catalog: a new version, or a new day, becomes current by one catalog operation.

Files are written to a fresh folder and never renamed, so an object store copies nothing and a failed
job leaves what was there. A whole table is one location, ``ALTER TABLE … SET LOCATION`` moves it on,
and a reader gets the old version or the new one as a whole. A landed table has one location per day,
and a day is moved on by itself. Versions that are no longer current stay for running readers until
``remove_old_versions``.

The catalog keeps the merged schema, widened when a version or a day brings a new column, so planning
a read opens no file footer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.sources.tables import _file_system, replace_partitions, written_rows

GRACE_HOURS = 24.0
_VERSION = "version-"
_MANAGED = "spark.sql.hive.manageFilesourcePartitions"


def publish_table(df: DataFrame, name: str, root: str, partition_col: str | None = None) -> int:
    """Make ``df`` the content of the catalog table ``name`` (schema.table); returns its row count.

    ``df`` may read the table itself. A column ``df`` lacks stays, as null; a column of another type
    must fit the known one.
    """
    spark = df.sparkSession
    df = _fitted(df, name)
    folder = _fresh_folder(root)
    counted = Observation()
    writer = written_rows(df, counted, partition_col).write
    _write(writer.partitionBy(partition_col) if partition_col else writer, spark, folder)
    if spark.catalog.tableExists(name):
        _widen(spark, name, df.schema)
        spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION '{_literal(folder)}'")
    else:
        # Partitions follow the location; listed in the catalog, each would have its own.
        with _setting(spark, _MANAGED, "false"):
            _create(spark, name, df.schema, [partition_col] if partition_col else [], folder)
    return counted.get["rows"]


def land_partition(df: DataFrame, name: str, root: str, partition_col: str, value: str) -> int:
    """Make ``df`` the content of one partition of ``name``; the others stay. Returns its row count."""
    spark = df.sparkSession
    df = _fitted(df, name)
    folder = _fresh_folder(f"{root.rstrip('/')}/{partition_col}={value}")
    counted = Observation()
    _write(written_rows(df, counted).write, spark, folder)
    if spark.catalog.tableExists(name):
        _widen(spark, name, df.schema)
    else:
        schema = T.StructType([*df.schema.fields, T.StructField(partition_col, T.DateType())])
        with _setting(spark, _MANAGED, "true"):
            _create(spark, name, schema, [partition_col], root)
    where = f"PARTITION ({_name(partition_col)} = '{_literal(value)}')"
    location = f"'{_literal(folder)}'"
    known = value in partition_values(spark, name)
    change = f"{where} SET LOCATION {location}" if known else f"ADD {where} LOCATION {location}"
    spark.sql(f"ALTER TABLE {_quoted(name)} {change}")
    return counted.get["rows"]


def publish_partitions(df: DataFrame, name: str, partition_col: str, values: Iterable[object]) -> int:
    """Make ``df`` the content of some partitions of a published table, inside its current version.

    Each partition is replaced as a whole, one after the other; see ``replace_partitions``. A reader in
    between can meet new and old partitions, and one that reads a replaced file fails and must retry.
    """
    spark = df.sparkSession
    df = _fitted(df, name)
    _widen(spark, name, df.schema)
    rows = replace_partitions(df, table_location(spark, name), partition_col, values)
    spark.catalog.refreshTable(name)
    return rows


def partition_values(spark: SparkSession, name: str) -> list[str]:
    """Values of the partition column of a landed table, in order; the catalog knows them."""
    listed = spark.sql(f"SHOW PARTITIONS {_quoted(name)}").collect()
    return sorted(unquote(row[0].partition("=")[2]) for row in listed)


def newest_partition(spark: SparkSession, name: str) -> DataFrame:
    """The rows of the newest partition of a landed table; the plan reads that partition alone."""
    table, values = spark.table(_quoted(name)), partition_values(spark, name)
    column = _partition_column(spark, name)
    return table.filter(F.col(_name(column)) == F.lit(values[-1]).cast("date")) if values else table.limit(0)


def expire_partitions(spark: SparkSession, name: str, before: str) -> list[str]:
    """Drop the partitions with values before ``before`` and delete their folders; gives the values.

    One catalog operation takes all of them away, then files go. No row is read.
    """
    expired = [value for value in partition_values(spark, name) if value < before]
    if expired:
        column = _partition_column(spark, name)
        specs = ", ".join(f"PARTITION ({_name(column)} = '{_literal(v)}')" for v in expired)
        root = table_location(spark, name)
        spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS {specs}")
        for value in expired:
            fs, folder = _file_system(spark, f"{root}/{column}={value}")
            fs.delete(folder, True)
    return expired


def table_location(spark: SparkSession, name: str, partition: str = "") -> str:
    """Where the table, or one of its partitions, is now."""
    rows = spark.sql(f"DESCRIBE EXTENDED {_quoted(name)} {partition}").collect()
    return next(row["data_type"] for row in rows if row["col_name"] == "Location").rstrip("/")


def remove_old_versions(spark: SparkSession, name: str, root: str, grace_hours: float = GRACE_HOURS) -> int:
    """Delete the version folders of ``name`` that are not current and were written over
    ``grace_hours`` ago, those a lost job left included; gives their number.
    """
    fs, path = _file_system(spark, root)
    limit = (datetime.now(timezone.utc) - timedelta(hours=grace_hours)).timestamp() * 1000
    folders = {"": path}
    for status in fs.listStatus(path):
        if status.isDirectory() and "=" in status.getPath().getName():
            folders[status.getPath().getName()] = status.getPath()
    landed = dict.fromkeys(partition_values(spark, name)) if len(folders) > 1 else {}
    removed = 0
    for partition, folder in folders.items():
        versions = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith(_VERSION)]
        old = [v for v in versions if fs.getFileStatus(v).getModificationTime() <= limit]
        if not old:
            continue
        column, _, value = partition.partition("=")
        if partition and value not in landed:
            current = ""
        else:
            spec = f"PARTITION ({_name(column)} = '{_literal(value)}')" if partition else ""
            current = table_location(spark, name, spec).rpartition("/")[2]
        for version in old:
            if version.getName() != current:
                removed += int(fs.delete(version, True))
    return removed


# ------------------------------------------------------------------------------------------------

# What a known column type also takes, without loss.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp"},
    "void": None,
}


def _fitted(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the types the catalog knows."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        void = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
        return df.withColumns({c: F.lit(None).cast("string") for c in void})
    known = {f.name.lower(): f.dataType for f in spark.table(_quoted(name)).schema}
    casts = {}
    for f in df.schema:
        target = known.get(f.name.lower(), f.dataType)
        if isinstance(target, T.NullType):
            target = T.StringType()
        own, wanted = f.dataType.simpleString(), target.simpleString()
        if own != wanted:
            if own != "void" and wanted not in _WIDER.get(own, ()):
                raise ValueError(f"{name}: column {f.name} is {wanted}, the new rows have {own}")
            casts[f.name] = F.col(_name(f.name)).cast(target)
    return df.withColumns(casts) if casts else df


def _widen(spark: SparkSession, name: str, schema: T.StructType) -> None:
    known = {c.lower() for c in spark.table(_quoted(name)).columns}
    new = [f for f in schema if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD COLUMNS ({_columns(new)})")


def _create(spark: SparkSession, name: str, schema: T.StructType, partitioned: list[str], folder: str) -> None:
    # Partition columns come last, as a read by path has them.
    fields = [f for f in schema if f.name not in partitioned] + [f for f in schema if f.name in partitioned]
    by = f"PARTITIONED BY ({', '.join(map(_name, partitioned))})" if partitioned else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(name.partition('.')[0])}")
    spark.sql(
        f"CREATE TABLE {_quoted(name)} ({_columns(fields)}) USING parquet {by} LOCATION '{_literal(folder)}'"
    )


def _columns(fields: Iterable[T.StructField]) -> str:
    # Nullable, whatever the frame says: older files lack a newer column.
    return ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in fields)


def _write(writer, spark: SparkSession, folder: str) -> None:
    try:
        writer.parquet(folder)
    except Exception:
        fs, leftovers = _file_system(spark, folder)
        fs.delete(leftovers, True)
        raise


def _fresh_folder(root: str) -> str:
    moment = datetime.now(timezone.utc)
    return f"{root.rstrip('/')}/{_VERSION}{moment:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def _partition_column(spark: SparkSession, name: str) -> str:
    return next(c.name for c in spark.catalog.listColumns(name) if c.isPartition)


def _quoted(name: str) -> str:
    return ".".join(_name(part) for part in name.split("."))


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
