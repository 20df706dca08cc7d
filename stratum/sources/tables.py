"""Reading, writing and swapping stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_FORMAT = "parquet"


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def source_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A catalog table referenced as schema.table."""
    return spark.table(f"`{schema}`.`{table}`")


def load_table_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """All part files of a Parquet directory, united by column name; an error if there are none.

    ``recursive`` also takes folders that are not ``key=value`` partitions.
    """
    if not table_exists(spark, path):
        raise FileNotFoundError(f"no data files under {path}")
    return (
        spark.read.option("mergeSchema", True)
        .option("recursiveFileLookup", recursive)
        .parquet(path)
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the directory holds any data file (names starting with _ or . do not count)."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target) and not _finish_interrupted_swap(spark, path):
        return False
    files = fs.listFiles(target, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_col: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> int:
    """Replace the table at ``path`` by ``df``, which may read that very table; returns its row count.

    Rows are counted by an observation in the writing stage itself, behind the last shuffle, where a
    map task that is run again after a lost executor cannot be counted twice. Files go to a hidden
    sibling first and are swapped in once complete, so a failed job leaves the old table. Partitioned
    output is rebalanced by its partition column: few files per partition, and a hot partition split
    over several tasks.
    """
    spark = df.sparkSession
    counted = Observation()
    rows = written_rows(df, counted, partition_col)
    writer = rows.write.format(fmt).mode("overwrite")
    if partition_col:
        writer = writer.partitionBy(partition_col)
    if fmt == DEFAULT_FORMAT:
        staged = _sibling(path, "staged")
        try:
            writer.save(staged)
        except Exception:
            fs, leftovers = _file_system(spark, staged)
            fs.delete(leftovers, True)
            raise
        _swap(spark, staged, path)
    else:
        writer.option("overwriteSchema", "true").save(path)
    return counted.get["rows"]


def written_rows(df: DataFrame, counted: Observation, partition_col: str | None = None) -> DataFrame:
    """``df`` as it is written: rebalanced by its partition column, its rows counted behind that."""
    if partition_col:
        df = df.hint("rebalance", F.col(partition_col))
    return df.observe(counted, F.count(F.lit(1)).alias("rows"))


def replace_partitions(
    df: DataFrame, path: str, partition_col: str, values: Iterable[object], fmt: str = DEFAULT_FORMAT
) -> int:
    """Make ``df`` the content of the partitions with these ``values``; the others are not touched.

    ``df`` holds no other values and may read the table itself: Spark stages new files and replaces
    the partitions they are for when the job is done. A partition ``df`` has no rows for is deleted.
    Returns the number of rows written.
    """
    spark = df.sparkSession
    folders = [f"{path.rstrip('/')}/{partition_folder(partition_col, value)}" for value in values]
    before = {folder: _data_files(spark, folder) for folder in folders}
    counted = Observation()
    writer = written_rows(df, counted, partition_col).write.format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).save(path)
    for folder, files in before.items():
        if files and _data_files(spark, folder) == files:  # nothing came in their place
            fs, target = _file_system(spark, folder)
            fs.delete(target, True)
    return counted.get["rows"]


def partition_folder(partition_col: str, value: object) -> str:
    """Name of the folder of a date, number or null."""
    return f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def folder_values(spark: SparkSession, path: str, partition_col: str) -> dict[str, int]:
    """Values of a partition column with the modification times of their folders; reads no file."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return {}
    prefix = f"{partition_col}="
    return {
        unquote(status.getPath().getName().removeprefix(prefix)): status.getModificationTime()
        for status in fs.listStatus(target)
        if status.isDirectory() and status.getPath().getName().startswith(prefix)
    }


def newest_folder(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """The rows of the newest partition by value; only its folder is listed and read."""
    values = [v for v in folder_values(spark, path, partition_col) if not v.startswith("__")]
    while values:
        folder = f"{path.rstrip('/')}/{partition_col}={max(values)}"
        if _data_files(spark, folder):
            return spark.read.option("basePath", path).parquet(folder)
        values.remove(max(values))
    return read_table(spark, path)


def last_written_folder(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """The rows of the partition written last, by the times of the folders.

    All rows where the store keeps no times of folders. A job that writes several partitions may
    leave any of them as the last.
    """
    times = folder_values(spark, path, partition_col)
    if not times or not max(times.values()):
        return read_table(spark, path)
    last = max(times, key=times.get)
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{partition_col}={last}")


def expire_folders(spark: SparkSession, path: str, partition_col: str, before: str) -> list[str]:
    """Delete the partition folders with values before ``before``; gives the values, reads no row."""
    expired = sorted(v for v in folder_values(spark, path, partition_col) if not v.startswith("__") and v < before)
    for value in expired:
        fs, folder = _file_system(spark, f"{path.rstrip('/')}/{partition_col}={value}")
        fs.delete(folder, True)
    return expired


def _data_files(spark: SparkSession, folder: str) -> set[str]:
    fs, target = _file_system(spark, folder)
    if not fs.exists(target):
        return set()
    names = {status.getPath().getName() for status in fs.listStatus(target)}
    return {name for name in names if not name.startswith(("_", "."))}


def materialize(
    df: DataFrame, name: str, how: str, path: str | None = None, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """A model as a temp view, an ephemeral (lazy) frame, or a written table read back."""
    if how == "ephemeral":
        return df
    if how == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if how == "table":
        if path is None:
            raise ValueError(f"table {name} needs a path")
        overwrite_table(df, path, fmt=fmt)
        return read_table(df.sparkSession, path, fmt)
    raise ValueError(f"Unknown materialization: {how}")


def export_table(df: DataFrame, fmt: str, options: Mapping[str, str], table: str) -> None:
    """Push a table to an external system through its Spark connector."""
    df.write.format(fmt).options(**options).option("dbtable", table).mode("overwrite").save()


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _sibling(path: str, purpose: str) -> str:
    return f"{_sibling_prefix(path, purpose)}{uuid.uuid4().hex}"


def _sibling_prefix(path: str, purpose: str) -> str:
    """Hidden from readers: starts with an underscore and holds no ``=``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    prefix = f"{parent}/" if parent else ("/" if path.startswith("/") else "")
    return f"{prefix}_{purpose}_{name.replace('=', '_')}_"


def _retired(spark: SparkSession, path: str) -> list:
    """Old versions of this table a lost driver left behind, the newest last."""
    fs, _ = _file_system(spark, path)
    # The suffix is matched by its exact length: another table's name may start with this one's.
    pattern = _file_system(spark, _sibling_prefix(path, "retired") + "?" * len(uuid.uuid4().hex))[1]
    found = sorted(fs.globStatus(pattern) or [], key=lambda status: status.getModificationTime())
    return [status.getPath() for status in found]


def _finish_interrupted_swap(spark: SparkSession, path: str) -> bool:
    """Put the old table back if a driver was lost after moving it away; whether there was one."""
    fs, target = _file_system(spark, path)
    retired = _retired(spark, path)
    return bool(retired) and fs.rename(retired[-1], target)


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    fs, target = _file_system(spark, path)
    source = _file_system(spark, staged)[1]
    old = _file_system(spark, _sibling(path, "retired"))[1]
    replaced = fs.exists(target) or _finish_interrupted_swap(spark, path)
    if replaced and not fs.rename(target, old):
        raise OSError(f"could not move the old table away from {path}")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"could not move the new table to {path}")
    for version in _retired(spark, path):
        fs.delete(version, True)
