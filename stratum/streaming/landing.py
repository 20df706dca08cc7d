"""Land only the files that arrived since the last run."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from stratum.sources.bronze import stamp
from stratum.sources.readers import csv_options, json_options, text_schema, typed_fields
from stratum.sources.registry import (
    DEFAULT_PARTITION_COLUMN,
    FLAT_FILE_FORMATS,
    SourceSpec,
    expand_environment,
)
from stratum.sources.tables import _file_system, written_rows

#: Hidden from readers of the table.
LEDGER = "_batches"
LEDGER_SCHEMA = "stream string, batch bigint, loaded_at timestamp, rows bigint"


def land_new_files(
    spark: SparkSession,
    spec: SourceSpec,
    bronze_root: str,
    checkpoint: str,
    partition_column: str = DEFAULT_PARTITION_COLUMN,
) -> int:
    """Append new files of a flat-file source to bronze and return; gives the rows of its batches.

    The checkpoint remembers which files are done, and a ledger beside the data which batch went where,
    so a re-run after a lost job neither repeats, doubles nor skips one. Files are parsed as in a batch read; the declared schema must name all CSV columns in
    file order. A source is landed either this way or by ``land``, not both into one folder.
    """
    spec = expand_environment(spec)
    if spec.format not in FLAT_FILE_FORMATS:
        raise ValueError(f"no reader for files of format {spec.format}")
    if not spec.schema:
        raise ValueError(f"source {spec.name} needs a schema to be read as a stream")
    if spec.format == "csv":
        names = T.StructType.fromDDL(spec.schema).names
        reader = spark.readStream.options(**csv_options(spec)).schema(text_schema(names))
        arriving = typed_fields(reader.csv(spec.path), spec.schema)
    else:
        arriving = spark.readStream.options(**json_options(spec)).schema(spec.schema).json(spec.path)
    target = f"{bronze_root.rstrip('/')}/{spec.name}"
    if _exists(spark, f"{target}/_spark_metadata"):
        raise ValueError(f"{target} was landed by a file sink, whose log would hide what lands now")
    counted: dict[int, int] = {}

    def write(batch: DataFrame, number: int) -> None:
        counted[number] = _land_batch(batch, number, spec.name, target, checkpoint, partition_column)

    query = (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(counted.values())


def batch_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch landed at ``path``: its stream, number, load time and rows."""
    if not _exists(spark, f"{path}/{LEDGER}"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True).json(f"{path}/{LEDGER}")


def _land_batch(
    batch: DataFrame, number: int, source: str, target: str, checkpoint: str, partition_column: str
) -> int:
    """Write one batch to a folder of its own.

    The ledger gets the time of a batch before its rows are written, and a batch that is repeated after
    a lost job finds it there: so it has the same folder, replaces what the first try left, and keeps
    its stamp. The row count is added when the rows are there.
    """
    spark = batch.sparkSession
    entry = f"{target}/{LEDGER}/{_stream_id(spark, checkpoint)}/{number:09d}.json"
    record = _load(spark, entry) or {
        "stream": _stream_id(spark, checkpoint),
        "batch": number,
        "loaded_at": datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" "),
    }
    _store(spark, entry, record)
    day = record["loaded_at"][:10]
    folder = f"{target}/{partition_column}={day}/{record['stream']}-{number:09d}"
    rows = Observation()
    stamped = written_rows(stamp(batch, source, record["loaded_at"]), rows)
    stamped.write.mode("overwrite").parquet(folder)
    _store(spark, entry, {**record, "rows": rows.get["rows"]})
    return rows.get["rows"]


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark gives a stream with its checkpoint; it outlives restarts."""
    return _load(spark, f"{checkpoint.rstrip('/')}/metadata")["id"]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _load(spark: SparkSession, path: str) -> dict | None:
    if not _exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _store(spark: SparkSession, path: str, record: dict) -> None:
    fs, target = _file_system(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(json.dumps(record), "utf-8"))
    finally:
        out.close()
