"""Landing sources in bronze: stamped, partitioned by ingest date, idempotent per day."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import astuple, dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.dates import days_before, resolve_timestamp
from stratum.sources.catalog import expire_partitions, land_partition
from stratum.sources.readers import UnknownSourceType, read_source
from stratum.sources.registry import (
    DEFAULT_PARTITION_COLUMN,
    DEFAULT_RETENTION_DAYS,
    SourceSpec,
)
from stratum.sources.tables import expire_folders, overwrite_table

logger = logging.getLogger("stratum.bronze")

RESULT_SCHEMA = (
    "source_name string, row_count bigint, landed_path string, ingested_at timestamp, status string"
)


@dataclass(frozen=True)
class IngestionResult:
    source_name: str
    row_count: int
    landed_path: str
    ingested_at: datetime
    status: str


def stamp(df: DataFrame, source_name: str, batch_ts: datetime | str) -> DataFrame:
    """Add load time (one per batch) and source name."""
    return df.withColumns(
        {"_ingested_at": resolve_timestamp(batch_ts), "_source_system": F.lit(source_name)}
    )


def land(
    df: DataFrame,
    bronze_root: str,
    source_name: str,
    batch_ts: datetime,
    partition_column: str = DEFAULT_PARTITION_COLUMN,
    schema: str | None = None,
) -> IngestionResult:
    """Write one day's partition; landing the same day again replaces that day only.

    With a catalog ``schema`` the source is its table of that name and the day becomes current by one
    catalog operation; else the day's folder is replaced.
    """
    day = f"{batch_ts:%Y-%m-%d}"
    root = f"{bronze_root.rstrip('/')}/{source_name}"
    path = f"{root}/{partition_column}={day}"
    stamped = stamp(df, source_name, batch_ts.isoformat(sep=" "))
    if schema:
        rows = land_partition(stamped, f"{schema}.{source_name}", root, partition_column, day)
    else:
        rows = overwrite_table(stamped, path)
    logger.info("%s: landed %d rows in %s", source_name, rows, path)
    return IngestionResult(source_name, rows, path, batch_ts, "success")


def ingest(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    bronze_root: str,
    batch_ts: datetime | None = None,
    partition_column: str = DEFAULT_PARTITION_COLUMN,
    schema: str | None = None,
) -> list[IngestionResult]:
    """Land every source. One that fails is reported and does not stop the others; one of unknown
    type is skipped without a result."""
    batch_ts = batch_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    results = []
    for spec in specs:
        try:
            df = read_source(spark, spec)
            results.append(land(df, bronze_root, spec.name, batch_ts, partition_column, schema))
        except UnknownSourceType as error:
            logger.warning("%s: skipped, %s", spec.name, error)
        except Exception as error:
            logger.error("%s: ingestion failed: %s", spec.name, error)
            results.append(IngestionResult(spec.name, 0, "", batch_ts, "failed"))
    succeeded = sum(result.status == "success" for result in results)
    logger.info("ingestion complete: %d/%d sources succeeded", succeeded, len(results))
    return results


def results_frame(spark: SparkSession, results: Iterable[IngestionResult]) -> DataFrame:
    return spark.createDataFrame([astuple(result) for result in results], RESULT_SCHEMA)


def expire(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    bronze_root: str,
    as_of: date,
    days: int = DEFAULT_RETENTION_DAYS,
    partition_column: str = DEFAULT_PARTITION_COLUMN,
    schema: str | None = None,
) -> dict[str, list[str]]:
    """Drop the landed days of every source that are past retention; gives the days by source.

    Days are known from the catalog, or from the names of the folders; no row is read.
    """
    before = f"{as_of - timedelta(days=days):%Y-%m-%d}"
    gone = {}
    for spec in specs:
        if schema is None:
            path = f"{bronze_root.rstrip('/')}/{spec.name}"
            gone[spec.name] = expire_folders(spark, path, partition_column, before)
        elif spark.catalog.tableExists(f"{schema}.{spec.name}"):
            gone[spec.name] = expire_partitions(spark, f"{schema}.{spec.name}", before)
    for name, dropped in gone.items():
        logger.info("%s: %d days past retention dropped", name, len(dropped))
    return gone


def expired_partitions(
    df: DataFrame,
    as_of: date | str | None = None,
    days: int = 90,
    partition_column: str = DEFAULT_PARTITION_COLUMN,
) -> DataFrame:
    """Rows past retention; a filter on the partition column alone, so only those folders are read."""
    return df.filter(F.col(partition_column) < days_before(as_of, days))


def retained_partitions(
    df: DataFrame,
    as_of: date | str | None = None,
    days: int = 90,
    partition_column: str = DEFAULT_PARTITION_COLUMN,
) -> DataFrame:
    return df.filter(F.col(partition_column) >= days_before(as_of, days))
