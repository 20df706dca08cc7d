"""The whole run: sources -> bronze -> silver -> gate -> gold -> gate.

Each layer is written before the next one reads it, so a lost executor costs a retry of tasks and a
lost job a re-run from the last stored layer. Re-running a day replaces that day's results.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.dates import OPEN_END
from stratum.operators.quality import (
    Expectation,
    ValidationResult,
    customer_360_contract,
    quality_gate,
    transactions_contract,
    validate_table,
)
from stratum.operators.scd2 import scd2_change, scd2_merge
from stratum.operators.schema_tests import freshness, sla_report, source_and_mart_tests
from stratum.plans import gold, marts, silver
from stratum.sources.bronze import IngestionResult, ingest
from stratum.sources.catalog import newest_partition, publish_partitions, publish_table, table_location
from stratum.sources.registry import DEFAULT_PARTITION_COLUMN, SourceConfig
from stratum.sources.tables import (
    DEFAULT_FORMAT,
    folder_values,
    last_written_folder,
    load_table_files,
    materialize,
    newest_folder,
    overwrite_table,
    read_table,
    replace_partitions,
    source_table,
    table_exists,
)

logger = logging.getLogger("stratum.lakehouse")

TABLES = {
    "silver": ("fct_transactions", "dim_customer"),
    "gold": ("agg_revenue_by_segment", "dim_customer_ltv", "mart_daily_revenue", "mart_customer_360"),
}
#: The customer history is stored by the day a version was closed; open ones share one far day.
CLOSED_ON = "effective_to"
CUSTOMER_KEY = ("customer_id",)
TRACKED = ("segment", "region", "signup_date", "lifetime_value")


@dataclass(frozen=True)
class Lake:
    """Where the layers live, and the clock of the run."""

    root: str
    as_of: date
    batch_ts: datetime
    reporting_start: date | str = marts.REPORTING_START
    fmt: str = DEFAULT_FORMAT
    #: Catalog schemas of the layers, such as ``"{layer}"`` or ``"dev_{layer}"``. Without, tables are
    #: folders known by path.
    schemas: str | None = None
    landed_by: str = DEFAULT_PARTITION_COLUMN

    @classmethod
    def now(cls, root: str, **settings) -> Lake:
        moment = datetime.now(timezone.utc).replace(tzinfo=None)
        return cls(root, moment.date(), moment, **settings)

    def on(self, as_of: date) -> Lake:
        return replace(self, as_of=as_of)

    def path(self, layer: str, table: str = "") -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}".rstrip("/")


    def schema(self, layer: str) -> str | None:
        return self.schemas and self.schemas.format(layer=layer)

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def has(self, spark: SparkSession, layer: str, table: str) -> bool:
        if self.schemas:
            return spark.catalog.tableExists(self.name(layer, table))
        return table_exists(spark, self.path(layer, table))

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        if self.schemas:
            return source_table(spark, self.schema(layer), table)
        return read_table(spark, self.path(layer, table), self.fmt)

    def write(self, df: DataFrame, layer: str, table: str, partition_col: str | None = None) -> int:
        """Replace a table, in the catalog by one operation; returns its row count."""
        if self.schemas:
            return publish_table(df, self.name(layer, table), self.path(layer, table), partition_col)
        return overwrite_table(df, self.path(layer, table), partition_col, self.fmt)

    def rewrite(self, df: DataFrame, layer: str, table: str, partition_col: str, values: Sequence) -> int:
        """Replace some partitions of a table; returns the rows written."""
        if not values:
            return 0
        if self.schemas:
            return publish_partitions(df, self.name(layer, table), partition_col, values)
        return replace_partitions(df, self.path(layer, table), partition_col, values, self.fmt)

    def folder(self, spark: SparkSession, layer: str, table: str) -> str:
        """Where the partitions of a silver or gold table are now."""
        if self.schemas:
            return table_location(spark, self.name(layer, table))
        return self.path(layer, table)

    def landed(self, spark: SparkSession, source: str) -> DataFrame:
        """All landed days of a source, united by column name: a feed may gain a column some day."""
        if self.schemas:
            return source_table(spark, self.schema("bronze"), source)
        return load_table_files(spark, self.path("bronze", source))

    def last_landed(self, spark: SparkSession, source: str) -> DataFrame:
        """The newest landed day of a source, found from the listing of its days."""
        if self.schemas:
            return newest_partition(spark, self.name("bronze", source))
        return newest_folder(spark, self.path("bronze", source), self.landed_by)


@dataclass
class LakeRun:
    ingested: list[IngestionResult] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    checks: list[ValidationResult] = field(default_factory=list)


def run(
    spark: SparkSession,
    config: SourceConfig,
    lake: Lake,
    full_snapshot: bool = False,
    incremental: bool = False,
) -> LakeRun:
    """All layers; raises QualityGateError before anything of the next layer is written.

    ``incremental`` brings silver up to date from the day landed now instead of rebuilding it.
    """
    outcome = LakeRun()
    lake = replace(lake, landed_by=config.partition_column)
    outcome.ingested = ingest(
        spark, config.sources, lake.path("bronze"), lake.batch_ts, lake.landed_by, lake.schema("bronze")
    )
    days = [lake.batch_ts.date()] if incremental else None
    outcome.rows.update(build_silver(spark, lake, full_snapshot, days))
    outcome.checks += check_layer(spark, lake, "silver", silver_rules())
    outcome.rows.update(build_gold(spark, lake))
    outcome.checks += check_layer(spark, lake, "gold", gold_rules())
    return outcome


def build_silver(
    spark: SparkSession,
    lake: Lake,
    full_snapshot: bool = False,
    days: Sequence[date] | None = None,
) -> dict[str, int]:
    """Bring the fact table and the customer history up to date; gives the rows written.

    ``days`` are the landing days that are new or replaced since the last run: facts are then rewritten
    only where these days change them. Without, the fact table is rebuilt. ``full_snapshot`` says that
    every customer feed is complete, so that one it omits is closed.
    """
    return {
        "fct_transactions": _build_facts(spark, lake, days),
        "dim_customer": _build_customers(spark, lake, full_snapshot, days),
    }


def _build_facts(spark: SparkSession, lake: Lake, days: Sequence[date] | None) -> int:
    bronze = lake.landed(spark, "customer_transactions")
    if days is None or not lake.has(spark, "silver", "fct_transactions"):
        facts = silver.silver_transactions(bronze, lake.batch_ts)
        return lake.write(facts, "silver", "fct_transactions", "transaction_date")
    facts = lake.read(spark, "silver", "fct_transactions")
    change = silver.changed_facts(bronze, facts, days, lake.batch_ts, partition_column=lake.landed_by)
    return lake.rewrite(change.rows, "silver", "fct_transactions", "transaction_date", change.dates)


def _build_customers(
    spark: SparkSession, lake: Lake, full_snapshot: bool, days: Sequence[date] | None
) -> int:
    """The history lies by closing day, so a merge reads and writes open versions only."""
    stored = lake.has(spark, "silver", "dim_customer")
    history = lake.read(spark, "silver", "dim_customer") if stored else None
    if full_snapshot:
        # Only the last feed says who is gone; earlier days still hold every customer ever sent.
        feed = lake.last_landed(spark, "customer_master")
        last = F.broadcast(feed.agg(F.max("_ingested_at").alias("_last")))  # one row
        feed = feed.join(last, F.col("_ingested_at") == F.col("_last")).drop("_last")
    else:
        feed = lake.landed(spark, "customer_master")
        if days and stored and not _came_from(history, days, lake.landed_by):
            # The last record of whoever is in these days is in them or in later ones.
            feed = feed.filter(F.col(lake.landed_by) >= F.lit(str(min(days))).cast("date"))
    snapshot = silver.silver_customers(feed, lake.as_of, lake.batch_ts)
    if not stored:
        return lake.write(snapshot, "silver", "dim_customer", CLOSED_ON)
    if not folder_values(spark, lake.folder(spark, "silver", "dim_customer"), CLOSED_ON):
        # Empty, or stored in one piece by an earlier version of this code.
        merged = scd2_merge(history, snapshot, CUSTOMER_KEY, TRACKED, lake.as_of, full_snapshot)
        return lake.write(merged, "silver", "dim_customer", CLOSED_ON)
    merged, touched = scd2_change(history, snapshot, CUSTOMER_KEY, TRACKED, lake.as_of, full_snapshot)
    return lake.rewrite(merged, "silver", "dim_customer", CLOSED_ON, touched)


def _came_from(history: DataFrame, days: Sequence[date], landed_by: str) -> bool:
    """Whether an open version came from one of the days, which then has been landed before."""
    if landed_by not in history.columns:
        return True
    current = history.filter(F.col(CLOSED_ON) == F.lit(OPEN_END))
    return not current.filter(F.col(landed_by).isin(*[F.lit(str(d)).cast("date") for d in days])).isEmpty()


def build_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """All gold tables. Runs behind the silver gate, which has proved transaction_id unique."""
    facts = lake.read(spark, "silver", "fct_transactions")
    # All gold tables take current customers, which are one partition of the history.
    customers = lake.read(spark, "silver", "dim_customer").filter(F.col(CLOSED_ON) == F.lit(OPEN_END))
    staged_facts = materialize(
        marts.stg_transactions(facts, lake.reporting_start), "stg_transactions", "view"
    )
    staged_customers = materialize(marts.stg_customers(customers), "stg_customers", "view")
    tables: dict[str, DataFrame] = {
        "agg_revenue_by_segment": gold.revenue_by_segment(facts, customers, lake.batch_ts),
        "dim_customer_ltv": gold.customer_ltv(facts, customers, lake.as_of, lake.batch_ts),
        "mart_daily_revenue": marts.daily_revenue(
            staged_facts, staged_customers, unique_transactions=True
        ),
        "mart_customer_360": marts.customer_360(
            staged_facts, staged_customers, lake.as_of, unique_transactions=True
        ),
    }
    return {name: lake.write(df, "gold", name) for name, df in tables.items()}


def freshness_report(spark: SparkSession, config: SourceConfig, lake: Lake) -> DataFrame:
    """Age and status of the silver facts and of every landed source that has an SLA.

    The newest load is looked for where the listing says it is: the day landed last, and the partition
    of the facts written last, as each run stamps all it writes alike.
    """
    lake = replace(lake, landed_by=config.partition_column)
    written = lake.folder(spark, "silver", "fct_transactions")
    facts = last_written_folder(spark, written, "transaction_date")
    now = lake.batch_ts
    report = freshness(facts, "_processed_at", now).withColumn("name", F.lit("fct_transactions"))
    landed = {
        spec.name: lake.last_landed(spark, spec.name)
        for spec in config.sources
        if spec.sla_hours is not None and lake.has(spark, "bronze", spec.name)
    }
    columns = ["name", "max_loaded_at", "age_seconds", "status"]
    if not landed:
        return report.select(columns)
    hours = {spec.name: spec.sla_hours for spec in config.sources if spec.name in landed}
    sources = sla_report(landed, hours, now).withColumnRenamed("source_name", "name")
    return report.select(columns).unionByName(sources.select(columns))


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Temp views over all stored silver and gold tables, for queries in SQL; gives their names."""
    names = []
    for layer, tables in TABLES.items():
        for table in tables:
            if lake.has(spark, layer, table):
                materialize(lake.read(spark, layer, table), table, "view")
                names.append(table)
    return names


def silver_rules() -> dict[str, list[Expectation]]:
    tests = source_and_mart_tests()
    return {
        "fct_transactions": transactions_contract() + tests["fct_transactions"],
        "dim_customer": tests["dim_customer"],
    }


def gold_rules() -> dict[str, list[Expectation]]:
    tests = source_and_mart_tests()
    return {
        "mart_daily_revenue": tests["mart_daily_revenue"],
        "mart_customer_360": customer_360_contract() + tests["mart_customer_360"],
    }


def check_layer(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    rules: Mapping[str, Iterable[Expectation]],
    allow_missing: bool = False,
) -> list[ValidationResult]:
    """Validate the stored tables of a layer and raise if it must not be promoted."""
    results, missing = [], []
    for table, expectations in rules.items():
        if lake.has(spark, layer, table):
            df = lake.read(spark, layer, table)
            results.append(validate_table(table, df, list(expectations)))
        else:
            missing.append(table)
    return quality_gate(results, missing, allow_missing)
