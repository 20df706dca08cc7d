"""One query per operator, over the whole given tables.

Output columns are string, bigint, double, date or boolean and never hold a wall-clock value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import (
    VALUE_TIERS,
    cents,
    cents_as_double,
    cents_to_dollars,
    engagement_status,
    safe_divide,
    sum_cents,
    surrogate_key,
    value_tier,
)
from stratum.operators import quality as dq
from stratum.operators import schema_tests as st
from stratum.operators.dedupe import latest_per_key
from stratum.operators.enrich import as_of_join, point_in_time_join
from stratum.operators.scd2 import scd2_change, scd2_frame, scd2_merge
from stratum.operators.unions import union_by_name
from stratum.plans import gold, marts, silver
from stratum.session import scratch_path
from stratum.sources.bronze import expired_partitions, ingest, land, results_frame, stamp
from stratum.sources.catalog import land_partition, publish_table
from stratum.sources.payloads import flatten, parse_and_flatten, unwrap_payloads
from stratum.sources.readers import incremental_extract, read_source
from stratum.sources.registry import SourceSpec, load_sources
from stratum.sources.tables import (
    expire_folders,
    export_table,
    load_table_files,
    materialize,
    newest_folder,
    overwrite_table,
    read_table,
    replace_partitions,
    source_table,
)
from stratum.workloads.fixtures import (
    AS_OF,
    REPORTING_START,
    SNAPSHOT_DAYS,
    bronze_customers,
    bronze_transactions,
    clean_transactions,
    customer_master,
    customer_snapshot,
    product_payloads,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

DAY_1, DAY_2 = datetime(2001, 8, 1, 6), datetime(2001, 8, 2, 6)
EVENTS_CHECKED_AT = "2024-01-31 18:00:00"
SLA_CHECKED_AT = "2024-01-31 02:00:00"
PART_COLUMNS = "part_code string, label string, p_type string, p_size bigint, p_retailprice double"
EVENT_COLUMNS = "event_id bigint, user_id bigint, event_type string, value double, props string"
CUSTOMER_COLUMNS = ("segment", "region", "signup_date", "lifetime_value")

_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _silver(spark, sf_dir):
    """Deduplicated order lines: integer amounts, all tiers."""
    return silver.silver_transactions(bronze_transactions(spark, sf_dir), tie_breakers=["tie_break"])


def _clean_silver(spark, sf_dir):
    """Deduplicated orders: amounts with cents."""
    return silver.silver_transactions(clean_transactions(spark, sf_dir), tie_breakers=["amount"])


def _undeduped(spark, sf_dir):
    """Valid order lines with their repeated ids."""
    typed = silver.cast_transactions(bronze_transactions(spark, sf_dir))
    valid = silver.enrich_transactions(silver.keep_valid_transactions(typed))
    return valid.withColumn("_processed_at", F.lit(None).cast("timestamp"))


def _raw_contract_table(spark, sf_dir):
    """Order lines neither filtered nor deduplicated, in the shape the contract checks."""
    return silver.enrich_transactions(silver.cast_transactions(bronze_transactions(spark, sf_dir)))


def _customers(spark, sf_dir):
    return silver.silver_customers(bronze_customers(spark, sf_dir), as_of=AS_OF, tie_breakers=[])


def _history(spark, sf_dir, full_snapshot=True):
    first = scd2_frame(customer_snapshot(spark, sf_dir, 1), SNAPSHOT_DAYS[1])
    return scd2_merge(
        first,
        customer_snapshot(spark, sf_dir, 2),
        ["customer_id"],
        CUSTOMER_COLUMNS,
        SNAPSHOT_DAYS[2],
        full_snapshot,
    )


def _staged(spark, sf_dir, fct=_silver, start=REPORTING_START):
    return (
        marts.stg_transactions(fct(spark, sf_dir), start),
        marts.stg_customers(_customers(spark, sf_dir)),
    )


def _as(kind: str, *names: str) -> list:
    return [F.col(f"`{name}`").cast(kind).alias(name) for name in names]


# Silver -----------------------------------------------------------------------------------------


@query("silver_cast")
def silver_cast(spark, sf_dir):
    bronze = bronze_transactions(spark, sf_dir).withColumn(
        "transaction_ts",
        F.when(F.col("tie_break") % 9 == 0, F.lit("unknown")).otherwise(F.col("transaction_ts")),
    )
    return silver.cast_transactions(bronze).select(
        "transaction_id", "customer_id", "amount", *_as("string", "transaction_ts"), "tie_break"
    )


@query("silver_filter")
def silver_filter(spark, sf_dir):
    typed = silver.cast_transactions(bronze_transactions(spark, sf_dir))
    return silver.keep_valid_transactions(typed).select(
        "transaction_id", "customer_id", "amount", "tie_break"
    )


@query("dedupe_latest")
def dedupe_latest(spark, sf_dir):
    latest = latest_per_key(
        bronze_transactions(spark, sf_dir), ["transaction_id"], ["_ingested_at"], ["tie_break"]
    )
    return latest.select(
        "transaction_id", "customer_id", "amount", *_as("date", "_ingested_at"), "tie_break"
    )


@query("silver_enrich")
def silver_enrich(spark, sf_dir):
    enriched = silver.enrich_transactions(table(spark, sf_dir, "events"), "value", "ts")
    return enriched.select(
        "event_id", "amount_usd", "transaction_date", *_as("bigint", "transaction_hour")
    )


@query("silver_transactions")
def silver_transactions(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "transaction_id",
        "customer_id",
        "amount",
        *_as("string", "transaction_ts"),
        "amount_usd",
        "transaction_date",
        *_as("bigint", "transaction_hour"),
    )


@query("silver_audit")
def silver_audit(spark, sf_dir):
    """The audit time is the clock of the run, one for all rows."""
    stamped = silver.silver_transactions(clean_transactions(spark, sf_dir), DAY_1, ["amount"])
    return stamped.select("transaction_id", *_as("string", "_processed_at"))


@query("silver_incremental")
def silver_incremental(spark, sf_dir):
    """Facts of the rows landed until 1996, brought up to date with the years landed after, of which
    1996 is landed again."""
    raw = bronze_transactions(spark, sf_dir).withColumn("ingest_date", F.trunc("_ingested_at", "year"))
    path = f"{scratch_path(spark, 'facts')}/fct_transactions"
    landed = f"{scratch_path(spark, 'bronze')}/transactions"
    raw.write.partitionBy("ingest_date").parquet(landed)
    bronze = spark.read.schema(raw.schema).parquet(landed)
    again = date(1996, 1, 1)
    before = bronze.filter(F.col("ingest_date") <= F.lit(again)).withColumn(
        "amount", F.when(F.col("ingest_date") == F.lit(again), F.lit("1")).otherwise(F.col("amount"))
    )
    month = F.trunc("transaction_date", "month")
    first = silver.silver_transactions(before, DAY_1, ["tie_break"])
    overwrite_table(first.withColumn("transaction_month", month), path, "transaction_month")
    days = [date(year, 1, 1) for year in range(1996, 2002)]
    facts = read_table(spark, path)
    change = silver.changed_facts(
        bronze, facts.drop("transaction_month"), days, DAY_2, ["tie_break"], partition_column="ingest_date",
        stored_by=month,
    )
    rows = change.rows.withColumn("transaction_month", month)
    replace_partitions(rows, path, "transaction_month", change.dates)
    return read_table(spark, path).select(
        "transaction_id", "customer_id", "amount", *_as("string", "transaction_ts"), "transaction_date"
    )


@query("silver_customer")
def silver_customer(spark, sf_dir):
    return _customers(spark, sf_dir).select(
        "customer_id", *CUSTOMER_COLUMNS, "effective_from", "effective_to", "is_current"
    )


# Slowly changing dimension ----------------------------------------------------------------------


@query("scd2_frame")
def scd2_framing(spark, sf_dir):
    return scd2_frame(customer_master(spark, sf_dir), AS_OF)


@query("scd2_merge")
def scd2_merge_full(spark, sf_dir):
    return _history(spark, sf_dir, full_snapshot=True)


@query("scd2_merge_incremental")
def scd2_merge_incremental(spark, sf_dir):
    return _history(spark, sf_dir, full_snapshot=False)


@query("scd2_stored_merge")
def scd2_stored_merge(spark, sf_dir):
    """History stored by closing day: the second snapshot rewrites open versions and adds closed ones,
    and does so twice without effect."""
    path = f"{scratch_path(spark, 'history')}/dim_customer"
    overwrite_table(scd2_frame(customer_snapshot(spark, sf_dir, 1), SNAPSHOT_DAYS[1]), path, "effective_to")
    for _ in range(2):
        merged, days = scd2_change(
            read_table(spark, path), customer_snapshot(spark, sf_dir, 2), ["customer_id"],
            CUSTOMER_COLUMNS, SNAPSHOT_DAYS[2], full_snapshot=True,
        )
        replace_partitions(merged, path, "effective_to", days)
    return read_table(spark, path).select(
        "customer_id", *CUSTOMER_COLUMNS, "effective_from", "effective_to", "is_current"
    )


@query("as_of_join")
def as_of_lookup(spark, sf_dir):
    """The point-in-time lookup by one sort, each customer spread over three."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer_id"), "o_orderdate"
    )
    held = as_of_join(
        orders, _history(spark, sf_dir), "customer_id", "o_orderdate", ["segment", "region"], salts=3
    )
    return held.select("o_orderkey", "customer_id", *_as("date", "o_orderdate"), "segment", "region")


@query("point_in_time_join")
def point_in_time_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer_id"), "o_orderdate"
    )
    matched = point_in_time_join(
        orders, _history(spark, sf_dir), "customer_id", "o_orderdate", ["segment", "region"]
    )
    return matched.select(
        "o_orderkey", "customer_id", *_as("date", "o_orderdate"), "segment", "region"
    )


# Staging, intermediate, marts -------------------------------------------------------------------


@query("stg_transactions")
def stg_transactions(spark, sf_dir):
    staged, _ = _staged(spark, sf_dir)
    return staged.select(
        "transaction_id",
        "customer_id",
        *_as("double", "transaction_amount"),
        *_as("string", "transaction_at"),
        "transaction_date",
        *_as("bigint", "transaction_hour"),
    )


@query("stg_customers")
def stg_customers(spark, sf_dir):
    _, customers = _staged(spark, sf_dir)
    return customers.withColumns(
        {"crm_lifetime_value": F.col("crm_lifetime_value").cast("double")}
    )


@query("transactions_enriched")
def transactions_enriched(spark, sf_dir):
    return marts.transactions_enriched(*_staged(spark, sf_dir)).select(
        "transaction_id",
        "customer_id",
        *_as("double", "transaction_amount"),
        "transaction_date",
        *_as("bigint", "transaction_hour"),
        "customer_segment",
        "region",
        "signup_date",
        *_as("double", "crm_lifetime_value"),
        F.round(
            safe_divide(
                F.col("transaction_amount").cast("double"), F.col("crm_lifetime_value").cast("double")
            ),
            6,
        ).alias("txn_to_ltv_ratio"),
    )


def _daily(frame):
    return frame.select(
        "transaction_date",
        "customer_segment",
        "region",
        "transaction_count",
        "active_customers",
        *_as("double", "total_revenue", "avg_transaction_value", "revenue_per_customer"),
    )


@query("daily_revenue")
def daily_revenue(spark, sf_dir):
    """Silver holds each transaction_id once, so the mart need not count distinct ids."""
    staged = _staged(spark, sf_dir, _clean_silver)
    return _daily(marts.daily_revenue(*staged, unique_transactions=True))


@query("daily_revenue_distinct")
def daily_revenue_distinct(spark, sf_dir):
    """The same mart over repeated ids."""
    return _daily(marts.daily_revenue(*_staged(spark, sf_dir, _undeduped)))


def _c360(frame):
    return frame.select(
        "customer_id",
        "customer_segment",
        "region",
        "signup_date",
        *_as("double", "crm_lifetime_value"),
        *_as("bigint", "total_transactions"),
        *_as("double", "actual_lifetime_spend", "avg_order_value"),
        "first_purchase_date",
        "last_purchase_date",
        *_as("bigint", "active_span_days"),
        "value_tier",
        "engagement_status",
    )


def _customer_360(spark, sf_dir):
    return marts.customer_360(*_staged(spark, sf_dir), as_of=AS_OF, unique_transactions=True)


@query("customer_360")
def customer_360(spark, sf_dir):
    return _c360(_customer_360(spark, sf_dir))


@query("customer_360_distinct")
def customer_360_distinct(spark, sf_dir):
    """The same mart over repeated ids."""
    return _c360(marts.customer_360(*_staged(spark, sf_dir, _undeduped), as_of=AS_OF))


# Gold -------------------------------------------------------------------------------------------


@query("revenue_by_segment")
def revenue_by_segment(spark, sf_dir):
    return gold.revenue_by_segment(_clean_silver(spark, sf_dir), _customers(spark, sf_dir)).drop(
        "_processed_at"
    )


@query("revenue_by_segment_all_versions")
def revenue_by_segment_all_versions(spark, sf_dir):
    """Joined to every version in the history, so a changed customer counts once per version."""
    return gold.revenue_by_segment(
        _clean_silver(spark, sf_dir), _history(spark, sf_dir), current_only=False
    ).drop("_processed_at")


@query("customer_txn_summary")
def customer_txn_summary(spark, sf_dir):
    return gold.customer_summary(_silver(spark, sf_dir))


@query("customer_ltv")
def customer_ltv(spark, sf_dir):
    ltv = gold.customer_ltv(_silver(spark, sf_dir), _customers(spark, sf_dir), as_of=AS_OF)
    return ltv.select(
        "customer_id",
        *CUSTOMER_COLUMNS,
        "lifetime_transactions",
        "lifetime_spend",
        "first_transaction_date",
        "last_transaction_date",
        *_as("bigint", "tenure_days"),
        "customer_tier",
    )


# Scalar expressions -----------------------------------------------------------------------------


@query("value_tier")
def customer_value_tier(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    spend = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum((8 * F.col("l_quantity")).cast("bigint")).alias("spend"))
    )
    return spend.select("o_custkey", "spend", value_tier(F.col("spend")).alias("value_tier"))


@query("engagement_status")
def customer_engagement_status(spark, sf_dir):
    last = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max(F.to_date("o_orderdate")).alias("last_purchase_date"))
    )
    return last.select(
        "o_custkey",
        "last_purchase_date",
        engagement_status(F.col("last_purchase_date"), AS_OF).alias("engagement_status"),
    )


@query("safe_divide")
def safe_division(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    balance = (
        F.when(F.col("o_custkey") % 10 == 0, F.lit(0.0))
        .when(F.col("o_custkey") % 10 != 1, F.col("c_acctbal"))
    )
    ratio = safe_divide(F.col("o_totalprice"), balance)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", F.round(ratio, 6).alias("ratio")
    )


@query("surrogate_key")
def surrogate_keys(spark, sf_dir):
    customer = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", surrogate_key(customer, F.to_date("o_orderdate")).alias("order_sk")
    )


@query("cents_to_dollars")
def cents_conversion(spark, sf_dir):
    in_cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return table(spark, sf_dir, "part").select(
        "p_partkey", cents_to_dollars(in_cents).cast("double").alias("dollars")
    )


# Sources ----------------------------------------------------------------------------------------


@query("json_flatten")
def json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return parse_and_flatten(events, "props", "k bigint", separator="_")


@query("api_unwrap")
def api_unwrap(spark, sf_dir):
    schema = (
        "p_partkey bigint, spec struct<p_brand: string, p_type: string>, p_size bigint,"
        " p_retailprice double"
    )
    return flatten(unwrap_payloads(product_payloads(spark, sf_dir), "payload", schema), "_")


@query("api_unwrap_inferred")
def api_unwrap_inferred(spark, sf_dir):
    return flatten(unwrap_payloads(product_payloads(spark, sf_dir), "payload"), "_")


def _write_part_csv(spark, sf_dir, path):
    part = table(spark, sf_dir, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("part_code"),
        F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("label"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit("NA")).otherwise(F.col("p_type")).alias("p_type"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("n/a"))
        .otherwise(F.col("p_size").cast("string"))
        .alias("p_size"),
        "p_retailprice",
    )
    part.write.option("header", True).option("escape", '"').csv(path)


def _write_event_json(spark, sf_dir, path):
    names = [column.split()[0] for column in EVENT_COLUMNS.split(", ")]
    table(spark, sf_dir, "events").select(*names).write.json(path)


@query("scan_csv")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "part_csv")
    _write_part_csv(spark, sf_dir, path)
    return read_source(spark, SourceSpec("product_catalog", "flat_file", path, schema=PART_COLUMNS))


@query("scan_json")
def scan_json(spark, sf_dir):
    path = scratch_path(spark, "events_json")
    _write_event_json(spark, sf_dir, path)
    spec = SourceSpec(
        "web_events", "flat_file", path, "json", EVENT_COLUMNS, options={"lines": "true"}
    )
    return read_source(spark, spec)


@query("scan_csv_as_found")
def scan_csv_as_found(spark, sf_dir):
    """Text lines of one to three fields for a header of two; nothing is declared but the number."""
    path = scratch_path(spark, "lines_csv")
    kind = F.col("o_orderkey") % 5
    line = F.concat(
        F.col("o_orderkey").cast("string"),
        F.when(kind == 1, F.lit("")).otherwise(F.concat(F.lit(',"'), "o_orderpriority", F.lit(', ""x"""'))),
        F.when(kind == 2, F.concat(F.lit(","), "o_orderstatus")).otherwise(F.lit("")),
    )
    # A file begins with its header.
    orders = table(spark, sf_dir, "orders").select(line.alias("value"), F.spark_partition_id().alias("file"))
    files = orders.select("file").distinct().select(F.lit("order_no,priority").alias("value"), "file")
    both = files.withColumn("no", F.lit(0)).unionByName(orders.withColumn("no", F.lit(1)))
    both = both.repartition("file").sortWithinPartitions("file", "no").select("value", "file")
    both.write.partitionBy("file").text(path)
    spec = SourceSpec(
        "orders", "flat_file", f"{path}/*", schema="order_no bigint", options={"quarantine": "true"}
    )
    return read_source(spark, spec)


@query("scan_json_array")
def scan_json_array(spark, sf_dir):
    """JSON documents that hold an array of up to a thousand records each."""
    path = scratch_path(spark, "events_array")
    events = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 1000).alias("document"), F.struct("event_id", "event_type", "props").alias("record")
    )
    documents = events.groupBy("document").agg(F.to_json(F.collect_list("record")).alias("value"))
    documents.repartition("document").write.partitionBy("document").text(path)
    spec = SourceSpec(
        "web_events", "flat_file", f"{path}/*", "json", "event_id bigint, event_type string, props string"
    )
    return read_source(spark, spec)


@query("format_guard")
def format_guard(spark, sf_dir):
    """One landing folder under three formats: two are read, the third is refused."""
    path = scratch_path(spark, "events_lines")
    _write_event_json(spark, sf_dir, path)
    specs = [
        SourceSpec("as_lines", "flat_file", path, "json", EVENT_COLUMNS, options={"lines": "true"}),
        SourceSpec("as_csv", "flat_file", path, "csv", options={"header": "false", "sep": "\u0001"}),
        SourceSpec("as_xml", "flat_file", path, "xml"),
    ]
    results = ingest(spark, specs, scratch_path(spark, "guarded"), DAY_1)
    return results_frame(spark, results).select("source_name", "row_count", "status")


@query("registry_sources")
def registry_sources(spark, sf_dir):
    """Sources as a registry declares them, with the rows each lands."""
    root = scratch_path(spark, "registry")
    _write_part_csv(spark, sf_dir, f"{root}/part")
    _write_event_json(spark, sf_dir, f"{root}/events")
    config = load_sources(
        {
            "sources": [
                {"name": "product_catalog", "type": "flat_file", "path": f"{root}/part", "sla_hours": 24,
                 "owner": "catalog-team", "tier": "one"},
                {"name": "web_events", "type": "flat_file", "path": f"{root}/events", "format": "json",
                 "schema": EVENT_COLUMNS, "options": {"lines": "true"}, "owner": "analytics-team"},
            ],
            "bronze_retention_days": 30,
        }
    )
    counted = [
        read_source(spark, spec).agg(F.count(F.lit(1)).alias("landed")).select(
            F.lit(spec.name).alias("source_name"),
            F.lit(spec.sla_hours).cast("double").alias("sla_hours"),
            F.lit(spec.owner).alias("owner"),
            F.lit(spec.extra.get("tier")).cast("string").alias("tier"),
            F.lit(config.bronze_retention_days).cast("bigint").alias("retention_days"),
            "landed",
        )
        for spec in config.sources
    ]
    return union_by_name(*counted)


@query("incremental_extract")
def incremental_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("updated_at", F.to_date("o_orderdate"))
    return incremental_extract(
        orders, ["o_orderkey", "o_custkey", "o_totalprice", "updated_at"], as_of=AS_OF, days=30
    )


@query("bronze_stamp")
def bronze_stamp(spark, sf_dir):
    stamped = stamp(table(spark, sf_dir, "part"), "product_catalog", f"{AS_OF} 06:00:00")
    return stamped.select("p_partkey", *_as("string", "_ingested_at"), "_source_system")


@query("bronze_land_roundtrip")
def bronze_land_roundtrip(spark, sf_dir):
    """The first day is landed twice, the second time with other sizes, the second day once."""
    root = scratch_path(spark, "bronze")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    land(part, root, "product_catalog", DAY_1)
    land(part.withColumn("p_size", F.col("p_size") + 100), root, "product_catalog", DAY_1)
    land(part, root, "product_catalog", DAY_2)
    landed = read_table(spark, f"{root}/product_catalog")
    return landed.select("p_partkey", *_as("bigint", "p_size"), "_source_system", "ingest_date")


def _fresh_name(spark, name):
    """A catalog name no other call uses, and its folder."""
    root = scratch_path(spark, name)
    return f"stratum_scratch.{root.rpartition('/')[2].replace('-', '_')}", root


@query("bronze_catalog_days")
def bronze_catalog_days(spark, sf_dir):
    """Days with different columns land in a catalog table, the first one twice."""
    name, root = _fresh_name(spark, "part_days")
    part = table(spark, sf_dir, "part")
    land_partition(part.select("p_partkey", "p_size"), name, root, "ingest_date", "2001-08-01")
    land_partition(part.select("p_brand", "p_partkey"), name, root, "ingest_date", "2001-08-02")
    sizes = part.select("p_partkey", (F.col("p_size") + 100).alias("p_size"))
    land_partition(sizes, name, root, "ingest_date", "2001-08-01")
    return spark.table(name).select("p_partkey", *_as("bigint", "p_size"), "p_brand", "ingest_date")


@query("source_reference")
def source_reference(spark, sf_dir):
    """A catalog table published by month, then again from itself with other amounts and a new column."""
    name, root = _fresh_name(spark, "fct")
    facts = _clean_silver(spark, sf_dir).withColumn(
        "transaction_month", F.trunc("transaction_date", "month")
    )
    publish_table(facts, name, root, "transaction_month")
    again = spark.table(name).withColumns({"amount_usd": -F.col("amount_usd"), "note": F.lit("again")})
    publish_table(again, name, root, "transaction_month")
    return source_table(spark, *name.split(".")).select(
        "transaction_id", "amount_usd", "transaction_date", "transaction_month", "note"
    )


@query("silver_roundtrip")
def silver_roundtrip(spark, sf_dir):
    """Written by month, then overwritten by itself with other amounts."""
    path = f"{scratch_path(spark, 'silver')}/fct_transactions"
    facts = _silver(spark, sf_dir).withColumn(
        "transaction_month", F.trunc("transaction_date", "month")
    )
    overwrite_table(facts, path, "transaction_month")
    changed = read_table(spark, path).withColumn("amount_usd", F.col("amount_usd") + 1)
    overwrite_table(changed, path, "transaction_month")
    return read_table(spark, path).select(
        "transaction_id", "amount_usd", "transaction_date", "transaction_month"
    )


@query("ingest_summary")
def ingest_summary(spark, sf_dir):
    """Two good sources, one that fails, one of unknown type."""
    root = scratch_path(spark, "ingest")
    _write_part_csv(spark, sf_dir, f"{root}/landing/part")
    _write_event_json(spark, sf_dir, f"{root}/landing/events")
    specs = [
        SourceSpec("product_catalog", "flat_file", f"{root}/landing/part", schema=PART_COLUMNS),
        SourceSpec(
            "web_events", "flat_file", f"{root}/landing/events", "json", EVENT_COLUMNS,
            options={"lines": "true"},
        ),
        SourceSpec("customer_master", "flat_file", f"{root}/landing/absent"),
        SourceSpec("clickstream", "message_queue"),
    ]
    results = ingest(spark, specs, f"{root}/bronze", DAY_1)
    return results_frame(spark, results).select("source_name", "row_count", "status")


@query("table_files_union")
def table_files_union(spark, sf_dir):
    """Two batches of files with different columns, loaded as one table."""
    root = scratch_path(spark, "part_files")
    part = table(spark, sf_dir, "part")
    part.select("p_partkey", "p_size").write.parquet(f"{root}/batch=1")
    part.select("p_brand", "p_partkey").write.parquet(f"{root}/batch=2")
    loaded = load_table_files(spark, root)
    return loaded.select("p_partkey", *_as("bigint", "p_size"), "p_brand", *_as("bigint", "batch"))


@query("export_roundtrip")
def export_roundtrip(spark, sf_dir):
    """Exported twice; the second export replaces the first."""
    path = scratch_path(spark, "export")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    export_table(customers, "parquet", {"path": path}, "customers")
    customers = customers.withColumn("c_acctbal", -F.col("c_acctbal"))
    export_table(customers, "parquet", {"path": path}, "customers")
    return read_table(spark, path)


@query("mart_materialization")
def mart_materialization(spark, sf_dir):
    """Staging as views, the enriched model ephemeral, a mart as a table."""
    transactions, customers = _staged(spark, sf_dir, _clean_silver)
    transactions = materialize(transactions, "mart_stg_transactions", "view")
    customers = materialize(customers, "mart_stg_customers", "view")
    enriched = materialize(
        marts.transactions_enriched(transactions, customers), "enriched", "ephemeral"
    )
    by_region = enriched.groupBy("region").agg(
        F.count("transaction_id").alias("transactions"),
        cents_as_double(sum_cents(cents(F.col("transaction_amount")))).alias("revenue"),
    )
    return materialize(by_region, "mart_by_region", "table", scratch_path(spark, "mart_by_region"))


@query("retention_filter")
def retention_filter(spark, sf_dir):
    bronze = table(spark, sf_dir, "orders").withColumn("ingest_date", F.to_date("o_orderdate"))
    return expired_partitions(bronze, AS_OF, 90).select("o_orderkey", "ingest_date")


@query("retention_expire")
def retention_expire(spark, sf_dir):
    """Orders landed by month; the folders past retention go, unread."""
    path = f"{scratch_path(spark, 'landed')}/orders"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("ingest_date")
    )
    overwrite_table(orders, path, "ingest_date")
    expire_folders(spark, path, "ingest_date", "1998-02-01")
    return read_table(spark, path)


@query("union_by_name")
def union_of_parts(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return union_by_name(
        customer.select("c_custkey", "c_name", "c_acctbal"),
        customer.select("c_mktsegment", "c_custkey"),
    )


# Quality ----------------------------------------------------------------------------------------


def _rules(frame):
    return frame.select(F.col("table").alias("table_name"), "name", "severity", "passed")


def _transaction_rules(spark, sf_dir):
    contract = dq.transactions_contract()
    return (
        dq.validation_frame("fct_transactions", _silver(spark, sf_dir), contract, single_pass=True),
        dq.validation_frame(
            "raw_transactions", _raw_contract_table(spark, sf_dir), contract, single_pass=True
        ),
    )


@query("dq_transactions")
def dq_transactions(spark, sf_dir):
    clean, raw = _transaction_rules(spark, sf_dir)
    return _rules(clean.unionByName(raw))


@query("dq_customer_360")
def dq_customer_360(spark, sf_dir):
    mart = _customer_360(spark, sf_dir)
    dirty = mart.select(
        F.when(F.col("region") != "ASIA", F.col("customer_id")).alias("customer_id"),
        F.when(F.col("region") != "ASIA", F.col("value_tier")).alias("value_tier"),
        F.when(F.col("region") == "EUROPE", F.lit("lost"))
        .otherwise(F.col("engagement_status"))
        .alias("engagement_status"),
        (-F.col("actual_lifetime_spend")).alias("actual_lifetime_spend"),
    )
    contract = dq.customer_360_contract()
    return _rules(
        dq.validation_frame("mart_customer_360", mart, contract, single_pass=True).unionByName(
            dq.validation_frame("dirty_customer_360", dirty, contract, single_pass=True)
        )
    )


@query("dq_custom")
def dq_custom(spark, sf_dir):
    rules = [
        dq.Expectation("quantities sum above line count", F.sum("l_quantity") > F.count(F.lit(1))),
        dq.Expectation("mean discount at most five percent", F.avg("l_discount") <= 0.05, "warn"),
        dq.Expectation("line numbers end at seven", F.max("l_linenumber") == 7),
        dq.Expectation("shipping column known", F.count("l_shipped_on") > 0),
    ]
    return _rules(dq.validation_frame("lineitem", table(spark, sf_dir, "lineitem"), rules))


@query("dq_gate")
def dq_gate(spark, sf_dir):
    return dq.gate_summary(*_transaction_rules(spark, sf_dir)).withColumnRenamed(
        "table", "table_name"
    )


@query("schema_tests")
def schema_tests(spark, sf_dir):
    tests = st.source_and_mart_tests()
    staged = _staged(spark, sf_dir)
    tables = {
        "fct_transactions": _raw_contract_table(spark, sf_dir),
        "dim_customer": _customers(spark, sf_dir),
        "mart_daily_revenue": marts.daily_revenue(*staged, unique_transactions=True),
        "mart_customer_360": _customer_360(spark, sf_dir),
    }
    frames = [
        dq.validation_frame(name, df, tests[name], single_pass=True) for name, df in tables.items()
    ]
    return _rules(union_by_name(*frames))


@query("test_unique")
def test_unique(spark, sf_dir):
    return st.repeated_values(bronze_transactions(spark, sf_dir), "transaction_id")


@query("test_not_null")
def test_not_null(spark, sf_dir):
    failing = st.null_rows(bronze_transactions(spark, sf_dir), "customer_id")
    return failing.select("transaction_id", "customer_id", "tie_break")


@query("test_accepted_values")
def test_accepted_values(spark, sf_dir):
    mart = _customer_360(spark, sf_dir).withColumn(
        "value_tier",
        F.when(F.col("region") == "ASIA", "diamond").when(
            F.col("region") != "AFRICA", F.col("value_tier")
        ),
    )
    failing = st.unaccepted_rows(mart, "value_tier", VALUE_TIERS)
    return failing.select("customer_id", "value_tier")


@query("test_accepted_range")
def test_accepted_range(spark, sf_dir):
    typed = silver.cast_transactions(bronze_transactions(spark, sf_dir))
    failing = st.out_of_range_rows(typed, "amount", min_value=0)
    return failing.select("transaction_id", "amount", "tie_break")


@query("freshness")
def freshness(spark, sf_dir):
    report = st.freshness(table(spark, sf_dir, "events"), "ts", EVENTS_CHECKED_AT)
    return report.select(
        F.date_format("max_loaded_at", "yyyy-MM-dd HH:mm:ss").alias("max_loaded_at"),
        "age_seconds",
        "status",
    )


@query("freshness_landed")
def freshness_landed(spark, sf_dir):
    """Freshness of events landed by day, from the newest day alone."""
    path = f"{scratch_path(spark, 'landed')}/web_events"
    overwrite_table(
        table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("ingest_date")),
        path,
        "ingest_date",
    )
    newest = newest_folder(spark, path, "ingest_date")
    sla = st.sla_report({"web_events": newest}, {"web_events": 3}, SLA_CHECKED_AT, "ts")
    return sla.select("source_name", "sla_hours", "age_seconds", "status")


@query("freshness_sla")
def freshness_sla(spark, sf_dir):
    bronze = {
        "customer_transactions": table(spark, sf_dir, "lineitem").withColumnRenamed(
            "l_shipdate", "_ingested_at"
        ),
        "web_events": table(spark, sf_dir, "events").withColumnRenamed("ts", "_ingested_at"),
    }
    sla = {"customer_transactions": 6, "web_events": 3}
    return st.sla_report(bronze, sla, SLA_CHECKED_AT).select(
        "source_name", "sla_hours", "age_seconds", "status"
    )
