"""Bronze-shaped frames derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values shared with the SQL twins.
AS_OF = "2001-08-01"
REPORTING_START = "1996-01-01"
SNAPSHOT_DAYS = {1: "1998-01-01", 2: "2000-01-01"}


# Declared, so that building a query starts no job to look into file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as raw transactions: repeated ids, null customers, unusable amounts."""
    lines = table(spark, sf_dir, "lineitem")
    # Text forms are made once per order, below the join, not once per line.
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderdate").cast("string").alias("transaction_ts"),
    )
    eightfold = (8 * F.col("l_quantity")).cast("bigint")
    bad = F.col("l_suppkey") % 20 == 0
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("customer")).alias("customer_id"),
        F.when(bad & (F.col("l_linenumber") % 2 == 0), F.lit("n/a"))
        .when(bad, (-eightfold).cast("string"))
        .otherwise(eightfold.cast("string"))
        .alias("amount"),
        "transaction_ts",
        F.col("l_shipdate").alias("_ingested_at"),
        F.col("l_partkey").alias("tie_break"),
    )


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions with cents."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("string").alias("transaction_ts"),
        F.col("o_orderdate").alias("_ingested_at"),
    )


def _customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _in_snapshot(version: Column) -> Column:
    key = F.col("c_custkey")
    return F.when(version == 1, key % 13 != 0).otherwise(key % 11 != 0)


def _customer_columns(version: Column) -> list[Column]:
    key = F.col("c_custkey")
    moved = (version == 2) & (key % 7 == 0)
    return [
        key.cast("string").alias("customer_id"),
        F.when(moved, F.lit("MACHINERY")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("r_name").alias("region"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")).alias("signup_date"),
        F.col("c_acctbal").alias("lifetime_value"),
    ]


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, with the columns of the first snapshot."""
    return _customer_master(spark, sf_dir).select(*_customer_columns(F.lit(1)))


def customer_snapshot(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Customer master as of the first or second snapshot day."""
    number = F.lit(version)
    master = _customer_master(spark, sf_dir).filter(_in_snapshot(number))
    return master.select(*_customer_columns(number))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both snapshots as loaded on their days, from one reading of the customers."""
    version = F.col("version")
    days = [F.lit(day).cast("timestamp") for day in SNAPSHOT_DAYS.values()]
    versions = F.explode(F.array(*[F.lit(number) for number in SNAPSHOT_DAYS]))
    both = _customer_master(spark, sf_dir).withColumn("version", versions)
    return both.filter(_in_snapshot(version)).select(
        *_customer_columns(version),
        F.when(version == 1, days[0]).otherwise(days[1]).alias("_ingested_at"),
    )


def product_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as API payloads: lists, objects with results, single objects; and pages without results."""
    kind = F.col("p_partkey") % 4
    spec = F.struct("p_brand", "p_type").alias("spec")
    single = F.struct("p_partkey", spec, F.lit(None).cast("int").alias("p_size"), "p_retailprice")
    record = F.struct("p_partkey", spec, "p_size", "p_retailprice")
    sibling = F.struct(
        "p_partkey", spec, (F.col("p_size") + 100).alias("p_size"), "p_retailprice"
    )
    page = F.concat(F.lit('{"count":1,"results":'), F.to_json(F.array(record)), F.lit("}"))
    empty = F.lit('{"count":0,"results":[]}')
    payloads = (
        F.when(kind == 0, F.array(F.to_json(F.array(record, sibling))))
        .when(kind == 1, F.array(page))
        .when(kind == 2, F.array(F.to_json(single)))
        .otherwise(F.array(page, empty))
    )
    return table(spark, sf_dir, "part").select(F.explode(payloads).alias("payload"))
