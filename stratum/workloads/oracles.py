"""SQL twins of the queries, for DuckDB over the same tables."""

from __future__ import annotations

from stratum.workloads.fixtures import AS_OF, REPORTING_START, SNAPSHOT_DAYS

BRONZE_TRANSACTIONS = """
bronze_transactions AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS transaction_id,
         CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN l_suppkey % 20 = 0 AND l_linenumber % 2 = 0 THEN 'n/a'
              WHEN l_suppkey % 20 = 0 THEN CAST(CAST(-8 * l_quantity AS BIGINT) AS VARCHAR)
              ELSE CAST(CAST(8 * l_quantity AS BIGINT) AS VARCHAR) END AS amount,
         CAST(o_orderdate AS VARCHAR) AS transaction_ts,
         l_shipdate AS _ingested_at,
         l_partkey AS tie_break
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CLEAN_TRANSACTIONS = """
bronze_transactions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         o_totalprice AS amount,
         CAST(o_orderdate AS VARCHAR) AS transaction_ts,
         o_orderdate AS _ingested_at,
         o_totalprice AS tie_break
  FROM orders)"""

TYPED = """
typed AS (
  SELECT transaction_id, customer_id, TRY_CAST(amount AS DOUBLE) AS amount,
         TRY_CAST(transaction_ts AS TIMESTAMP) AS transaction_ts, _ingested_at, tie_break
  FROM bronze_transactions),
valid AS (SELECT * FROM typed WHERE amount > 0 AND customer_id IS NOT NULL),
enriched_valid AS (
  SELECT transaction_id, customer_id, amount, transaction_ts, round(amount, 2) AS amount_usd,
         CAST(transaction_ts AS DATE) AS transaction_date,
         CAST(hour(transaction_ts) AS BIGINT) AS transaction_hour
  FROM valid),
fct AS (
  SELECT transaction_id, customer_id, amount, transaction_ts, round(amount, 2) AS amount_usd,
         CAST(transaction_ts AS DATE) AS transaction_date,
         CAST(hour(transaction_ts) AS BIGINT) AS transaction_hour
  FROM valid
  QUALIFY row_number() OVER (PARTITION BY transaction_id
                             ORDER BY _ingested_at DESC NULLS LAST, tie_break DESC NULLS LAST) = 1)"""

SILVER = f"{BRONZE_TRANSACTIONS},{TYPED}"
CLEAN_SILVER = f"{CLEAN_TRANSACTIONS},{TYPED}"

SNAPSHOTS = f"""
master AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS customer_id, c_mktsegment, r_name AS region,
         DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
         c_acctbal AS lifetime_value
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v1 AS (
  SELECT customer_id, c_mktsegment AS segment, region, signup_date, lifetime_value
  FROM master WHERE c_custkey % 13 <> 0),
v2 AS (
  SELECT customer_id, CASE WHEN c_custkey % 7 = 0 THEN 'MACHINERY' ELSE c_mktsegment END AS segment,
         region, signup_date, lifetime_value
  FROM master WHERE c_custkey % 11 <> 0),
dim AS (
  SELECT customer_id, segment, region, signup_date, lifetime_value,
         DATE '{AS_OF}' AS effective_from, DATE '9999-12-31' AS effective_to, true AS is_current
  FROM (SELECT *, 1 AS version FROM v1 UNION ALL SELECT *, 2 AS version FROM v2)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY version DESC) = 1)"""


def _history(full_snapshot: bool) -> str:
    gone = "n.customer_id IS NULL" if full_snapshot else "false"
    first, second = SNAPSHOT_DAYS[1], SNAPSHOT_DAYS[2]
    return f"""{SNAPSHOTS},
both_sides AS (
  SELECT o.customer_id AS old_id, n.customer_id AS new_id,
         o.segment AS old_segment, o.region AS old_region, o.signup_date AS old_signup,
         o.lifetime_value AS old_value,
         n.segment AS new_segment, n.region AS new_region, n.signup_date AS new_signup,
         n.lifetime_value AS new_value,
         o.customer_id IS NOT NULL AND n.customer_id IS NOT NULL
           AND (o.segment IS DISTINCT FROM n.segment OR o.region IS DISTINCT FROM n.region
                OR o.signup_date IS DISTINCT FROM n.signup_date
                OR o.lifetime_value IS DISTINCT FROM n.lifetime_value) AS changed,
         o.customer_id IS NOT NULL AND {gone} AS gone
  FROM v1 o FULL OUTER JOIN v2 n ON o.customer_id = n.customer_id),
history AS (
  SELECT old_id AS customer_id, old_segment AS segment, old_region AS region,
         old_signup AS signup_date, old_value AS lifetime_value,
         DATE '{first}' AS effective_from,
         CASE WHEN changed OR gone THEN DATE '{second}' ELSE DATE '9999-12-31' END AS effective_to,
         NOT (changed OR gone) AS is_current
  FROM both_sides WHERE old_id IS NOT NULL
  UNION ALL
  SELECT new_id, new_segment, new_region, new_signup, new_value,
         DATE '{second}', DATE '9999-12-31', true
  FROM both_sides WHERE new_id IS NOT NULL AND (old_id IS NULL OR changed))"""


def _staging(fct: str = "fct", start: str = REPORTING_START) -> str:
    return f"""
stg_t AS (
  SELECT transaction_id, customer_id, CAST(amount_usd AS DECIMAL(28,2)) AS transaction_amount,
         transaction_ts AS transaction_at, transaction_date, transaction_hour
  FROM {fct} WHERE transaction_date >= DATE '{start}'),
stg_c AS (
  SELECT customer_id, segment AS customer_segment, region, signup_date,
         CAST(lifetime_value AS DECIMAL(28,2)) AS crm_lifetime_value,
         effective_from, effective_to, is_current
  FROM dim WHERE is_current),
enriched AS (
  SELECT t.*, c.customer_segment, c.region, c.signup_date, c.crm_lifetime_value
  FROM stg_t t LEFT JOIN stg_c c ON t.customer_id = c.customer_id)"""


def _total(amount: str) -> str:
    return f"CAST(sum({amount}) * 100 AS BIGINT)"


def _money(total: str) -> str:
    return f"{total} / 100.0::DOUBLE"


def _half_up(total: str, n: str) -> str:
    return f"((2 * {total} + {n}) // (2 * {n})) / 100.0::DOUBLE"


def _daily(source: str, fct: str) -> str:
    total = _total("transaction_amount")
    return f"""WITH {source},{SNAPSHOTS},{_staging(fct)}
SELECT transaction_date, customer_segment, region,
       count(DISTINCT transaction_id) AS transaction_count,
       count(DISTINCT customer_id) AS active_customers,
       {_money(total)} AS total_revenue,
       {_half_up(total, 'count(transaction_amount)')} AS avg_transaction_value,
       {_half_up(total, 'count(DISTINCT customer_id)')} AS revenue_per_customer
FROM enriched GROUP BY 1, 2, 3"""


def _c360_ctes(source: str, fct: str) -> str:
    total = _total("transaction_amount")
    return f"""{source},{SNAPSHOTS},{_staging(fct)},
behaviour AS (
  SELECT customer_id, customer_segment, region, signup_date,
         CAST(crm_lifetime_value AS DOUBLE) AS crm_lifetime_value,
         count(DISTINCT transaction_id) AS total_transactions,
         {_money(total)} AS actual_lifetime_spend,
         {_half_up(total, 'count(transaction_amount)')} AS avg_order_value,
         min(transaction_date) AS first_purchase_date,
         max(transaction_date) AS last_purchase_date
  FROM enriched GROUP BY customer_id, customer_segment, region, signup_date, enriched.crm_lifetime_value),
c360 AS (
  SELECT *, date_diff('day', first_purchase_date, last_purchase_date) AS active_span_days,
         {_tier('actual_lifetime_spend')} AS value_tier,
         {_engagement('last_purchase_date')} AS engagement_status
  FROM behaviour)"""


def _tier(spend: str) -> str:
    return (
        f"CASE WHEN {spend} >= 10000 THEN 'platinum' WHEN {spend} >= 5000 THEN 'gold'"
        f" WHEN {spend} >= 1000 THEN 'silver' ELSE 'bronze' END"
    )


def _engagement(last: str) -> str:
    return (
        f"CASE WHEN {last} < DATE '{AS_OF}' - INTERVAL 90 DAY THEN 'churned'"
        f" WHEN {last} < DATE '{AS_OF}' - INTERVAL 30 DAY THEN 'at_risk' ELSE 'active' END"
    )


def _revenue(source: str, dim_ctes: str, dim: str) -> str:
    total = _total("CAST(amount_usd AS DECIMAL(18,2))")
    return f"""WITH {source},{dim_ctes}
SELECT transaction_date, segment, region,
       count(transaction_id) AS transaction_count,
       count(DISTINCT f.customer_id) AS active_customers,
       {_money(total)} AS total_revenue,
       {_half_up(total, 'count(amount_usd)')} AS avg_transaction_value
FROM fct f LEFT JOIN {dim} d ON f.customer_id = d.customer_id GROUP BY 1, 2, 3"""


def _rules(table: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    """One row per (name, severity, aggregate condition)."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS name, '{severity}' AS severity,"
        f" (SELECT {condition} FROM {source}) AS passed"
        for name, severity, condition in rules
    )


def _no_repeats(column: str) -> str:
    return f"count(*) - count(DISTINCT {column}) <= CASE WHEN count(*) > count({column}) THEN 1 ELSE 0 END"


TRANSACTION_RULES = [
    ("transaction_id is unique", "error", _no_repeats("transaction_id")),
    ("every row has a transaction_id", "error", "count(*) = count(transaction_id)"),
    ("amount_usd above zero in every row", "error",
     "count(*) FILTER (NOT coalesce(amount_usd > 0, false)) = 0"),
    ("amount_usd below 1e+06 in at least 99.9% of rows", "warn",
     "coalesce(avg(CAST(coalesce(amount_usd < 1000000, false) AS INTEGER)) >= 0.999, false)"),
    ("every row has a customer_id", "error", "count(*) = count(customer_id)"),
    ("at least 1 rows", "error", "count(*) >= 1"),
]

CUSTOMER_360_RULES = [
    ("customer_id is unique", "error", _no_repeats("customer_id")),
    ("only listed values in value_tier", "error",
     "count(*) FILTER (NOT coalesce(value_tier IN ('platinum','gold','silver','bronze'), false)) = 0"),
    ("only listed values in engagement_status", "error",
     "count(*) FILTER (NOT coalesce(engagement_status IN ('active','at_risk','churned'), false)) = 0"),
    ("no actual_lifetime_spend below zero", "error",
     "count(*) FILTER (coalesce(actual_lifetime_spend, 0) < 0) = 0"),
]

RAW_FCT = """
raw_fct AS (SELECT transaction_id, customer_id, round(amount, 2) AS amount_usd FROM typed)"""


def _both_transaction_tables() -> str:
    return (
        f"{_rules('fct_transactions', 'fct', TRANSACTION_RULES)} UNION ALL "
        f"{_rules('raw_transactions', 'raw_fct', TRANSACTION_RULES)}"
    )


def _schema_test_rules() -> str:
    def not_null(column):
        return (f"not_null({column})", "error", f"count(*) = count({column})")

    def no_repeat(column):
        return (f"unique({column})", "error", f"count({column}) = count(DISTINCT {column})")

    def accepted(column, values):
        return (f"accepted_values({column})", "error", f"count(*) FILTER ({column} NOT IN {values}) = 0")

    daily = f"({_daily_from_ctes()})"
    tables = [
        ("fct_transactions", "raw_fct",
         [no_repeat("transaction_id"), not_null("transaction_id"), not_null("customer_id"),
          not_null("amount_usd")]),
        ("dim_customer", "dim", [not_null("customer_id"), not_null("is_current")]),
        ("mart_daily_revenue", daily,
         [not_null("transaction_date"), not_null("total_revenue"), not_null("active_customers"),
          ("min_value(active_customers)", "error", "count(*) FILTER (NOT active_customers >= 0) = 0")]),
        ("mart_customer_360", "c360",
         [no_repeat("customer_id"), not_null("customer_id"),
          accepted("value_tier", "('platinum','gold','silver','bronze')"),
          accepted("engagement_status", "('active','at_risk','churned')")]),
    ]
    return " UNION ALL ".join(_rules(*entry) for entry in tables)


def _daily_from_ctes() -> str:
    return """SELECT transaction_date, customer_segment, region, sum(transaction_amount) AS total_revenue,
       count(DISTINCT customer_id) AS active_customers FROM enriched GROUP BY 1, 2, 3"""


def _status(age: str, warn_hours: str, error_hours: str) -> str:
    return (
        f"CASE WHEN {age} IS NULL OR {age} > {error_hours} * 3600 THEN 'error'"
        f" WHEN {age} > {warn_hours} * 3600 THEN 'warn' ELSE 'pass' END"
    )


def _age(checked_at: str, newest: str) -> str:
    return f"CAST(epoch(TIMESTAMP '{checked_at}') - floor(epoch({newest})) AS BIGINT)"


def all_oracles() -> dict[str, str]:
    customer_columns = "customer_id, segment, region, signup_date, lifetime_value"
    frame_columns = f"{customer_columns}, effective_from, effective_to, is_current"
    ltv_total = _total("CAST(amount_usd AS DECIMAL(18,2))")
    part_code = "lpad(CAST(p_partkey AS VARCHAR), 12, '0')"
    events_age = _age("2024-01-31 18:00:00", "max(ts)")
    return {
        "silver_cast": f"""WITH {BRONZE_TRANSACTIONS}
SELECT transaction_id, customer_id, TRY_CAST(amount AS DOUBLE) AS amount,
       CASE WHEN tie_break % 9 <> 0 THEN CAST(TRY_CAST(transaction_ts AS TIMESTAMP) AS VARCHAR) END
         AS transaction_ts, tie_break
FROM bronze_transactions""",
        "silver_filter": f"""WITH {SILVER}
SELECT transaction_id, customer_id, amount, tie_break FROM valid""",
        "dedupe_latest": f"""WITH {BRONZE_TRANSACTIONS}
SELECT transaction_id, customer_id, amount, CAST(_ingested_at AS DATE) AS _ingested_at, tie_break
FROM bronze_transactions
QUALIFY row_number() OVER (PARTITION BY transaction_id
                           ORDER BY _ingested_at DESC NULLS LAST, tie_break DESC NULLS LAST) = 1""",
        "silver_enrich": """SELECT event_id, round(value, 2) AS amount_usd,
       CAST(ts AS DATE) AS transaction_date, CAST(hour(ts) AS BIGINT) AS transaction_hour
FROM events""",
        "silver_transactions": f"""WITH {SILVER}
SELECT transaction_id, customer_id, amount, CAST(transaction_ts AS VARCHAR) AS transaction_ts,
       amount_usd, transaction_date, transaction_hour FROM fct""",
        "silver_customer": f"WITH {SNAPSHOTS} SELECT {frame_columns} FROM dim",
        "scd2_frame": f"""WITH {SNAPSHOTS},
whole AS (SELECT customer_id, c_mktsegment AS segment, region, signup_date, lifetime_value FROM master)
SELECT {customer_columns}, DATE '{AS_OF}' AS effective_from, DATE '9999-12-31' AS effective_to,
       true AS is_current FROM whole""",
        "scd2_merge": f"WITH {_history(True)} SELECT {frame_columns} FROM history",
        "scd2_merge_incremental": f"WITH {_history(False)} SELECT {frame_columns} FROM history",
        "point_in_time_join": f"""WITH {_history(True)}
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(o_orderdate AS DATE) AS o_orderdate, h.segment, h.region
FROM orders LEFT JOIN history h
  ON CAST(o_custkey AS VARCHAR) = h.customer_id
 AND CAST(o_orderdate AS DATE) >= h.effective_from AND CAST(o_orderdate AS DATE) < h.effective_to""",
        "stg_transactions": f"""WITH {SILVER},{SNAPSHOTS},{_staging()}
SELECT transaction_id, customer_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
       CAST(transaction_at AS VARCHAR) AS transaction_at, transaction_date, transaction_hour
FROM stg_t""",
        "stg_customers": f"""WITH {SILVER},{SNAPSHOTS},{_staging()}
SELECT customer_id, customer_segment, region, signup_date,
       CAST(crm_lifetime_value AS DOUBLE) AS crm_lifetime_value,
       effective_from, effective_to, is_current FROM stg_c""",
        "transactions_enriched": f"""WITH {SILVER},{SNAPSHOTS},{_staging()}
SELECT transaction_id, customer_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
       transaction_date, transaction_hour, customer_segment, region, signup_date,
       CAST(crm_lifetime_value AS DOUBLE) AS crm_lifetime_value,
       CASE WHEN crm_lifetime_value <> 0
            THEN round(CAST(transaction_amount AS DOUBLE) / CAST(crm_lifetime_value AS DOUBLE), 6) END
         AS txn_to_ltv_ratio
FROM enriched""",
        "daily_revenue": _daily(CLEAN_SILVER, "fct"),
        "daily_revenue_distinct": _daily(SILVER, "enriched_valid"),
        "customer_360": f"WITH {_c360_ctes(SILVER, 'fct')} SELECT * FROM c360",
        "customer_360_distinct": f"WITH {_c360_ctes(SILVER, 'enriched_valid')} SELECT * FROM c360",
        "revenue_by_segment": _revenue(CLEAN_SILVER, SNAPSHOTS, "dim"),
        "revenue_by_segment_all_versions": _revenue(CLEAN_SILVER, _history(True), "history"),
        "customer_txn_summary": f"""WITH {SILVER}
SELECT customer_id, count(transaction_id) AS lifetime_transactions,
       {_money(ltv_total)} AS lifetime_spend,
       min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
FROM fct GROUP BY customer_id""",
        "customer_ltv": f"""WITH {SILVER},{SNAPSHOTS},
summary AS (
  SELECT customer_id, count(transaction_id) AS lifetime_transactions,
         {_money(ltv_total)} AS lifetime_spend,
         min(transaction_date) AS first_transaction_date,
         max(transaction_date) AS last_transaction_date
  FROM fct GROUP BY customer_id)
SELECT d.customer_id, segment, region, signup_date, lifetime_value, lifetime_transactions,
       lifetime_spend, first_transaction_date, last_transaction_date,
       date_diff('day', signup_date, DATE '{AS_OF}') AS tenure_days,
       {_tier('lifetime_spend')} AS customer_tier
FROM dim d LEFT JOIN summary s ON d.customer_id = s.customer_id""",
        "value_tier": f"""
WITH spend AS (
  SELECT o_custkey, CAST(sum(CAST(8 * l_quantity AS BIGINT)) AS BIGINT) AS spend
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
SELECT o_custkey, spend, {_tier('spend')} AS value_tier FROM spend""",
        "engagement_status": f"""
WITH last AS (
  SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_purchase_date FROM orders GROUP BY o_custkey)
SELECT o_custkey, last_purchase_date, {_engagement('last_purchase_date')} AS engagement_status
FROM last""",
        "safe_divide": """
WITH balances AS (
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_custkey % 10 = 0 THEN 0.0 WHEN o_custkey % 10 <> 1 THEN c_acctbal END AS balance
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, CASE WHEN balance <> 0 THEN round(o_totalprice / balance, 6) END AS ratio
FROM balances""",
        "surrogate_key": """SELECT o_orderkey, md5(
  coalesce(CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END, '_null_')
  || '-' || coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '_null_')) AS order_sk
FROM orders""",
        "cents_to_dollars": """SELECT p_partkey,
       CAST(round(p_retailprice * 100) AS BIGINT) / 100.0::DOUBLE AS dollars FROM part""",
        "json_flatten": """SELECT event_id, event_type,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k FROM events""",
        "api_unwrap": _payload_records(),
        "api_unwrap_inferred": _payload_records(),
        "scan_csv": f"""SELECT {part_code} AS part_code, p_name || ', "' || p_brand || '"' AS label,
       CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS p_type,
       CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS BIGINT) END AS p_size, p_retailprice
FROM part""",
        "scan_json": "SELECT event_id, user_id, event_type, value, props FROM events",
        "incremental_extract": f"""SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(o_orderdate AS DATE) AS updated_at
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' - INTERVAL 30 DAY""",
        "bronze_stamp": f"""SELECT p_partkey, '{AS_OF} 06:00:00' AS _ingested_at,
       'product_catalog' AS _source_system FROM part""",
        "bronze_land_roundtrip": """
SELECT p_partkey, CAST(p_size AS BIGINT) + 100 AS p_size, 'product_catalog' AS _source_system,
       DATE '2001-08-01' AS ingest_date FROM part
UNION ALL
SELECT p_partkey, CAST(p_size AS BIGINT), 'product_catalog', DATE '2001-08-02' FROM part""",
        "silver_roundtrip": f"""WITH {SILVER}
SELECT transaction_id, amount_usd + 1 AS amount_usd, transaction_date,
       CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month
FROM fct""",
        "source_reference": f"""WITH {CLEAN_SILVER}
SELECT transaction_id, -amount_usd AS amount_usd, transaction_date,
       CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month, 'again' AS note
FROM fct""",
        "bronze_catalog_days": """
SELECT p_partkey, CAST(p_size AS BIGINT) + 100 AS p_size, NULL::VARCHAR AS p_brand,
       DATE '2001-08-01' AS ingest_date FROM part
UNION ALL SELECT p_partkey, NULL, p_brand, DATE '2001-08-02' FROM part""",
        "silver_audit": """SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
       '2001-08-01 06:00:00' AS _processed_at
FROM orders WHERE o_totalprice > 0 AND o_custkey IS NOT NULL""",
        "silver_incremental": f"""WITH {SILVER}
SELECT transaction_id, customer_id, amount, CAST(transaction_ts AS VARCHAR) AS transaction_ts,
       transaction_date FROM fct""",
        "scan_csv_as_found": """
WITH lines AS (
  SELECT *, concat(o_orderkey, ',"', o_orderpriority, ', ""x""', '",', o_orderstatus) AS line FROM orders)
SELECT o_orderkey AS order_no, CASE WHEN o_orderkey % 5 <> 1 THEN o_orderpriority || ', "x"' END AS priority,
       CASE WHEN o_orderkey % 5 = 2 THEN line END AS _malformed_line FROM lines""",
        "scan_json_array": "SELECT event_id, event_type, props FROM events",
        "format_guard": """
SELECT 'as_lines' AS source_name, (SELECT count(*) FROM events) AS row_count, 'success' AS status
UNION ALL SELECT 'as_csv', (SELECT count(*) FROM events), 'success'
UNION ALL SELECT 'as_xml', 0, 'failed'""",
        "registry_sources": """
SELECT 'product_catalog' AS source_name, 24.0::DOUBLE AS sla_hours, 'catalog-team' AS owner, 'one' AS tier,
       30::BIGINT AS retention_days, count(*) AS landed FROM part
UNION ALL SELECT 'web_events', NULL, 'analytics-team', NULL, 30, count(*) FROM events""",
        "retention_expire": """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS ingest_date FROM orders
WHERE o_orderdate >= DATE '1998-02-01'""",
        "scd2_stored_merge": f"WITH {_history(True)} SELECT {frame_columns} FROM history",
        "as_of_join": f"""WITH {_history(True)}
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(o_orderdate AS DATE) AS o_orderdate, h.segment, h.region
FROM orders LEFT JOIN history h
  ON CAST(o_custkey AS VARCHAR) = h.customer_id
 AND CAST(o_orderdate AS DATE) >= h.effective_from AND CAST(o_orderdate AS DATE) < h.effective_to""",
        "freshness_landed": f"""
WITH newest AS (SELECT 'web_events' AS source_name, 3.0::DOUBLE AS sla_hours,
                       {_age('2024-01-31 02:00:00', 'max(ts)')} AS age_seconds FROM events)
SELECT *, {_status('age_seconds', 'NULL', 'sla_hours')} AS status FROM newest""",
        "ingest_summary": """
SELECT 'product_catalog' AS source_name, (SELECT count(*) FROM part) AS row_count, 'success' AS status
UNION ALL SELECT 'web_events', (SELECT count(*) FROM events), 'success'
UNION ALL SELECT 'customer_master', 0, 'failed'""",
        "table_files_union": """
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, NULL::VARCHAR AS p_brand, 1::BIGINT AS batch FROM part
UNION ALL SELECT p_partkey, NULL, p_brand, 2 FROM part""",
        "export_roundtrip": "SELECT c_custkey, c_name, -c_acctbal AS c_acctbal FROM customer",
        "mart_materialization": f"""WITH {CLEAN_SILVER},{SNAPSHOTS},{_staging()}
SELECT region, count(transaction_id) AS transactions,
       {_money(_total('transaction_amount'))} AS revenue
FROM enriched GROUP BY region""",
        "retention_filter": f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ingest_date
FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '{AS_OF}' - INTERVAL 90 DAY""",
        "union_by_name": """SELECT c_custkey, c_name, c_acctbal, NULL::VARCHAR AS c_mktsegment FROM customer
UNION ALL SELECT c_custkey, NULL, NULL, c_mktsegment FROM customer""",
        "dq_transactions": f"WITH {SILVER},{RAW_FCT} {_both_transaction_tables()}",
        "dq_customer_360": f"""WITH {_c360_ctes(SILVER, 'fct')},
dirty AS (
  SELECT CASE WHEN region <> 'ASIA' THEN customer_id END AS customer_id,
         CASE WHEN region <> 'ASIA' THEN value_tier END AS value_tier,
         CASE WHEN region = 'EUROPE' THEN 'lost' ELSE engagement_status END AS engagement_status,
         -actual_lifetime_spend AS actual_lifetime_spend
  FROM c360)
{_rules('mart_customer_360', 'c360', CUSTOMER_360_RULES)} UNION ALL
{_rules('dirty_customer_360', 'dirty', CUSTOMER_360_RULES)}""",
        "dq_custom": _rules(
            "lineitem",
            "lineitem",
            [
                ("quantities sum above line count", "error", "sum(l_quantity) > count(*)"),
                ("mean discount at most five percent", "warn", "avg(l_discount) <= 0.05"),
                ("line numbers end at seven", "error", "max(l_linenumber) = 7"),
                ("shipping column known", "error", "count(*) < 0"),
            ],
        ),
        "dq_gate": f"""WITH {SILVER},{RAW_FCT},
rules AS ({_both_transaction_tables()})
SELECT table_name, count(*) FILTER (passed) AS passed,
       count(*) FILTER (NOT passed AND severity = 'error') AS failed,
       count(*) FILTER (NOT passed AND severity <> 'error') AS warnings,
       count(*) FILTER (NOT passed AND severity = 'error') = 0 AS success
FROM rules GROUP BY table_name""",
        "schema_tests": f"WITH {_c360_ctes(SILVER, 'fct')},{RAW_FCT} {_schema_test_rules()}",
        "test_unique": f"""WITH {BRONZE_TRANSACTIONS}
SELECT transaction_id, count(*) AS n_records FROM bronze_transactions
WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
        "test_not_null": f"""WITH {BRONZE_TRANSACTIONS}
SELECT transaction_id, customer_id, tie_break FROM bronze_transactions WHERE customer_id IS NULL""",
        "test_accepted_values": f"""WITH {_c360_ctes(SILVER, 'fct')},
partly AS (SELECT customer_id, CASE WHEN region = 'ASIA' THEN 'diamond' WHEN region <> 'AFRICA' THEN value_tier
           END AS value_tier FROM c360)
SELECT customer_id, value_tier FROM partly WHERE value_tier NOT IN ('platinum', 'gold', 'silver', 'bronze')""",
        "test_accepted_range": f"""WITH {SILVER}
SELECT transaction_id, amount, tie_break FROM typed WHERE NOT (amount >= 0)""",
        "freshness": f"""SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
       {events_age} AS age_seconds, {_status(events_age, '12', '24')} AS status FROM events""",
        "freshness_sla": f"""
WITH ages AS (
  SELECT 'customer_transactions' AS source_name, 6.0::DOUBLE AS sla_hours,
         {_age('2024-01-31 02:00:00', 'max(l_shipdate)')} AS age_seconds FROM lineitem
  UNION ALL
  SELECT 'web_events', 3.0::DOUBLE, {_age('2024-01-31 02:00:00', 'max(ts)')} FROM events)
SELECT *, {_status('age_seconds', 'NULL', 'sla_hours')} AS status FROM ages""",
    }


def _payload_records() -> str:
    return """
SELECT p_partkey, p_brand AS spec_p_brand, p_type AS spec_p_type,
       CASE WHEN p_partkey % 4 <> 2 THEN CAST(p_size AS BIGINT) END AS p_size, p_retailprice
FROM part
UNION ALL
SELECT p_partkey, p_brand, p_type, CAST(p_size AS BIGINT) + 100, p_retailprice
FROM part WHERE p_partkey % 4 = 0"""
