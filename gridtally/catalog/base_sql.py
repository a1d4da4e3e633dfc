"""Common table expressions for the SQL side: the sample tables as domain tables."""

READINGS = """readings AS (
  SELECT event_id AS reading_no,
    'METER-' || printf('%06d', user_id) AS meter_id,
    'MAC' || printf('%06d', user_id) AS household_id,
    CASE WHEN event_type = 'signup' AND value < 1 THEN NULL
      ELSE time_bucket(INTERVAL '30 minutes', ts) END AS event_timestamp,
    CASE WHEN event_type <> 'error' THEN value END AS consumption_kwh,
    CASE WHEN event_type IN ('view', 'click') THEN 'Std'
      WHEN event_type IN ('purchase', 'signup') THEN 'ToU' END AS stdor_to_u,
    'uk_power_networks' AS source_system,
    ts AS received_at
  FROM events)"""

FLAGGED = """flagged AS (
  SELECT *, is_complete AND is_valid AND is_unique AS is_good FROM (
    SELECT *,
      meter_id IS NOT NULL AND event_timestamp IS NOT NULL AS is_complete,
      coalesce(consumption_kwh >= 0 AND consumption_kwh <= 100, false) AS is_valid,
      row_number() OVER (PARTITION BY meter_id, event_timestamp ORDER BY reading_no) = 1 AS is_unique
    FROM readings))"""

GOLD = """gold AS (
  SELECT meter_id, household_id, event_timestamp, consumption_kwh, stdor_to_u, source_system, reading_no
  FROM flagged WHERE is_good)"""

GOLD_CHAIN = [READINGS, FLAGGED, GOLD]

KEY60 = "CAST('0x' || substr(md5({0}), 1, 15) AS BIGINT)"

CUSTOMERS = """customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_number,
    'Customer' AS first_name, substr(c_name, 10, 20) AS last_name,
    CASE WHEN c_acctbal > -900 THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
    CASE WHEN c_acctbal >= 0 THEN '+44' || printf('%010d', c_custkey) END AS phone,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'COMMERCIAL' WHEN 'MACHINERY' THEN 'INDUSTRIAL'
      WHEN 'AUTOMOBILE' THEN ' industrial ' WHEN 'HOUSEHOLD' THEN 'RESIDENTIAL'
      WHEN 'FURNITURE' THEN 'residential' END AS customer_type,
    DATE '1950-01-01' + c_nationkey * 365 AS date_of_birth,
    CASE WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
    TIMESTAMP '2010-01-01' AS created_at,
    TIMESTAMP '2010-01-01' + to_days(c_nationkey - 2) AS updated_at
  FROM customer)"""

ACCOUNTS = """accounts AS (
  SELECT 'ACC-' || c_custkey AS account_id, c_name AS account_number, CAST(c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' WHEN c_acctbal > 9000 THEN 'CLOSED' ELSE 'ACTIVE' END AS account_status,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'QUARTERLY' WHEN 'MACHINERY' THEN 'ANNUAL'
      WHEN 'FURNITURE' THEN 'WEEKLY' ELSE 'MONTHLY' END AS billing_cycle,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'BANK_TRANSFER' WHEN 'MACHINERY' THEN 'CHEQUE'
      WHEN 'AUTOMOBILE' THEN 'CREDIT_CARD' ELSE 'DIRECT_DEBIT' END AS payment_method
  FROM customer)"""

CONTRACTS = """contracts AS (
  SELECT 'CTR-' || c_custkey AS contract_id, 'ACC-' || c_custkey AS account_id, c_mktsegment || '-FLAT' AS tariff_code,
    CASE WHEN c_nationkey < 10 THEN 'ELECTRICITY' WHEN c_nationkey < 20 THEN 'GAS' ELSE 'WATER' END AS commodity_type,
    DATE '1995-01-01' + c_nationkey * 30 AS start_date,
    CASE WHEN c_acctbal < 0 THEN DATE '1995-01-01' + c_nationkey * 30 - 1
      WHEN c_acctbal > 9000 THEN DATE '1995-01-01' + c_nationkey * 30 + 900 END AS end_date,
    CASE WHEN c_acctbal < 0 THEN 'TERMINATED' WHEN c_acctbal > 9000 THEN 'EXPIRED' ELSE 'ACTIVE' END AS contract_status
  FROM customer)"""

SERVICE_POINTS = """service_points AS (
  SELECT 'SP-' || p_partkey AS service_point_id, 'CTR-' || p_partkey AS contract_id,
    CASE WHEN p_size < 10 THEN 'ELECTRICITY' WHEN p_size < 20 THEN 'GAS' ELSE 'WATER' END AS commodity_type,
    p_brand AS grid_zone
  FROM part)"""

METERS = """meters AS (
  SELECT 'M-' || p_partkey AS meter_id, 'SP-' || p_partkey AS service_point_id,
    p_name || '/' || p_brand || '/' || p_type AS meter_serial_number,
    CASE WHEN p_size < 17 THEN 'AMI' WHEN p_size < 34 THEN 'AMR' ELSE 'MANUAL' END AS meter_type,
    CASE WHEN p_size < 25 THEN 'ELECTRICITY' ELSE 'GAS' END AS commodity_type,
    CASE WHEN p_size < 30 THEN 'ACTIVE' WHEN p_size < 40 THEN 'INACTIVE' ELSE 'DECOMMISSIONED' END AS status,
    DATE '1994-06-01' + p_size * 20 AS installation_date,
    CASE WHEN p_size BETWEEN 40 AND 45 THEN DATE '1994-06-01' + p_size * 20 + 100
      WHEN p_size BETWEEN 30 AND 31 THEN DATE '1994-06-01' + p_size * 20 - 5 END AS decommission_date,
    CAST(p_size - 1 AS DECIMAL(10,4)) AS multiplier
  FROM part)"""

OPS_READINGS = """ops_readings AS (
  SELECT l_orderkey || '-' || l_linenumber AS reading_id, 'M-' || l_partkey AS meter_id,
    l_quantity AS reading_value, 'kWh' AS unit, l_shipdate AS reading_timestamp,
    CASE l_returnflag WHEN 'N' THEN 'INTERVAL' WHEN 'A' THEN 'MANUAL' WHEN 'R' THEN 'CUMULATIVE' END AS reading_type,
    CASE l_linestatus WHEN 'F' THEN 'VALID' WHEN 'O' THEN 'UNKNOWN' END AS quality_flag
  FROM lineitem)"""

BILLS = """bills AS (
  SELECT 'B-' || o_orderkey AS bill_id, 'ACC-' || o_custkey AS account_id, 'CTR-' || o_custkey AS contract_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CAST(o_orderdate AS DATE) AS bill_date, CAST(o_orderdate AS DATE) + 21 AS due_date,
    CAST(o_orderdate AS DATE) - 30 AS period_start, CAST(o_orderdate AS DATE) - 1 AS period_end,
    CAST(o_totalprice AS DECIMAL(12,4)) AS total_amount,
    CASE WHEN o_orderstatus = 'F' THEN 'PAID' WHEN o_orderstatus = 'O' THEN 'ISSUED'
      WHEN o_orderpriority = '1-URGENT' THEN 'DISPUTED' WHEN o_orderpriority = '5-LOW' THEN 'CANCELLED'
      ELSE 'OVERDUE' END AS bill_status
  FROM orders)"""

PAYMENTS = """payments AS (
  SELECT l_orderkey || '-' || l_linenumber AS payment_id, 'B-' || l_orderkey AS bill_id,
    CAST(l_extendedprice AS DECIMAL(12,4)) AS amount,
    CASE WHEN l_linenumber <= 2 THEN 'CREDIT_CARD' WHEN l_linenumber <= 4 THEN 'DIRECT_DEBIT'
      ELSE 'BANK_TRANSFER' END AS payment_method,
    CASE l_returnflag WHEN 'N' THEN 'CLEARED' WHEN 'A' THEN 'FAILED' WHEN 'R' THEN 'REVERSED' END AS payment_status,
    l_shipdate AS payment_date,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_shipdate + INTERVAL 2 DAY END AS settled_at
  FROM lineitem)"""

OWNED_PAYMENTS = """owned_payments AS (
  SELECT p.*, b.account_id, b.customer_id FROM payments p JOIN bills b ON p.bill_id = b.bill_id)"""

CUSTOMER_CHANGES = """customer_changes AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
    'c' || o_custkey || '@' || lower(o_orderstatus) || '.example' AS email,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN substr(o_orderpriority, 1, 1) END AS phone,
    CASE o_orderstatus WHEN 'F' THEN 'COMMERCIAL' WHEN 'O' THEN 'RESIDENTIAL' ELSE 'INDUSTRIAL' END AS customer_type,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'DELETE'
      WHEN o_orderstatus = 'F' THEN 'INSERT' ELSE 'UPDATE' END AS operation,
    o_orderdate AS event_timestamp, o_orderkey AS change_no
  FROM orders)"""

RUN_EVENTS = """run_events AS (
  SELECT o_orderkey AS run_id, 'RUNNING' AS status, o_orderdate AS event_time, CAST(0 AS BIGINT) AS rows_received,
    'start' AS event_id FROM orders
  UNION ALL
  SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'FAILED' WHEN 'R' THEN 'RUNNING' WHEN 'N' THEN 'SUCCESS' END,
    l_shipdate, CAST(l_quantity AS BIGINT),
    l_linenumber || '/' || l_returnflag || '/' || printf('%08d', CAST(l_quantity AS BIGINT)) FROM lineitem)"""

RUNS = """runs AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS source,
    CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' WHEN 'P' THEN 'RUNNING' END AS status,
    o_orderdate AS started_at, CAST(trunc(o_totalprice) AS BIGINT) AS rows_received
  FROM orders)"""

NUMBER = "CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END"

# What normalizing each change line must give, stated from the events themselves.
CHANGES = f"""changes AS (
  SELECT 'datastream_postgres' AS source_system,
    CASE event_type WHEN 'signup' THEN 'customers' WHEN 'view' THEN 'meter_readings'
      WHEN 'click' THEN 'meters' WHEN 'purchase' THEN 'payments' END AS source_table,
    CASE WHEN value < 5 THEN 'INSERT' WHEN value < 50 THEN 'UPDATE' ELSE 'DELETE' END AS operation,
    CASE event_type WHEN 'signup' THEN 'C' || user_id WHEN 'view' THEN CAST(event_id AS VARCHAR)
      WHEN 'click' THEN 'M-' || user_id WHEN 'purchase' THEN 'P' || event_id END AS source_primary_key,
    CASE WHEN event_type = 'click' THEN TIMESTAMP '2026-01-01' ELSE date_trunc('second', ts) END AS event_timestamp,
    TIMESTAMP '2026-01-01' AS ingestion_timestamp, '1.0' AS schema_version,
    CASE event_type
      WHEN 'signup' THEN '{{"customer_id":"C' || user_id || '","account_id":"ACC-' || user_id || '","status":"ACTIVE"}}'
      WHEN 'view' THEN '{{"reading_id":"' || event_id || '","meter_id":"M-' || user_id || '","reading_value":' || {NUMBER}
        || ',"unit_of_measure":"kWh","reading_type":"INTERVAL","quality_flag":"VALID","read_at":"'
        || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"}}'
      WHEN 'click' THEN '{{"meter_id":"M-' || user_id || '","status":"'
        || CASE WHEN value < 20 THEN 'ACTIVE' ELSE 'INACTIVE' END || '"}}'
      WHEN 'purchase' THEN '{{"payment_id":"P' || event_id || '","account_id":"ACC-' || user_id || '","amount":' || {NUMBER} || '}}'
    END AS payload
  FROM events WHERE event_type <> 'error')"""

CHANGE_COLUMNS = (
    "source_system, source_table, operation, source_primary_key, event_timestamp, ingestion_timestamp, "
    "schema_version, payload"
)
