"""Projections of the benchmark tables onto the feed contracts of the warehouse.

Plain row-wise SQL that reads alike in Spark and in the checking database, so
both sides start from the same feeds. Irregular records (blank keys, wrong VAT,
duplicates, bad contacts, open downtimes ...) come from integer remainders.
``@table@`` stands for a benchmark table, other ``@...@`` marks for the few
places where dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from starloom.session import prepare

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

BATCH = "B20010801"
AS_OF = "2001-08-01"
FIRST_LOAD = "2001-07-01"
EVENTS_AS_OF = "2024-01-31"

SPARK_MARKS = {
    "@copies@": "LATERAL VIEW explode(CASE WHEN k % 53 = 0 THEN array(0, 1) ELSE array(0) END) c AS copy",
    "@loads@": "LATERAL VIEW explode(CASE WHEN k % 5 = 0 THEN array(0, 1) ELSE array(0) END) c AS copy",
}
CHECK_MARKS = {
    "@copies@": "CROSS JOIN UNNEST(CASE WHEN k % 53 = 0 THEN [0, 1] ELSE [0] END) AS c(copy)",
    "@loads@": "CROSS JOIN UNNEST(CASE WHEN k % 5 = 0 THEN [0, 1] ELSE [0] END) AS c(copy)",
}

_DIGITS8 = "lpad(CAST(k % 100000000 AS STRING), 8, '0')"

ORDERS = f"""
SELECT
  k * 2 + copy AS stg_record_id,
  TIMESTAMP '{AS_OF} 01:00:00' + INTERVAL '1' HOUR * copy AS stg_load_dt,
  '{BATCH}' AS stg_batch_id,
  'N' AS stg_record_status,
  'OMS' AS stg_source_system,
  CASE WHEN k % 97 = 0 THEN '' ELSE 'O' || CAST(k AS STRING) END AS order_id,
  '/productOrder/' || CAST(k AS STRING) AS order_href,
  'X' || CAST(k AS STRING) AS external_id,
  CASE WHEN k % 211 = 7 THEN '2030-01-15 08:00:00' ELSE CAST(ts AS STRING) END AS order_date,
  CAST(CAST(ts AS DATE) AS STRING) AS requested_start_date,
  CAST(CAST(ts + INTERVAL '5' DAY AS DATE) AS STRING) AS requested_completion_dt,
  CASE WHEN k % 43 = 0 THEN 'soon' ELSE CAST(CAST(ts + INTERVAL '7' DAY AS DATE) AS STRING) END
    AS expected_completion_dt,
  CASE WHEN st <> 'F' THEN CASE WHEN k % 2 = 0 THEN '' END
       WHEN k % 101 = 3 THEN CAST(ts - INTERVAL '3' DAY AS STRING)
       ELSE CAST(ts + INTERVAL '1' HOUR * (k % 40) + INTERVAL '10' MINUTE * (k % 7) AS STRING) END
    AS completion_date,
  CASE WHEN k % 103 = 5 THEN CAST(NULL AS STRING)
       WHEN st = 'F' THEN CASE k % 20 WHEN 0 THEN 'CANCEL' WHEN 1 THEN 'Failed' WHEN 2 THEN 'REJECT'
            WHEN 3 THEN 'COMPLETE' WHEN 4 THEN ' completed ' ELSE 'Completed' END
       WHEN st = 'O' THEN CASE k % 20 WHEN 3 THEN 'HOLD' WHEN 4 THEN '' WHEN 6 THEN 'ACK'
            WHEN 7 THEN 'acknowledged' ELSE 'inProgress' END
       ELSE CASE k % 50 WHEN 5 THEN 'PARTIAL' WHEN 6 THEN 'BOGUS' ELSE 'pending' END END
    AS order_state,
  substr(prio, 1, 1) AS priority,
  CASE k % 6 WHEN 0 THEN 'New' WHEN 1 THEN 'upgrade' WHEN 2 THEN 'DOWNGRADE' WHEN 3 THEN 'terminate'
       WHEN 4 THEN ' SUSPEND' ELSE 'other' END AS category,
  CASE WHEN k % 20 = 0 THEN 'customer request' END AS cancellation_reason,
  CASE k % 5 WHEN 0 THEN '05' || {_DIGITS8} WHEN 1 THEN '9665' || {_DIGITS8}
       WHEN 2 THEN '+9665' || {_DIGITS8}
       WHEN 3 THEN 'user' || CAST(k AS STRING) || '@mail.example.com'
       ELSE CASE WHEN k % 25 = 4 THEN 'call me' ELSE '' END END AS notification_contact,
  CASE WHEN k % 12 = 11 AND k % 24 = 11 THEN 'RETAIL' END AS channel_id,
  CASE k % 12 WHEN 0 THEN 'MyApp' WHEN 1 THEN 'STC App' WHEN 2 THEN 'Jawwy' WHEN 3 THEN 'web'
       WHEN 4 THEN 'PORTAL' WHEN 5 THEN 'store' WHEN 6 THEN 'Retail' WHEN 7 THEN 'telesales'
       WHEN 8 THEN 'call center' WHEN 9 THEN 'B2B' WHEN 10 THEN 'partner' ELSE 'kiosk' END AS channel_name,
  'BA' || CAST(cust AS STRING) AS billing_account_id,
  CASE WHEN k % 67 = 1 THEN CAST(NULL AS STRING) WHEN k % 61 = 2 THEN 'CX' || CAST(k AS STRING)
       ELSE 'C' || CAST(cust AS STRING) END AS customer_id,
  CASE WHEN k % 47 = 0 THEN CAST(NULL AS STRING) ELSE 'S' || CAST(k % 120 AS STRING) END AS seller_id,
  CASE seg WHEN 'AUTOMOBILE' THEN ' enterprise ' WHEN 'BUILDING' THEN 'SMB' WHEN 'FURNITURE' THEN 'consumer'
       WHEN 'MACHINERY' THEN 'Government' END AS segment,
  CASE WHEN k % 41 = 0 THEN CAST(NULL AS STRING) ELSE 'N' || CAST(nat AS STRING) END AS region_code,
  CAST(k % 7 + 1 AS STRING) AS order_item_count,
  CASE WHEN k % 113 = 0 THEN 'n/a' WHEN k % 127 = 0 THEN CAST(NULL AS STRING)
       WHEN k % 89 = 4 THEN '-' || CAST(amount AS STRING)
       WHEN k % 131 = 0 THEN CAST(amount + 500000 AS STRING)
       ELSE CAST(amount AS STRING) END AS total_amount,
  CASE WHEN k % 19 = 0 THEN CAST(NULL AS STRING) WHEN k % 17 = 0 THEN '1.00'
       WHEN k % 131 = 0 THEN '0'
       ELSE CAST(CAST(floor((cents * 15 + 57) / 115.0) AS DECIMAL(18,0)) * 0.01 AS STRING) END
    AS vat_amount,
  CASE WHEN k % 3 = 0 THEN CAST(CAST(k % 500 AS DECIMAL(18,2)) AS STRING) END AS discount_amount
FROM (
  SELECT o.o_orderkey AS k, o.o_custkey AS cust, o.o_orderstatus AS st, o.o_orderpriority AS prio,
         o.o_orderdate + INTERVAL '1' MINUTE * (o.o_orderkey % 1440) AS ts,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents,
         c.c_mktsegment AS seg, c.c_nationkey AS nat
  FROM @orders@ o JOIN @customer@ c ON c.c_custkey = o.o_custkey
) b @copies@
"""

ITEMS = f"""
SELECT
  TIMESTAMP '{AS_OF} 01:00:00' AS stg_load_dt,
  '{BATCH}' AS stg_batch_id,
  'N' AS stg_record_status,
  'O' || CAST(l_orderkey AS STRING) AS order_id,
  CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)
    || '-' || CAST(CAST(l_quantity AS INT) AS STRING)
    AS order_item_id,
  CAST(CAST(l_quantity AS INT) AS STRING) AS item_quantity,
  CASE WHEN l_linestatus = 'O' THEN 'inProgress' WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'COMPLETED' END
    AS item_state,
  CASE l_linenumber % 5 WHEN 0 THEN 'add' WHEN 1 THEN 'modify' WHEN 2 THEN 'delete' WHEN 3 THEN 'noChange'
       ELSE 'swap' END AS action,
  CASE WHEN l_partkey % 71 = 3 THEN 'PX' ELSE 'P' END || CAST(l_partkey AS STRING) AS product_offering_id,
  'SP' || CAST(l_partkey % 50 AS STRING) AS product_spec_id,
  CASE WHEN l_linenumber % 2 = 0 THEN 'recurring' ELSE 'oneTime' END AS price_type,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING) AS price_amount,
  CASE WHEN l_tax > 0.04 THEN 'N' ELSE 'Y' END AS price_tax_included_flag,
  CASE WHEN l_linenumber = 7 THEN CAST(NULL AS STRING)
       ELSE CAST(CAST(floor(CAST(round(l_extendedprice * 100) AS BIGINT)
                      * CAST(round(l_discount * 100) AS BIGINT) / 100.0) AS DECIMAL(18,0)) * 0.01 AS STRING) END
    AS discount_amount,
  '05' || lpad(CAST((l_orderkey * 7 + l_linenumber) % 100000000 AS STRING), 8, '0') AS product_msisdn,
  CASE WHEN l_suppkey % 2 = 0 THEN 'ESIM' ELSE 'PHYSICAL' END AS product_sim_type,
  CASE l_linenumber % 3 WHEN 0 THEN '12' WHEN 1 THEN '24' END AS product_contract_months,
  'CITY' || CAST(l_suppkey % 25 AS STRING) AS shipping_city,
  CASE WHEN l_suppkey % 30 < 25 THEN 'N' || CAST(l_suppkey % 30 AS STRING) END AS shipping_region,
  CASE WHEN l_partkey % 10 = 0 THEN '12345' END AS shipping_postcode,
  CASE l_partkey % 4 WHEN 0 THEN '5G' WHEN 1 THEN '4G' WHEN 2 THEN 'fiber' END AS technology_tier,
  CASE WHEN l_partkey % 5 = 0 THEN 'true' ELSE 'false' END AS is_bundle,
  CASE WHEN l_partkey % 4 = 0 THEN 'true' ELSE 'false' END AS is_5g
FROM @lineitem@
"""

EVENTS = f"""
SELECT
  event_id AS stg_record_id,
  '{BATCH}' AS stg_batch_id,
  'N' AS stg_record_status,
  'O' || CAST(user_id * 16 + event_id % 16 AS STRING) AS order_id,
  CAST(NULL AS STRING) AS order_item_id,
  CASE event_id % 6 WHEN 0 THEN 'ACK' WHEN 1 THEN 'pending' WHEN 2 THEN 'IN_PROGRESS' WHEN 3 THEN 'Hold'
       WHEN 4 THEN 'bogus' END AS from_state,
  CASE event_type WHEN 'view' THEN 'ACK' WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'inProgress'
       WHEN 'error' THEN 'FAIL' ELSE 'completed' END AS to_state,
  CAST(date_trunc('second', ts) AS STRING) AS event_timestamp,
  CASE WHEN event_type = 'error' THEN 'R' || CAST(event_id % 2 AS STRING)
       WHEN event_id % 3 = 0 THEN 'OK' END AS change_reason_code,
  CASE WHEN event_type = 'error' THEN 'reason ' || CAST(event_id % 2 AS STRING) END AS change_reason_desc,
  CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS STRING) ELSE 'S' || CAST(user_id % 50 AS STRING) END
    AS changed_by_user_id,
  CASE event_id % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS is_automated_change,
  CASE WHEN event_id % 2 = 0 THEN 'OMS' ELSE 'CRM' END AS event_source
FROM @events@
"""


def _customers(snapshot: int) -> str:
    moved = "c_custkey % 7 = 0" if snapshot == 2 else "1 = 0"
    risk = "+ 1" if snapshot == 2 else ""
    present = "c_custkey % 29 <> 5" if snapshot == 2 else "c_custkey % 23 <> 4"
    return f"""
SELECT
  'C' || CAST(c_custkey AS STRING) AS customer_id,
  CASE c_custkey % 6 WHEN 0 THEN 'SMB' WHEN 1 THEN 'ENTERPRISE' WHEN 2 THEN 'GOV' WHEN 3 THEN CAST(NULL AS STRING)
       ELSE 'INDIVIDUAL' END AS customer_type,
  CASE WHEN c_custkey % 31 = 0 THEN '99' WHEN c_custkey % 37 = 0 THEN ''
       ELSE CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END || lpad(CAST(c_custkey AS STRING), 9, '0') END
    AS national_id,
  'SAU' AS nationality_code,
  CASE WHEN c_acctbal > 5000 THEN 'A1' WHEN c_acctbal > 0 THEN 'B1' END AS credit_rating,
  CASE WHEN {moved} THEN 'VIP' ELSE
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'PLATINUM' WHEN 'BUILDING' THEN 'GOLD' WHEN 'FURNITURE' THEN 'SILVER'
         WHEN 'HOUSEHOLD' THEN 'BRONZE' ELSE 'NEW' END END AS customer_segment,
  CASE WHEN c_acctbal > 5000 THEN 'HIGH' WHEN c_acctbal > 1000 THEN 'MID' ELSE 'LOW' END AS lifetime_value_tier,
  'CITY' || CAST(c_nationkey AS STRING) AS city,
  'N' || CAST(c_nationkey AS STRING) AS region,
  lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS postal_code,
  CASE WHEN c_custkey % 3 = 0 THEN 'EN' END AS preferred_language,
  '2019-0' || CAST(c_custkey % 9 + 1 AS STRING) || '-15' AS activation_date,
  '0.' || lpad(CAST((c_custkey % 97 {risk if snapshot == 2 else ''}) AS STRING), 4, '0') AS churn_risk_score
FROM @customer@ WHERE {present}
"""


def _offerings(snapshot: int) -> str:
    renamed = "p_partkey % 7 = 0" if snapshot == 2 else "1 = 0"
    present = "p_partkey % 13 <> 6" if snapshot == 2 else "p_partkey % 17 <> 5"
    return f"""
SELECT
  'P' || CAST(p_partkey AS STRING) AS product_offering_id,
  p_name || CASE WHEN {renamed} THEN ' plus' ELSE '' END AS product_offering_name,
  'offer ' || p_name AS product_offering_desc,
  'SP' || CAST(p_partkey % 50 AS STRING) AS product_spec_id,
  p_brand AS product_spec_name,
  CASE p_type WHEN 'PROMO' THEN '5g' WHEN 'ECONOMY' THEN 'MOBILE' WHEN 'STANDARD' THEN 'fiber' WHEN 'LARGE' THEN 'IoT'
       WHEN 'MEDIUM' THEN ' bundle ' ELSE 'device' END AS product_type,
  CASE p_size % 3 WHEN 0 THEN 'prepaid' WHEN 1 THEN 'postpaid' ELSE 'b2b' END AS product_category,
  p_brand AS product_family,
  CASE p_type WHEN 'PROMO' THEN '5g' WHEN 'STANDARD' THEN 'Fiber' ELSE '4g' END AS technology_tier,
  CASE WHEN p_type = 'PROMO' THEN 'Y' ELSE 'N' END AS is_5g,
  CASE WHEN p_size % 5 = 0 THEN 'Y' ELSE 'N' END AS is_bundle,
  CASE p_size % 3 WHEN 0 THEN '12' WHEN 1 THEN '24' END AS contract_duration,
  '2020-01-01' AS launch_date,
  CASE WHEN p_partkey % 19 = 0 THEN '2025-12-31' END AS end_of_sale_date,
  CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS STRING) AS base_price,
  CASE WHEN p_partkey % 3 = 0 THEN 'SAR' END AS currency
FROM @part@ WHERE {present}
"""


GEOGRAPHY = """
SELECT 'N' || CAST(n_nationkey AS STRING) AS geography_bk,
       'SAU' AS country_cd,
       r_name AS admin_region_cd, r_name AS admin_region_nm_en, r_name AS admin_region_nm_ar,
       'G' || CAST(n_nationkey AS STRING) AS governorate_cd,
       'CITY' || CAST(n_nationkey AS STRING) AS city_cd, n_name AS city_nm_en,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END AS has_5g_coverage,
       CASE WHEN n_nationkey % 3 = 0 THEN 'Y' ELSE 'N' END AS has_fiber_coverage
FROM @nation@ JOIN @region@ ON r_regionkey = n_regionkey
"""

PARTIES = """
SELECT 'S' || CAST(s_suppkey AS STRING) AS party_bk,
       CASE WHEN s_suppkey % 8 = 7 THEN 'requester' ELSE 'seller' END AS party_role_cd,
       'INDIVIDUAL' AS party_type_cd,
       s_name AS party_name,
       CASE WHEN s_suppkey % 9 <> 0 THEN 'AG' || CAST(s_suppkey AS STRING) END AS agent_id,
       'ST' || CAST(s_nationkey AS STRING) AS agent_store_cd,
       CAST(NULL AS STRING) AS department_cd
FROM @supplier@
"""

PAYLOADS = """
SELECT 'O' || CAST(o_orderkey AS STRING) AS order_id,
       '{"id":"O' || CAST(o_orderkey AS STRING) || '","productOrderItem":['
       || '{"id":"1","quantity":"' || CAST(o_orderkey % 9 + 1 AS STRING) || '","state":"pending","action":"add",'
       || '"productOffering":{"id":"P' || CAST(o_orderkey % 200 AS STRING) || '"},'
       || '"product":{"productSpecification":{"id":"SP1"}},'
       || '"itemPrice":[{"priceType":"recurring","price":{"taxIncludedAmount":{"value":"'
       || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) || '","unit":"SAR"}}}]}'
       || CASE WHEN o_orderkey % 2 = 0 THEN ',{"id":"2","quantity":"1","state":"held","action":"delete"}' ELSE '' END
       || ']}' AS raw_json_payload
FROM @orders@
"""

# Charges of the billing system for completed orders: some missing, some off.
BILLING = """
SELECT 'O' || CAST(o_orderkey AS STRING) AS order_id,
       CAST(o_totalprice AS DECIMAL(18,2))
         + CASE o_orderkey % 10 WHEN 1 THEN CAST(25 AS DECIMAL(18,2)) WHEN 2 THEN CAST(-40 AS DECIMAL(18,2))
                WHEN 3 THEN CAST(0.5 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS billed_amount,
       CAST(floor((CAST(round(o_totalprice * 100) AS BIGINT) * 15 + 57) / 115.0) AS DECIMAL(18,0)) * 0.01 AS billed_vat
FROM @orders@ WHERE o_orderkey % 14 <> 9
"""

# On every third day no reading is irregular, so some days pass the gate and some are halted.
WELL_READINGS = """
SELECT CASE WHEN event_id % 97 = 5 AND day(ts) % 3 <> 0 THEN CAST(NULL AS STRING) ELSE 'W' || CAST(user_id AS STRING) END AS well_id,
       'F' || CAST(user_id % 10 AS STRING) AS field_id,
       ts AS reading_ts,
       CASE WHEN event_id % 89 = 3 AND day(ts) % 3 <> 0 THEN -value WHEN event_id % 79 = 1 AND day(ts) % 3 <> 0 THEN CAST(NULL AS DOUBLE)
            ELSE value END AS oil_rate_bopd,
       value * 2.5e0 AS gas_rate_mscfd,
       value * 0.5e0 AS water_rate_bwpd,
       CASE WHEN event_id % 83 = 2 THEN 20000e0 ELSE value * 10e0 END AS tubing_pressure_psi,
       CASE WHEN event_type = 'error' THEN 'SHUT_IN' ELSE 'PRODUCING' END AS well_status_code,
       CAST(ts AS DATE) AS _business_date
FROM @events@
"""

FLOW_READINGS = """
SELECT CASE WHEN event_id % 499 = 5 THEN CAST(NULL AS STRING) ELSE 'SEG' || CAST(user_id % 25 AS STRING) END
         AS pipeline_segment_id,
       ts AS reading_ts,
       CASE WHEN event_id % 151 = 3 THEN -value ELSE value * 100e0 END AS flow_rate_bpd,
       value * 7e0 AS line_pressure_psi,
       CAST(ts AS DATE) AS _business_date
FROM @events@
"""

ALARMS = """
SELECT 'SEG' || CAST(user_id % 25 AS STRING) AS pipeline_segment_id, ts AS alarm_ts, 'LEAK' AS alarm_type,
       CASE WHEN event_id % 4 = 0 THEN 'CRITICAL' ELSE 'MINOR' END AS severity,
       CAST(ts AS DATE) AS _business_date
FROM @events@ WHERE event_type = 'error'
"""


def _assets(snapshot: int) -> str:
    moved = "k % 6 = 0" if snapshot == 2 else "1 = 0"
    present = "s_suppkey % 11 <> 2" if snapshot == 1 else "s_suppkey % 13 <> 3"
    return f"""
SELECT 'A' || CAST(k AS STRING) AS asset_id,
       s_name || CASE WHEN copy = 1 THEN ' rev' ELSE '' END AS asset_description,
       CASE WHEN k % 2 = 0 THEN 'PUMP' ELSE 'VALVE' END AS asset_type,
       'FAC' || CAST(k % 12 AS STRING) AS facility_id,
       'LOC' || CAST(nat AS STRING) AS location_code,
       CASE WHEN k % 4 = 0 THEN CAST(NULL AS STRING) ELSE 'MAKER' || CAST(k % 5 AS STRING) END AS manufacturer,
       DATE '2015-01-01' AS install_date,
       CASE WHEN k % 3 = 0 THEN 'HIGH' ELSE 'LOW' END AS criticality_rank,
       CAST(NULL AS STRING) AS parent_asset_id,
       CASE WHEN {moved} THEN 'INACTIVE' ELSE 'ACTIVE' END AS record_status,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * copy AS last_modified_ts
FROM (SELECT s_suppkey AS k, s_name, s_nationkey AS nat FROM @supplier@ WHERE {present}) b @loads@
"""


DOWNTIME = """
SELECT CASE WHEN o_orderkey % 59 = 0 THEN CAST(NULL AS STRING) ELSE 'A' || CAST(o_orderkey % 120 AS STRING) END
         AS asset_id,
       ts AS downtime_start_ts,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 101 = 1 THEN ts - INTERVAL '2' HOUR
            ELSE ts + INTERVAL '1' HOUR * (o_orderkey % 50) + INTERVAL '15' MINUTE * (o_orderkey % 4) END
         AS downtime_end_ts,
       'R' || CAST(o_orderkey % 5 AS STRING) AS downtime_reason_code,
       'WO' || CAST(o_orderkey AS STRING) AS linked_work_order_id,
       CAST(ts AS DATE) AS _business_date
FROM (SELECT o_orderkey, o_orderdate + INTERVAL '23' YEAR + INTERVAL '1' HOUR * (o_orderkey % 24) AS ts FROM @orders@) b
"""

WORK_ORDERS = """
SELECT CASE WHEN l_orderkey % 499 = 5 THEN CAST(NULL AS STRING)
            ELSE 'WO' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
                 || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) END AS work_order_id,
       CASE WHEN l_partkey % 83 = 0 THEN CAST(NULL AS STRING) ELSE 'A' || CAST(l_suppkey AS STRING) END AS asset_id,
       CASE WHEN l_linenumber % 2 = 0 THEN 'PM' ELSE 'CM' END AS work_type,
       CAST(l_linenumber AS STRING) AS priority,
       CASE WHEN l_linestatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS status,
       ts AS scheduled_start_ts,
       ts + INTERVAL '3' HOUR * l_linenumber AS actual_start_ts,
       CASE WHEN l_linestatus = 'F' THEN ts + INTERVAL '3' HOUR * l_linenumber + INTERVAL '30' MINUTE * (l_partkey % 9) END
         AS actual_finish_ts,
       CASE WHEN l_partkey % 61 = 0 THEN -1e0 WHEN l_suppkey % 12 = 5 THEN l_quantity * 40000e0 ELSE l_quantity END AS labor_hours,
       l_extendedprice AS material_cost_usd,
       CASE WHEN l_linenumber = 3 THEN CAST(NULL AS STRING) ELSE 'CR' || CAST(l_suppkey % 20 AS STRING) END AS assigned_crew_id,
       CAST(ts AS DATE) AS _business_date
FROM (SELECT *, l_shipdate + INTERVAL '23' YEAR AS ts FROM @lineitem@) b
"""

ASSAYS = """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN CAST(NULL AS STRING) ELSE 'RF' || CAST(l_suppkey % 25 AS STRING) END AS refinery_id,
       l_quantity + 10e0 AS api_gravity, l_discount * 10e0 AS sulfur_content_pct,
       CAST(l_shipdate + INTERVAL '23' YEAR AS DATE) AS _business_date
FROM @lineitem@
"""

QUALITY_TESTS = """
SELECT CASE WHEN l_orderkey % 97 = 1 THEN CAST(NULL AS STRING) ELSE 'RF' || CAST(l_suppkey % 25 AS STRING) END AS refinery_id,
       CASE WHEN l_orderkey % 89 = 0 AND day(l_shipdate) % 2 = 0 THEN CAST(NULL AS STRING) ELSE
         CASE l_partkey % 5 WHEN 0 THEN 'GASOLINE-91' WHEN 1 THEN 'DIESEL-S' WHEN 2 THEN 'JET-A1' WHEN 3 THEN 'LPG'
              ELSE 'FUEL-OIL' END END AS product_code,
       CASE l_returnflag WHEN 'R' THEN 'FAIL' WHEN 'N' THEN 'PASS' ELSE
         CASE WHEN l_linenumber % 2 = 0 THEN 'PASS' END END AS pass_fail_flag,
       CAST(l_shipdate + INTERVAL '23' YEAR AS DATE) AS _business_date
FROM @lineitem@
"""

INCIDENTS = """
SELECT CASE WHEN o_orderkey % 997 = 1 THEN CAST(NULL AS STRING) ELSE 'I' || CAST(o_orderkey AS STRING) END AS incident_id,
       CASE WHEN o_orderkey % 499 = 3 THEN CAST(NULL AS STRING) ELSE 'FAC' || CAST(o_custkey % 12 AS STRING) END AS facility_id,
       CASE WHEN o_orderkey % 4 = 0 THEN 'LTI' ELSE 'FIRST_AID' END AS incident_type,
       'S' || CAST(o_orderkey % 3 AS STRING) AS severity_rank,
       CASE WHEN o_orderkey % 53 = 0 THEN -1 WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS INT) END AS lost_workdays,
       CASE WHEN o_orderkey % 6 = 5 THEN CAST(NULL AS STRING) WHEN o_orderkey % 9 = 0 THEN 'CR' || CAST(o_custkey % 20 AS STRING)
            ELSE 'E' || CAST(o_custkey % 40 AS STRING) END AS involved_employee_id,
       CAST(o_orderdate + INTERVAL '23' YEAR AS DATE) AS _business_date
FROM @orders@
"""

COST_ACTUALS = """
SELECT cost_center_code, fiscal_year, fiscal_period, cost_element_code,
       CAST(sum(amount) AS DECIMAL(18,2)) AS actual_amount_usd,
       CAST(sum(CASE WHEN o_orderkey % 10 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount END) AS DECIMAL(18,2)) AS budget_amount_usd
FROM (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'UP-100' WHEN 'BUILDING' THEN 'MS-200' WHEN 'FURNITURE' THEN 'DS-300'
              WHEN 'HOUSEHOLD' THEN 'UP-110' ELSE CASE WHEN o_orderkey % 71 = 0 AND month(o_orderdate) % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'XX-400' END END
           AS cost_center_code,
         CAST(year(o_orderdate) + 23 AS INT) AS fiscal_year,
         CAST(month(o_orderdate) AS INT) AS fiscal_period,
         'CE' || CAST(o_custkey % 3 AS STRING) AS cost_element_code
  FROM @orders@ JOIN @customer@ ON c_custkey = o_custkey
) b
GROUP BY cost_center_code, fiscal_year, fiscal_period, cost_element_code
"""

CONTRACTS = {
    "stg_orders": ORDERS, "stg_items": ITEMS, "stg_events": EVENTS,
    "stg_customers_1": _customers(1), "stg_customers_2": _customers(2),
    "stg_offerings_1": _offerings(1), "stg_offerings_2": _offerings(2),
    "ref_geography": GEOGRAPHY, "ref_parties": PARTIES, "raw_payloads": PAYLOADS, "billing": BILLING,
    "well_readings": WELL_READINGS, "flow_readings": FLOW_READINGS, "alarms": ALARMS,
    "assets_1": _assets(1), "assets_2": _assets(2), "downtime": DOWNTIME, "work_orders": WORK_ORDERS,
    "assays": ASSAYS, "quality_tests": QUALITY_TESTS, "incidents": INCIDENTS, "cost_actuals": COST_ACTUALS,
}


def contract(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feed as a lazily evaluated frame over the parquet tables."""
    prepare(spark)
    sql = CONTRACTS[name]
    for mark, text in SPARK_MARKS.items():
        sql = sql.replace(mark, text)
    # the benchmark keeps zone-less timestamps; literals have to match
    sql = re.sub(r"\bTIMESTAMP '", "TIMESTAMP_NTZ '", sql)

    def source(mark: re.Match) -> str:
        path = f"{sf_dir.rstrip('/')}/{mark.group(1)}.parquet"
        return f"parquet.`{path}`"

    return spark.sql(re.sub(r"@(\w+)@", source, sql))


def check_sql(name: str) -> str:
    """The same feed for the checking database."""
    sql = CONTRACTS[name]
    for mark, text in CHECK_MARKS.items():
        sql = sql.replace(mark, text)
    return re.sub(r"@(\w+)@", r"\1", sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
