"""Checking SQL of single operators, readers, sinks and the stream."""

from __future__ import annotations

from oracle.compose import compose
from oracle.orders import STEPS

_BATCH = "CASE WHEN coalesce(TRY_CAST(substr(order_id, 2) AS BIGINT), 0) % 2 = 0 THEN 'A' ELSE 'B' END"
_ORDER = "coalesce(TRY_CAST(substr(order_id, 2) AS BIGINT), 0)"
_FLOW = """SELECT *, CASE WHEN pipeline_segment_id IS NULL THEN 'PIPE-01' WHEN NOT coalesce(flow_rate_bpd >= 0, FALSE) THEN 'PIPE-02' END AS bad, run, stamp
 FROM flow_readings CROSS JOIN (VALUES ('r1', TIMESTAMP '2024-02-01 02:00:00'), ('r2', TIMESTAMP '2024-02-01 03:00:00')) v(run, stamp)
 WHERE run = 'r1' OR flow_rate_bpd >= 0"""

FINAL: dict[str, str] = {
    "surrogate_keys": "SELECT order_id, order_item_id, item_quantity, 1000 + row_number() OVER (ORDER BY order_id, order_item_id) AS item_sk FROM stg_items",
    "previous_event_per_order": """
SELECT order_id, event_timestamp, stg_record_id, lag(event_timestamp) OVER (PARTITION BY order_id ORDER BY event_timestamp, stg_record_id) AS previous_timestamp FROM stg_events""",
    "running_spend_per_customer": """
SELECT o_custkey, o_orderkey, (sum(o_totalprice::DECIMAL(18,2)) OVER w)::DOUBLE AS running_spend, row_number() OVER w AS seq FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
    "latest_copy_per_order": """
SELECT order_id, stg_load_dt, stg_record_id, total_amount FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY stg_load_dt DESC, stg_record_id DESC) AS rn
 FROM stg_orders WHERE order_id <> '') q WHERE rn = 1""",
    "scd1_upsert_customers": """
SELECT customer_id, coalesce(n.customer_segment, o.customer_segment) AS customer_segment, coalesce(n.churn_risk_score, o.churn_risk_score) AS churn_risk_score,
 CASE WHEN o.customer_id IS NOT NULL THEN row_number() OVER (PARTITION BY o.customer_id IS NULL ORDER BY customer_id)
      ELSE (SELECT count(*) FROM stg_customers_1) + row_number() OVER (PARTITION BY o.customer_id IS NULL ORDER BY customer_id) END AS sk
FROM stg_customers_1 o FULL JOIN stg_customers_2 n USING (customer_id)""",
    "ingest_json_incidents": """
SELECT incident_id, facility_id, incident_type, severity_rank, lost_workdays, involved_employee_id, DATE '2024-01-31' AS _business_date, 'again' AS _ingestion_run_id FROM incidents""",
    "ingest_csv_downtime": """
SELECT asset_id, downtime_start_ts, downtime_end_ts, downtime_reason_code, linked_work_order_id, DATE '2024-01-31' AS _business_date, 'again' AS _ingestion_run_id FROM downtime""",
    "ingest_parquet_cost_actuals": """
SELECT cost_center_code, fiscal_year, fiscal_period, cost_element_code, actual_amount_usd::DOUBLE AS actual_amount_usd, budget_amount_usd::DOUBLE AS budget_amount_usd,
 DATE '2024-01-31' AS _business_date, 'again' AS _ingestion_run_id FROM cost_actuals""",
    "replace_batch_reload": "SELECT order_id, order_item_id, price_amount FROM stg_items",
    "reload_after_failure": f"SELECT order_id, order_item_id, price_amount, {_BATCH} AS etl_batch_id FROM stg_items",
    "reload_from_itself": f"SELECT order_id, order_item_id, CASE WHEN {_BATCH} = 'A' THEN price_amount || '0' ELSE price_amount END AS price_amount, {_BATCH} AS etl_batch_id FROM stg_items",
    "ingest_rejects": """
SELECT concat_ws('-', cost_center_code, fiscal_year, fiscal_period, cost_element_code) AS item, CASE WHEN fiscal_period <= 2 THEN 'rejected' ELSE 'loaded' END AS outcome,
 'again' AS _ingestion_run_id FROM cost_actuals WHERE cost_center_code IS NOT NULL""",
    "audit_log_rows": f"""
SELECT run AS ingestion_run_id, 'flow_readings' AS input_name, 'bdh.fact_pipeline_flow' AS target_table, DATE '2024-01-31' AS business_date, count(*) AS total_rows,
 count(*) FILTER (WHERE bad IS NULL) AS passed_rows, count(*) FILTER (WHERE bad IS NOT NULL) AS rejected_rows, 0::BIGINT AS warned_rows,
 count(*) FILTER (WHERE bad IS NULL)::DOUBLE / count(*)::DOUBLE * 100.0 AS dq_pass_rate_pct, 98.5::DOUBLE AS threshold_pct,
 CASE WHEN count(*) FILTER (WHERE bad IS NULL)::DOUBLE / count(*)::DOUBLE * 100.0 >= 98.5 THEN 'PASS' ELSE 'FAIL' END AS gate_result, stamp AS evaluated_ts
FROM ({_FLOW}) q GROUP BY run, stamp""",
    "reject_log_rows": f"""
SELECT run AS ingestion_run_id, bad AS rule_id, 'REJECT' AS severity,
 CASE bad WHEN 'PIPE-01' THEN 'no value in pipeline_segment_id' ELSE 'flow_rate_bpd is below zero' END AS rejection_reason,
 pipeline_segment_id, flow_rate_bpd::DOUBLE AS flow_rate_bpd, _business_date FROM ({_FLOW}) q WHERE bad IS NOT NULL""",
    "payload_unknown_members": f"""
SELECT order_id, 'order' AS level, -1 AS position, 'note' AS member, '{{"by":"' || {_ORDER} % 3 || '","urgent":true}}' AS value FROM raw_payloads WHERE {_ORDER} % 4 = 0
UNION ALL SELECT order_id, 'item', 0, 'warrantyMonths', ({_ORDER} % 36)::VARCHAR FROM raw_payloads WHERE {_ORDER} % 6 = 0""",
    "payload_rejects": f"""
SELECT order_id, CASE WHEN {_ORDER} % 7 = 0 THEN 'not readable' ELSE 'no document' END AS reason, CASE WHEN {_ORDER} % 7 = 0 THEN substr(raw_json_payload, 1, 12) ELSE ' ' END AS raw_record
FROM raw_payloads WHERE {_ORDER} % 7 = 0 OR {_ORDER} % 11 = 0""",
    "append_and_overwrite_partitions": "SELECT strftime(ts, '%Y%m%d')::INT AS date_key, count(*) AS readings, 3 AS version FROM events GROUP BY 1",
    "stream_pipeline_flow": """
SELECT (year(_business_date) * 10000 + month(_business_date) * 100 + day(_business_date))::INT AS date_key, f.pipeline_segment_id, round(q, 6) AS avg_flow_rate_bpd,
 round(p, 6) AS avg_line_pressure_psi, coalesce(n, 0)::INT AS leak_alarm_count, coalesce(c, 0)::INT AS critical_alarm_count
FROM (SELECT _business_date, pipeline_segment_id, avg(flow_rate_bpd) AS q, avg(line_pressure_psi) AS p FROM flow_readings GROUP BY 1, 2) f
LEFT JOIN (SELECT _business_date, pipeline_segment_id, count(*) AS n, count(*) FILTER (WHERE severity = 'CRITICAL') AS c FROM alarms GROUP BY 1, 2) a
 USING (_business_date, pipeline_segment_id)""",
    "stream_state_transitions": "SELECT * EXCLUDE (hrs, transition_sk), hrs::DOUBLE AS duration_in_from_state_hrs FROM fact_transition",
}


def operator_sql() -> dict[str, str]:
    return {name: compose(STEPS, sql) for name, sql in FINAL.items()}
