"""Checking SQL of the operations pipeline, written independently of the Spark plans."""

from __future__ import annotations

from oracle.compose import compose
from starloom.sources.contracts import CONTRACTS, check_sql

STEPS: dict[str, str] = {n: check_sql(n) for n in CONTRACTS}

# feed -> (fact, threshold, first failing reject rule, warning predicate)
_RULES = {
    "well_readings": ("fact_production_daily", 98.0,
                      "CASE WHEN well_id IS NULL THEN 'PROD-01' WHEN NOT coalesce(oil_rate_bopd >= 0, FALSE) THEN 'PROD-02' END",
                      "NOT coalesce(tubing_pressure_psi BETWEEN 0 AND 15000, FALSE)"),
    "downtime": ("fact_equipment_downtime", 97.0,
                 "CASE WHEN asset_id IS NULL THEN 'DOWN-01' WHEN downtime_end_ts < downtime_start_ts THEN 'DOWN-02' END", "FALSE"),
    "work_orders": ("fact_maintenance_workorder", 97.0,
                    "CASE WHEN work_order_id IS NULL THEN 'WO-01' WHEN asset_id IS NULL THEN 'WO-02' END",
                    "NOT coalesce(labor_hours >= 0, FALSE)"),
    "flow_readings": ("fact_pipeline_flow", 98.5,
                      "CASE WHEN pipeline_segment_id IS NULL THEN 'PIPE-01' WHEN NOT coalesce(flow_rate_bpd >= 0, FALSE) THEN 'PIPE-02' END", "FALSE"),
    "assays": ("fact_refinery_yield", 98.0, "CASE WHEN refinery_id IS NULL THEN 'YLD-01' END", "FALSE"),
    "quality_tests": ("fact_refinery_yield", 98.0,
                      "CASE WHEN refinery_id IS NULL THEN 'YLD-01' WHEN product_code IS NULL THEN 'YLD-02' END", "FALSE"),
    "incidents": ("fact_hse_incident", 99.0,
                  "CASE WHEN incident_id IS NULL THEN 'HSE-01' WHEN facility_id IS NULL THEN 'HSE-02' END",
                  "NOT coalesce(lost_workdays >= 0, FALSE)"),
    "cost_actuals": ("fact_financial_actuals", 99.0,
                     "CASE WHEN cost_center_code IS NULL THEN 'FIN-01' WHEN fiscal_year IS NULL THEN 'FIN-02' END", "FALSE"),
}
def _date(feed: str) -> str:
    return "make_date(fiscal_year::BIGINT, fiscal_period::BIGINT, 1)" if feed == "cost_actuals" else "_business_date"


def _day(feed: str) -> str:
    fact, limit, _, _ = _RULES[feed]
    day = _date(feed)
    rate = "count(*) FILTER (WHERE bad IS NULL)::DOUBLE / count(*)::DOUBLE * 100.0"
    return (f"SELECT '{fact}' AS target_table, '{feed}' AS input_name, {day} AS _business_date, count(*) AS total_rows, count(*) FILTER (WHERE bad IS NULL) AS passed_rows, "
            f"count(*) FILTER (WHERE bad IS NOT NULL) AS rejected_rows, count(*) FILTER (WHERE bad IS NULL AND warned) AS warned_rows, {rate} AS dq_pass_rate_pct, "
            f"{limit}::DOUBLE AS threshold_pct, CASE WHEN {rate} >= {limit} THEN 'PASS' ELSE 'FAIL' END AS gate_result FROM tagged_{feed} GROUP BY {day}")


for feed, (_, _, _rej, _warn) in _RULES.items():
    STEPS[f"tagged_{feed}"] = f"SELECT *, {_rej} AS bad, {_warn} AS warned FROM {feed}"
for feed, (fact, _, _, _) in _RULES.items():
    _own = [f for f, (other, _, _, _) in _RULES.items() if other == fact]
    STEPS[f"failed_{fact}"] = "SELECT _business_date AS d FROM (" + " UNION ALL ".join(_day(f) for f in _own) + ") q WHERE gate_result = 'FAIL' AND _business_date IS NOT NULL"
    STEPS[f"valid_{feed}"] = f"SELECT * FROM tagged_{feed} WHERE bad IS NULL AND {_date(feed)} NOT IN (SELECT d FROM failed_{fact})"

_KEY = "(year(_business_date) * 10000 + month(_business_date) * 100 + day(_business_date))::INT AS date_key"
_MONTH = "substr(date_key::VARCHAR, 1, 4) || '-' || substr(date_key::VARCHAR, 5, 2) AS year_month"
_HASH = (
    "sha256(concat_ws('||', coalesce(asset_description,''), coalesce(asset_type,''), coalesce(facility_id,''), coalesce(location_code,''), "
    "coalesce(manufacturer,''), coalesce(criticality_rank,''), coalesce(parent_asset_id,''), coalesce(record_status,''))) AS change_hash"
)
for _n in (1, 2):
    STEPS[f"newest_assets_{_n}"] = f"""
SELECT asset_id, asset_description, asset_type, facility_id, location_code, manufacturer, criticality_rank, parent_asset_id, record_status, install_date, {_HASH}
FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY last_modified_ts DESC) AS rn FROM assets_{_n}) q WHERE rn = 1"""
STEPS["assets_loaded"] = "SELECT *, row_number() OVER (ORDER BY asset_id) AS asset_sk FROM newest_assets_1"
STEPS["dim_asset"] = """
SELECT a.*, DATE '2024-01-01' AS row_eff_date, CASE WHEN n.change_hash <> a.change_hash THEN DATE '2024-01-30' ELSE DATE '9999-12-31' END AS row_exp_date,
 CASE WHEN n.change_hash <> a.change_hash THEN 'N' ELSE 'Y' END AS current_row_flag FROM assets_loaded a LEFT JOIN newest_assets_2 n ON n.asset_id = a.asset_id
UNION ALL BY NAME
SELECT n.*, (SELECT max(asset_sk) FROM assets_loaded) + row_number() OVER (ORDER BY n.asset_id) AS asset_sk, DATE '2024-01-31' AS row_eff_date,
 DATE '9999-12-31' AS row_exp_date, 'Y' AS current_row_flag
FROM newest_assets_2 n LEFT JOIN assets_loaded a ON a.asset_id = n.asset_id WHERE a.asset_id IS NULL OR a.change_hash <> n.change_hash
"""
STEPS["dim_well_field"] = """
SELECT row_number() OVER (ORDER BY well_id, field_id) AS well_field_sk, well_id, field_id, 'upstream' AS business_domain, sha256('upstream') AS change_hash,
 DATE '2024-01-01' AS row_eff_date, DATE '9999-12-31' AS row_exp_date, 'Y' AS current_row_flag
FROM (SELECT DISTINCT well_id, field_id FROM well_readings WHERE well_id IS NOT NULL AND field_id IS NOT NULL) q
"""
STEPS["dim_cost_center"] = """
SELECT row_number() OVER (ORDER BY c) AS cost_center_sk, c AS cost_center_code, c AS cost_center_name,
 CASE substr(c, 1, 2) WHEN 'UP' THEN 'upstream' WHEN 'MS' THEN 'midstream' WHEN 'DS' THEN 'downstream' ELSE 'other' END AS business_domain
FROM (SELECT DISTINCT cost_center_code AS c FROM cost_actuals WHERE cost_center_code IS NOT NULL) q
"""
STEPS["dim_product"] = """
SELECT row_number() OVER (ORDER BY c) AS product_sk, c AS product_code, c AS product_name,
 CASE WHEN c LIKE 'GASOLINE%' THEN 'LIGHT_DISTILLATE' WHEN c LIKE 'DIESEL%' OR c LIKE 'JET%' THEN 'MIDDLE_DISTILLATE' ELSE 'OTHER' END AS product_family
FROM (SELECT DISTINCT product_code AS c FROM quality_tests WHERE product_code IS NOT NULL) q
"""
STEPS["dim_employee_vendor"] = """
SELECT row_number() OVER (ORDER BY p) AS party_sk, p AS party_id, p AS party_name,
 CASE WHEN p IN (SELECT assigned_crew_id FROM work_orders WHERE assigned_crew_id IS NOT NULL) THEN 'CREW' ELSE 'EMPLOYEE' END AS party_type
FROM (SELECT assigned_crew_id AS p FROM work_orders WHERE assigned_crew_id IS NOT NULL
      UNION SELECT involved_employee_id FROM incidents WHERE involved_employee_id IS NOT NULL) q
"""
STEPS["well_days"] = """
SELECT _business_date, well_id, field_id, avg(oil_rate_bopd) AS oil, avg(gas_rate_mscfd) AS gas, avg(water_rate_bwpd) AS water, avg(tubing_pressure_psi) AS psi,
 count(DISTINCT CASE WHEN well_status_code = 'PRODUCING' THEN hour(reading_ts) END)::DOUBLE AS up
FROM valid_well_readings GROUP BY 1, 2, 3
"""
STEPS["fact_production_daily"] = f"""
SELECT {_KEY}, well_field_sk, oil AS oil_volume_bbl, gas AS gas_volume_mscf, water AS water_volume_bbl, psi AS avg_tubing_pressure_psi,
 coalesce((SELECT avg(h.oil) FROM well_days h WHERE h.well_id = w.well_id AND h.field_id = w.field_id
   AND h._business_date >= w._business_date - 7 AND h._business_date < w._business_date), oil) AS planned_volume_bbl, up AS uptime_hours, 24.0 - up AS downtime_hours
FROM well_days w JOIN dim_well_field USING (well_id, field_id)
"""
_CUR = "(SELECT asset_id, asset_sk, facility_id FROM dim_asset WHERE current_row_flag = 'Y')"
STEPS["fact_equipment_downtime"] = f"""
SELECT {_KEY}, asset_sk, downtime_start_ts, downtime_end_ts, date_diff('second', downtime_start_ts, downtime_end_ts)::DOUBLE / 3600.0 AS downtime_hours,
 downtime_reason_code, linked_work_order_id FROM valid_downtime JOIN {_CUR} a USING (asset_id)
"""
STEPS["fact_maintenance_workorder"] = f"""
SELECT {_KEY}, asset_sk, work_order_id, work_type, priority, status, labor_hours, material_cost_usd,
 date_diff('second', actual_start_ts, actual_finish_ts)::DOUBLE / 3600.0 AS duration_hours,
 date_diff('second', scheduled_start_ts, actual_start_ts)::DOUBLE / 3600.0 AS schedule_variance_hours FROM valid_work_orders JOIN {_CUR} a USING (asset_id)
"""
STEPS["fact_pipeline_flow"] = f"""
SELECT {_KEY}, f.pipeline_segment_id, f.q AS avg_flow_rate_bpd, f.p AS avg_line_pressure_psi, coalesce(n, 0) AS leak_alarm_count, coalesce(c, 0) AS critical_alarm_count
FROM (SELECT _business_date, pipeline_segment_id, avg(flow_rate_bpd) AS q, avg(line_pressure_psi) AS p FROM valid_flow_readings GROUP BY 1, 2) f
LEFT JOIN (SELECT _business_date, pipeline_segment_id, count(*) AS n, count(*) FILTER (WHERE severity = 'CRITICAL') AS c FROM alarms GROUP BY 1, 2) a
 USING (_business_date, pipeline_segment_id)
"""
STEPS["fact_refinery_yield"] = f"""
SELECT {_KEY}, t.refinery_id, product_sk, g AS avg_api_gravity, s AS avg_sulfur_pct, n AS test_count, ok AS pass_count, ko AS fail_count
FROM (SELECT _business_date, refinery_id, product_sk, count(*) AS n, count(*) FILTER (WHERE pass_fail_flag = 'PASS') AS ok, count(*) FILTER (WHERE pass_fail_flag = 'FAIL') AS ko
      FROM valid_quality_tests JOIN dim_product USING (product_code) GROUP BY 1, 2, 3) t
LEFT JOIN (SELECT _business_date, refinery_id, avg(api_gravity) AS g, avg(sulfur_content_pct) AS s FROM valid_assays GROUP BY 1, 2) a USING (_business_date, refinery_id)
"""
STEPS["fact_hse_incident"] = f"""
SELECT {_KEY}, facility_id, incident_id, incident_type, severity_rank, lost_workdays, party_sk
FROM valid_incidents LEFT JOIN dim_employee_vendor ON party_id = involved_employee_id
"""
STEPS["fact_financial_actuals"] = """
SELECT (fiscal_year * 10000 + fiscal_period * 100 + 1)::INT AS date_key, cost_center_sk, cost_element_code, actual_amount_usd, budget_amount_usd
FROM valid_cost_actuals JOIN dim_cost_center USING (cost_center_code)
"""
STEPS["kpi_days"] = """
SELECT date_key, field_id, total_oil_bbl, total_gas_mscf, total_water_bbl, planned_volume_bbl, uptime_pct,
 CASE WHEN planned_volume_bbl > 0 THEN least(100.0, total_oil_bbl / planned_volume_bbl * 100.0) ELSE 100.0 END AS production_efficiency_pct
FROM (SELECT date_key, field_id, sum(oil_volume_bbl) AS total_oil_bbl, sum(gas_volume_mscf) AS total_gas_mscf, sum(water_volume_bbl) AS total_water_bbl,
  sum(planned_volume_bbl) AS planned_volume_bbl, avg(uptime_hours / 24.0) * 100.0 AS uptime_pct FROM fact_production_daily JOIN dim_well_field USING (well_field_sk) GROUP BY 1, 2) q
"""
STEPS["reliability"] = f"""
SELECT year_month, asset_id, facility_id, n AS failure_count, down AS total_downtime_hours, (period - down) / n AS mtbf_hours, down / n AS mttr_hours,
 greatest(0.0, (period - down) / period * 100.0) AS availability_pct
FROM (SELECT *, day(least(last_day((year_month || '-01')::DATE), DATE '2024-01-31')) * 24.0::DOUBLE AS period
      FROM (SELECT {_MONTH}, asset_sk, count(*) AS n, coalesce(sum(downtime_hours), 0.0) AS down FROM fact_equipment_downtime WHERE date_key <= 20240131 GROUP BY 1, 2) d
      JOIN {_CUR} a USING (asset_sk)) q
"""
STEPS["scorecard"] = f"""
SELECT year_month, facility_id, n AS total_incidents, lti AS lost_time_incidents, days AS total_lost_workdays, coalesce(h, 0.0) AS labor_hours_worked,
 CASE WHEN h > 0 THEN n * 200000.0::DOUBLE / h END AS trir, CASE WHEN h > 0 THEN lti * 200000.0::DOUBLE / h END AS ltir
FROM (SELECT {_MONTH}, facility_id, count(*) AS n, count(*) FILTER (WHERE incident_type = 'LTI') AS lti, coalesce(sum(lost_workdays), 0)::INT AS days
      FROM fact_hse_incident WHERE date_key <= 20240131 GROUP BY 1, 2) i
LEFT JOIN (SELECT {_MONTH}, facility_id, sum(labor_hours) AS h FROM fact_maintenance_workorder JOIN {_CUR} a USING (asset_sk) WHERE date_key <= 20240131 GROUP BY 1, 2) l
 USING (year_month, facility_id)
"""
STEPS["financial"] = f"""
SELECT year_month, cost_center_code, business_domain, a AS actual_cost_usd, b AS budget_cost_usd, (a - b)::DOUBLE / nullif(b::DOUBLE, 0) * 100.0 AS variance_pct,
 coalesce(bbl, 0.0) AS production_bbl, CASE WHEN business_domain = 'upstream' AND bbl > 0 THEN a::DOUBLE / bbl END AS cost_per_bbl_usd
FROM (SELECT {_MONTH}, cost_center_code, business_domain, sum(actual_amount_usd) AS a, sum(budget_amount_usd) AS b
      FROM fact_financial_actuals JOIN dim_cost_center USING (cost_center_sk) WHERE date_key <= 20240131 GROUP BY 1, 2, 3) c
LEFT JOIN (SELECT {_MONTH}, sum(total_oil_bbl) AS bbl FROM kpi_days GROUP BY 1) p USING (year_month)
"""
STEPS["integrity"] = f"""
SELECT {_MONTH}, pipeline_segment_id, avg(avg_flow_rate_bpd) AS avg_flow_rate_bpd, sum(leak_alarm_count)::INT AS total_alarms, sum(critical_alarm_count)::INT AS critical_alarms,
 CASE WHEN sum(avg_flow_rate_bpd) > 0 THEN sum(leak_alarm_count)::DOUBLE / (sum(avg_flow_rate_bpd) / 1000.0) END AS alarm_rate_per_1000bbl FROM fact_pipeline_flow GROUP BY 1, 2
"""
STEPS["months"] = """
SELECT year_month FROM reliability UNION SELECT year_month FROM scorecard UNION SELECT year_month FROM financial UNION SELECT year_month FROM integrity
UNION SELECT substr(date_key::VARCHAR, 1, 4) || '-' || substr(date_key::VARCHAR, 5, 2) FROM kpi_days
"""
STEPS["executive"] = f"""
SELECT year_month, oil AS total_oil_bbl, eff AS production_efficiency_pct, avail AS avg_asset_availability_pct, trir, ltir, cost AS total_cost_usd, unit AS avg_cost_per_bbl_usd, crit AS critical_pipeline_alarms
FROM months LEFT JOIN (SELECT {_MONTH}, sum(total_oil_bbl) AS oil, avg(production_efficiency_pct) AS eff FROM kpi_days GROUP BY 1) p USING (year_month)
LEFT JOIN (SELECT year_month, avg(availability_pct) AS avail FROM reliability GROUP BY 1) r USING (year_month)
LEFT JOIN (SELECT year_month, avg(trir) AS trir, avg(ltir) AS ltir FROM scorecard GROUP BY 1) h USING (year_month)
LEFT JOIN (SELECT year_month, sum(actual_cost_usd) AS cost, avg(cost_per_bbl_usd) AS unit FROM financial GROUP BY 1) f USING (year_month)
LEFT JOIN (SELECT year_month, sum(critical_alarms)::INT AS crit FROM integrity GROUP BY 1) i USING (year_month)
"""


def _r(*cols: str) -> str:
    return ", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in cols)


_EXEC = _r("total_oil_bbl", "production_efficiency_pct", "avg_asset_availability_pct", "trir", "ltir", "avg_cost_per_bbl_usd")

_AUDIT = " UNION ALL ".join(
    f"SELECT '{fact}' AS target_table, '{feed}' AS input_name, count(*) AS total_rows, count(*) FILTER (WHERE bad IS NULL) AS passed_rows, "
    f"count(*) FILTER (WHERE bad IS NOT NULL) AS rejected_rows, {limit}::DOUBLE AS threshold_pct FROM tagged_{feed}"
    for feed, (fact, limit, _, _) in _RULES.items())
LATEST = """
SELECT target_table, _business_date AS business_date, total_rows, passed_rows, rejected_rows, dq_pass_rate_pct, threshold_pct, gate_result,
 _business_date::TIMESTAMP + INTERVAL 25 HOUR AS evaluated_ts
FROM (SELECT *, row_number() OVER (PARTITION BY target_table ORDER BY _business_date DESC NULLS LAST, input_name DESC) AS rn FROM (""" + " UNION ALL ".join(_day(f) for f in _RULES) + """) a) q
WHERE rn = 1"""

FINAL: dict[str, str] = {
    "ops_dq_audit": " UNION ALL ".join(
        f"SELECT '{fact}' AS target_table, '{feed}' AS input_name, count(*) AS total_rows, count(*) FILTER (WHERE bad IS NULL) AS passed_rows, "
        f"count(*) FILTER (WHERE bad IS NOT NULL) AS rejected_rows, count(*) FILTER (WHERE bad IS NULL AND warned) AS warned_rows, "
        f"count(*) FILTER (WHERE bad IS NULL)::DOUBLE / count(*)::DOUBLE * 100.0 AS dq_pass_rate_pct, {limit}::DOUBLE AS threshold_pct, "
        f"CASE WHEN count(*) FILTER (WHERE bad IS NULL)::DOUBLE / count(*)::DOUBLE * 100.0 >= {limit} THEN 'PASS' ELSE 'FAIL' END AS gate_result FROM tagged_{feed}"
        for feed, (fact, limit, _, _) in _RULES.items()),
    "ops_dq_rejects": " UNION ALL ".join(
        f"SELECT '{fact}' AS target_table, '{feed}' AS input_name, bad AS rule_id, count(*) AS rows FROM tagged_{feed} WHERE bad IS NOT NULL GROUP BY 3"
        for feed, (fact, _, _, _) in _RULES.items()),
    "ops_gate_days": " UNION ALL ".join(_day(feed) for feed in _RULES),
    "ops_gate_halted_days": "SELECT target_table, _business_date, min(dq_pass_rate_pct) AS lowest_pass_rate_pct, sum(rejected_rows)::BIGINT AS rejected_rows FROM ("
        + " UNION ALL ".join(_day(feed) for feed in _RULES) + ") q WHERE gate_result = 'FAIL' GROUP BY 1, 2",
    "ops_gate_passed_facts": f"""SELECT date_key, pipeline_segment_id, leak_alarm_count, critical_alarm_count, {_r('avg_flow_rate_bpd','avg_line_pressure_psi')}
FROM fact_pipeline_flow WHERE date_key IN (SELECT {_KEY.replace(' AS date_key', '')} FROM tagged_flow_readings GROUP BY _business_date
 HAVING count(*) FILTER (WHERE bad IS NULL)::DOUBLE / count(*)::DOUBLE * 100.0 >= 98.5)""",
    "dim_asset_history": "SELECT * FROM dim_asset",
    "ops_dq_latest_scorecard": LATEST,
    "dim_well_field": "SELECT * FROM dim_well_field",
    "dim_cost_center": "SELECT * FROM dim_cost_center",
    "dim_product": "SELECT * FROM dim_product",
    "dim_employee_vendor": "SELECT * FROM dim_employee_vendor",
    "fact_production_daily": f"""SELECT date_key, well_field_sk, uptime_hours, downtime_hours,
 {_r('oil_volume_bbl','gas_volume_mscf','water_volume_bbl','avg_tubing_pressure_psi','planned_volume_bbl')} FROM fact_production_daily""",
    "fact_equipment_downtime": "SELECT * FROM fact_equipment_downtime",
    "fact_maintenance_workorder": "SELECT * FROM fact_maintenance_workorder",
    "fact_pipeline_flow": f"SELECT date_key, pipeline_segment_id, leak_alarm_count, critical_alarm_count, {_r('avg_flow_rate_bpd','avg_line_pressure_psi')} FROM fact_pipeline_flow",
    "fact_refinery_yield": f"SELECT date_key, refinery_id, product_sk, test_count, pass_count, fail_count, {_r('avg_api_gravity','avg_sulfur_pct')} FROM fact_refinery_yield",
    "fact_hse_incident": "SELECT * FROM fact_hse_incident",
    "fact_financial_actuals": "SELECT date_key, cost_center_sk, cost_element_code, actual_amount_usd::DOUBLE AS actual_amount_usd, budget_amount_usd::DOUBLE AS budget_amount_usd FROM fact_financial_actuals",
    "mart_production_kpi": f"""SELECT date_key, field_id,
 {_r('total_oil_bbl','total_gas_mscf','total_water_bbl','planned_volume_bbl','production_efficiency_pct','uptime_pct')} FROM kpi_days""",
    "mart_equipment_reliability": f"SELECT year_month, asset_id, facility_id, failure_count, total_downtime_hours, {_r('mtbf_hours','mttr_hours','availability_pct')} FROM reliability",
    "mart_hse_scorecard": f"SELECT year_month, facility_id, total_incidents, lost_time_incidents, total_lost_workdays, labor_hours_worked, {_r('trir','ltir')} FROM scorecard",
    "mart_financial_cost": f"""SELECT year_month, cost_center_code, business_domain, actual_cost_usd::DOUBLE AS actual_cost_usd, budget_cost_usd::DOUBLE AS budget_cost_usd, variance_pct,
 {_r('production_bbl','cost_per_bbl_usd')} FROM financial""",
    "mart_pipeline_integrity": f"SELECT year_month, pipeline_segment_id, total_alarms, critical_alarms, {_r('avg_flow_rate_bpd','alarm_rate_per_1000bbl')} FROM integrity",
    "mart_executive_summary": f"SELECT year_month, total_cost_usd::DOUBLE AS total_cost_usd, critical_pipeline_alarms, {_EXEC} FROM executive",
    "vw_exec_dashboard_latest": f"SELECT year_month, total_cost_usd::DOUBLE AS total_cost_usd, critical_pipeline_alarms, {_EXEC} FROM executive WHERE year_month = (SELECT max(year_month) FROM executive)",
    "silver_incremental": f"SELECT date_key, pipeline_segment_id, leak_alarm_count, critical_alarm_count, {_r('avg_flow_rate_bpd','avg_line_pressure_psi')} FROM fact_pipeline_flow",
    "mart_reliability_late_day": f"""SELECT year_month, asset_id, facility_id, failure_count, total_downtime_hours, {_r('mtbf_hours','mttr_hours','availability_pct')} FROM reliability
 WHERE year_month IN ('2023-11', '2023-12', '2024-01')""",
    "mart_integrity_late_day": f"SELECT year_month, pipeline_segment_id, total_alarms, critical_alarms, {_r('avg_flow_rate_bpd','alarm_rate_per_1000bbl')} FROM integrity WHERE year_month IN ('2023-11', '2023-12', '2024-01')",
    "mart_scorecard_refreshed": f"""SELECT year_month, facility_id, total_incidents, lost_time_incidents, total_lost_workdays, labor_hours_worked, {_r('trir','ltir')} FROM scorecard
 WHERE year_month IN ('2023-11', '2023-12', '2024-01')""",
    "vw_hse_alert_facilities": f"SELECT facility_id, year_month, total_incidents, {_r('trir','ltir')} FROM scorecard WHERE trir > 1.0",
    "vw_reliability_watchlist": f"SELECT asset_id, facility_id, year_month, {_r('mtbf_hours','mttr_hours','availability_pct')} FROM reliability WHERE availability_pct < 95.0",
    "ops_calendar_use": """
SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, d AS calendar_date, dayname(d) AS day_of_week, day(d) AS day_of_month, month(d) AS month_number,
 monthname(d) AS month_name, quarter(d) AS quarter_number, year(d) AS fiscal_year, dayofweek(d) IN (5, 6) AS is_weekend, FALSE AS is_holiday_ksa, n AS events
FROM (SELECT ts::DATE AS d, count(*) AS n FROM events GROUP BY 1) q""",
}


def operations_sql() -> dict[str, str]:
    return {name: compose(STEPS, sql) for name, sql in FINAL.items()}
