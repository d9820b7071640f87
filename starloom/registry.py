"""Every query of the library over the benchmark tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.asof import merge_as_of
from starloom.operators.dq import latest_scorecard
from starloom.operators.keyed import latest_per_key
from starloom.operators.ordered import assign_surrogate_keys, number_rows, with_previous, with_running
from starloom.operators.scd import ORDER_HISTORY, classify_changes, lookup_as_of, scd1_upsert
from starloom.plans import batch_trips as BT
from starloom.plans import calendar as cal
from starloom.plans import order_analytics as A
from starloom.plans import order_dims as D
from starloom.plans import order_marts as M
from starloom.plans import order_quality as Q
from starloom.plans import ops_marts as OM
from starloom.plans import ops_warehouse as O
from starloom.plans import round_trips as RT
from starloom.plans.ops_warehouse import OpsWarehouse
from starloom.plans.order_warehouse import OrderWarehouse
from starloom.plans.warehouse import open_warehouse
from starloom.sources import contracts as feeds
from starloom.sources.landing import explode_order_items, payload_rejects, unknown_members
from starloom.sources.tables import mark_processed, purge_older_than

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame, drop: tuple[str, ...] = (), rounded: tuple[str, ...] = ()) -> DataFrame:
    """Decimals as doubles for comparison; order-dependent averages rounded."""
    out = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in rounded:
            c = F.round(c, 6)
        out.append(c.alias(f.name))
    return df.select(*out)


def _orders(build: Callable[[OrderWarehouse], DataFrame], drop: tuple[str, ...] = (), rounded: tuple[str, ...] = ()) -> Query:
    return lambda spark, sf: plain(build(open_warehouse(OrderWarehouse, spark, sf)), drop, rounded)


def _error_log(w: OrderWarehouse) -> DataFrame:
    at = F.lit(feeds.AS_OF).cast("timestamp")
    orders = Q.error_log(w["checked_orders"], "stg_product_order", feeds.BATCH, at)
    items = Q.error_log(w["checked_items"], "stg_product_order_item", feeds.BATCH, at)
    people = Q.error_log(Q.check_customers(w.feed("stg_customers_2")), "stg_customer", feeds.BATCH, at, order_id=None)
    return orders.unionByName(items).unionByName(people)


def _change_classes(w: OrderWarehouse) -> DataFrame:
    first = D.build_dim_customer(w.feed("stg_customers_1"), None, feeds.FIRST_LOAD)
    found = classify_changes(first, D.conform_customers(w.feed("stg_customers_2")), ["customer_bk"], D.CUSTOMER_TYPE2, D.CUSTOMER_TYPE1)
    return found.select("customer_bk", "change_type")


def _headers_twice(w: OrderWarehouse) -> DataFrame:
    """Order headers loaded twice: in the first load every third order is missing and every fifth has another state."""
    n = F.coalesce(F.substring("order_bk", 2, 18).try_cast("long"), F.lit(0))
    other, digest = n % 5 == 0, ORDER_HISTORY.digest
    orders = w["ods_orders"]
    earlier = orders.filter(n % 3 != 0).withColumns({
        "order_state_cd": F.when(other, F.lit("pending")).otherwise(F.col("order_state_cd")),
        digest: F.when(other, F.md5(F.concat(digest, F.lit("x")))).otherwise(F.col(digest))})
    loaded = D.build_dim_order(orders, D.build_dim_order(earlier, None, feeds.FIRST_LOAD), feeds.AS_OF)
    return loaded.select("order_sk", "order_bk", "order_state_cd", digest, ORDER_HISTORY.eff, ORDER_HISTORY.exp, ORDER_HISTORY.flag)


def _as_recorded(w: OrderWarehouse) -> DataFrame:
    people = w["dim_customer"].select("customer_bk", "customer_sk", "customer_segment_cd", ORDER_HISTORY.eff, ORDER_HISTORY.exp)
    orders = w["ods_orders"].select("order_bk", "order_date", "customer_bk")
    return lookup_as_of(orders, people, ["customer_bk"], "order_date").select("order_bk", "order_date", "customer_sk", "customer_segment_cd")


def _as_merged(w: OrderWarehouse) -> DataFrame:
    people = w["dim_customer"].select("customer_bk", "customer_sk", "customer_segment_cd", ORDER_HISTORY.eff, ORDER_HISTORY.exp)
    orders = w["ods_orders"].select("order_bk", "order_date", "customer_bk")
    return merge_as_of(orders, people, ["customer_bk"], "order_date").select("order_bk", "order_date", "customer_sk", "customer_segment_cd")


def _sales_as_recorded(w: OrderWarehouse) -> DataFrame:
    return M.sales_by_segment(w["ods_orders"], w["dim_customer"].filter("customer_sk > 0"), feeds.FIRST_LOAD, as_recorded=True)


def _span(rows: DataFrame, day: str) -> tuple[str, str]:
    """First and last day that occur."""
    first, last = rows.agg(F.min(day), F.max(day)).first()
    return str(first or feeds.AS_OF), str(last or feeds.AS_OF)


def _calendar_use(spark: SparkSession, sf: str) -> DataFrame:
    orders = feeds.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(F.count(F.lit(1)).alias("orders"))
    # the maintained holiday list: the first day of a year with orders, and every 23 September
    day = F.col("full_date")
    holidays = orders.filter(F.date_format(day, "MM-dd").isin("01-01", "09-23")).select(
        day, F.when(F.month(day) == 1, "New Year").otherwise("National Day").alias("holiday_nm"))
    return cal.dim_date(spark, *_span(orders, "full_date"), holidays).join(orders, "full_date")


def _time_use(spark: SparkSession, sf: str) -> DataFrame:
    used = feeds.table(spark, sf, "events").groupBy((F.hour("ts") * 100 + F.minute("ts")).alias("time_sk")).agg(F.count(F.lit(1)).alias("events"))
    return cal.dim_time(spark).drop("ast_offset_hours").join(used, "time_sk")


def _purged(w: OrderWarehouse) -> DataFrame:
    dated = w.feed("stg_orders").withColumn("order_ts", F.col("order_date").try_cast("timestamp_ntz"))
    return purge_older_than(dated, "order_ts", feeds.AS_OF).select("order_id", "stg_record_id")


_ITEM_FACT = ("order_bk", "product_spec_sk", "provisioning_duration_hrs", "item_sla_breach_flag", "etl_batch_id", "month_sk")
_ORDER_FACT = ("billing_account_sk", "sla_breach_consistent_flag", "revenue_assurance_flag", "etl_batch_id", "record_version")

ORDER_QUERIES: dict[str, Query] = {
    "order_dq_checked_batch": _orders(lambda w: w["checked_orders"].select(
        "stg_record_id", "order_id", "stg_record_status", "stg_error_desc", "vat_amount")),
    "order_dq_error_log": _orders(lambda w: _error_log(w).select(
        "err_rule_code", "err_rule_name", "err_severity", "err_source_table", "err_field_name", "err_field_value",
        "order_id", "order_item_id")),
    "order_dq_scorecard": _orders(lambda w: Q.dq_scorecard(_error_log(w), w["checked_orders"]), ("first_occurrence", "last_occurrence")),
    "order_dq_batch_score": _orders(lambda w: Q.dq_batch_score(w["checked_orders"])),
    "ods_orders": _orders(lambda w: w["ods_orders"], (
        "cancellation_dt", "delivery_city", "delivery_postal_code", "stg_batch_id", "record_action", "recurring_charge_mrc", "one_time_charge_otc")),
    "ods_items": _orders(lambda w: w["ods_items"], ("delivery_city", "ods_load_dt", "stg_batch_id")),
    "payload_items": lambda spark, sf: explode_order_items(feeds.contract(spark, sf, "raw_payloads")),
    "dim_customer_history": _orders(lambda w: w["dim_customer"]),
    "dim_offering_history": _orders(lambda w: w["dim_offering"]),
    "dim_order_history": _orders(lambda w: w["dim_order"], ("cancellation_dt",)),
    "dim_order_two_loads": _orders(_headers_twice),
    "dim_geography": _orders(lambda w: w["dim_geography"]),
    "dim_related_party": _orders(lambda w: w["dim_party"]),
    "customer_change_classes": _orders(_change_classes),
    "order_customer_as_recorded": _orders(_as_recorded),
    "order_customer_merged": _orders(_as_merged),
    "mart_sales_as_recorded": _orders(_sales_as_recorded),
    "order_calendar_use": _calendar_use,
    "order_time_use": _time_use,
    "fact_transition": _orders(lambda w: w["fact_transition"], ("order_item_sk", "etl_batch_id", "month_sk")),
    "fact_order": _orders(lambda w: w["fact_order"], (*_ORDER_FACT, "month_sk")),
    "daily_equals_full": lambda spark, sf: plain(RT.orders_in_batches(spark, sf), _ORDER_FACT),
    "daily_batch_resumed": lambda spark, sf: plain(BT.resumed_batch(spark, sf).table("fact_order"), _ORDER_FACT),
    "daily_batch_items": lambda spark, sf: plain(BT.resumed_batch(spark, sf).table("fact_item"), _ITEM_FACT),
    "daily_batch_staging": BT.batch_staging,
    "daily_batch_ledger": BT.batch_ledger,
    "daily_batch_errors": BT.batch_errors,
    "daily_batch_halted": BT.batch_halted,
    "fact_item": _orders(lambda w: w["fact_item"], _ITEM_FACT),
    "mart_order_kpi": _orders(lambda w: M.order_kpi(w)),
    "mart_sla_compliance": _orders(lambda w: M.sla_compliance(w)),
    "mart_adoption": _orders(lambda w: M.adoption(w)),
    "mart_revenue_assurance": _orders(lambda w: M.revenue_assurance(w, w.feed("billing"))),
    "vw_exec_order_summary": _orders(lambda w: M.vw_exec_order_summary(w["mart_order_kpi"]), (),
                                     ("avg_order_value", "avg_sla_compliance_pct", "avg_fallout_rate_pct")),
    "vw_channel_comparison": _orders(lambda w: M.vw_channel_comparison(w["mart_order_kpi"]), (),
                                     ("avg_order", "sla_compliance_pct", "fallout_rate_pct")),
    "vw_5g_regional_adoption": _orders(lambda w: M.vw_5g_regional_adoption(w["mart_order_kpi"])),
    "uc01a_adoption_by_region": _orders(lambda w: A.uc01a(w, [2000, 2001])),
    "uc01b_top_5g_offerings": _orders(lambda w: A.uc01b(w, 2000)),
    "uc02a_weekly_sla": _orders(lambda w: A.uc02a(w, feeds.AS_OF)),
    "uc02b_bottlenecks": _orders(lambda w: A.uc02b(w, feeds.EVENTS_AS_OF)),
    "uc03a_revenue_vat": _orders(lambda w: A.uc03a(w, 2000), (), ("effective_vat_rate_pct",)),
    "uc04_channel_performance": _orders(lambda w: A.uc04(w, 2000)),
    "uc05_customer_history": _orders(lambda w: A.uc05(w)),
    "uc06_fallout_root_cause": _orders(lambda w: A.uc06(w, feeds.EVENTS_AS_OF)),
    "uc06_bucketed": lambda spark, sf: plain(A.uc06(BT.bucketed_star(spark, sf), feeds.EVENTS_AS_OF)),
    "uc09_bucketed": lambda spark, sf: plain(A.uc09(BT.bucketed_star(spark, sf), 1998, 3)),
    "uc07_product_mix": _orders(lambda w: A.uc07(w, 2000)),
    "uc08_agent_scorecard": _orders(lambda w: A.uc08(w, 2000, 6)),
    "uc09_cohort_funnel": _orders(lambda w: A.uc09(w, 1998, 3)),
    "uc10_vat_reconciliation": _orders(lambda w: A.uc10(w, 2000)),
    "vw_order_pulse": _orders(lambda w: A.order_pulse(w, "2001-07-20")),
    "vw_stuck_orders": _orders(lambda w: A.stuck_orders(w, f"{feeds.AS_OF} 12:00:00")),
    "staging_marked_processed": _orders(lambda w: mark_processed(w["checked_orders"], feeds.BATCH).select(
        "stg_record_id", "order_id", "stg_record_status")),
    "staging_after_purge": _orders(_purged),
    "staging_after_load_purge": BT.purged_by_load_date,
    "scd2_touched_buckets": lambda spark, sf: plain(BT.touched_buckets(spark, sf)),
    "approximate_customers": BT.approximate_customers,
    "percentiles_from_counts": lambda spark, sf: plain(BT.counted_percentiles(spark, sf)),
    "seed_states_in_use": lambda spark, sf: BT.seeds_in_use(spark, sf, "state"),
    "seed_channels_in_use": lambda spark, sf: BT.seeds_in_use(spark, sf, "channel"),
    "seed_actions_in_use": lambda spark, sf: BT.seeds_in_use(spark, sf, "action"),
}


_BDH = ("_bdh_load_ts", "_dq_pass_rate", "month_key")
_ADL = ("_adl_load_ts",)


def _ops(build: Callable[[OpsWarehouse], DataFrame], drop: tuple[str, ...] = (), rounded: tuple[str, ...] = ()) -> Query:
    return lambda spark, sf: plain(build(open_warehouse(OpsWarehouse, spark, sf)), drop, rounded)


def _ops_calendar(spark: SparkSession, sf: str) -> DataFrame:
    events = feeds.table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("calendar_date")).agg(F.count(F.lit(1)).alias("events"))
    return cal.dim_date_compact(spark, *_span(events, "calendar_date")).join(events, "calendar_date")


def _rejects(w: OpsWarehouse) -> DataFrame:
    return O.stacked(w, O.rejects).groupBy("target_table", "input_name", "rule_id").agg(F.count(F.lit(1)).alias("rows"))


def _latest_scorecard(w: OpsWarehouse) -> DataFrame:
    """The gate runs once per business date, at one in the morning after it; the last run per table counts."""
    day = F.col("_business_date")
    audit = w["gate_days"].select(
        "*", F.date_format(day, "yyyyMMdd").alias("ingestion_run_id"), day.alias("business_date"),
        (day + F.expr("INTERVAL '25' HOUR")).cast("timestamp_ntz").alias("evaluated_ts"))
    return latest_scorecard(audit)


_EXEC = ("total_oil_bbl", "production_efficiency_pct", "avg_asset_availability_pct", "trir", "ltir", "avg_cost_per_bbl_usd")

OPS_QUERIES: dict[str, Query] = {
    "ops_dq_audit": _ops(lambda w: O.stacked(w, O.gate_counts)),
    "ops_dq_rejects": _ops(_rejects),
    "ops_dq_latest_scorecard": _ops(_latest_scorecard),
    "ops_gate_days": _ops(lambda w: w["gate_days"]),
    "ops_gate_halted_days": _ops(O.halted_days),
    "ops_gate_passed_facts": _ops(O.gated_flow, _BDH, ("avg_flow_rate_bpd", "avg_line_pressure_psi")),
    "dim_asset_history": _ops(lambda w: w["dim_asset"]),
    "dim_well_field": _ops(lambda w: w["dim_well_field"]),
    "dim_cost_center": _ops(lambda w: w["dim_cost_center"], ("last_updated_ts",)),
    "dim_product": _ops(lambda w: w["dim_product"], ("last_updated_ts",)),
    "dim_employee_vendor": _ops(lambda w: w["dim_employee_vendor"], ("last_updated_ts", "department_code")),
    "fact_production_daily": _ops(lambda w: w["fact_production_daily"], _BDH, (
        "oil_volume_bbl", "gas_volume_mscf", "water_volume_bbl", "avg_tubing_pressure_psi", "planned_volume_bbl")),
    "fact_equipment_downtime": _ops(lambda w: w["fact_equipment_downtime"], _BDH),
    "fact_maintenance_workorder": _ops(lambda w: w["fact_maintenance_workorder"], _BDH),
    "fact_pipeline_flow": _ops(lambda w: w["fact_pipeline_flow"], _BDH, ("avg_flow_rate_bpd", "avg_line_pressure_psi")),
    "fact_refinery_yield": _ops(lambda w: w["fact_refinery_yield"], _BDH, ("avg_api_gravity", "avg_sulfur_pct")),
    "fact_hse_incident": _ops(lambda w: w["fact_hse_incident"], _BDH),
    "fact_financial_actuals": _ops(lambda w: w["fact_financial_actuals"], _BDH),
    "mart_production_kpi": _ops(lambda w: w["mart_production_kpi"], _ADL, (
        "total_oil_bbl", "total_gas_mscf", "total_water_bbl", "planned_volume_bbl", "production_efficiency_pct", "uptime_pct")),
    "mart_equipment_reliability": _ops(lambda w: w["mart_equipment_reliability"], _ADL, ("mtbf_hours", "mttr_hours", "availability_pct")),
    "mart_hse_scorecard": _ops(lambda w: w["mart_hse_scorecard"], _ADL, ("trir", "ltir")),
    "mart_financial_cost": _ops(lambda w: w["mart_financial_cost"], _ADL, ("production_bbl", "cost_per_bbl_usd")),
    "mart_pipeline_integrity": _ops(lambda w: w["mart_pipeline_integrity"], _ADL, ("avg_flow_rate_bpd", "alarm_rate_per_1000bbl")),
    "mart_executive_summary": _ops(O.executive_summary, _ADL, _EXEC),
    "vw_exec_dashboard_latest": _ops(lambda w: OM.vw_exec_dashboard_latest(w["mart_executive_summary"]), _ADL, _EXEC),
    "vw_hse_alert_facilities": _ops(lambda w: OM.vw_hse_alert_facilities(w["mart_hse_scorecard"]), (), ("trir", "ltir")),
    "vw_reliability_watchlist": _ops(lambda w: OM.vw_reliability_watchlist(w["mart_equipment_reliability"]), (), (
        "mtbf_hours", "mttr_hours", "availability_pct")),
    "ops_calendar_use": _ops_calendar,
    "silver_incremental": lambda spark, sf: plain(BT.incremental_silver(spark, sf), _BDH, ("avg_flow_rate_bpd", "avg_line_pressure_psi")),
    "mart_reliability_late_day": lambda spark, sf: plain(BT.late_day(spark, sf, "reliability"), _ADL, ("mtbf_hours", "mttr_hours", "availability_pct")),
    "mart_integrity_late_day": lambda spark, sf: plain(BT.late_day(spark, sf, "integrity"), _ADL, ("avg_flow_rate_bpd", "alarm_rate_per_1000bbl")),
    "mart_scorecard_refreshed": lambda spark, sf: plain(BT.refreshed_months(spark, sf), _ADL, ("trir", "ltir")),
}


def _numbered_items(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.contract(spark, sf, "stg_items").select("order_id", "order_item_id", "item_quantity")
    return assign_surrogate_keys(rows, ["order_id", "order_item_id"], "item_sk", 1000)


def _previous_event(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.contract(spark, sf, "stg_events").select("order_id", "event_timestamp", "stg_record_id")
    ranked = number_rows(rows, ["order_id", "event_timestamp", "stg_record_id"])
    return with_previous(ranked, "order_id", "event_timestamp", "previous_timestamp").drop("_pid", "_rn")


def _running_spend(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    ranked = number_rows(rows, ["o_custkey", "o_orderdate", "o_orderkey"])
    running = with_running(ranked, "o_custkey", {"running_spend": "price", "seq": F.lit(1)})
    return plain(running.drop("_pid", "_rn", "o_orderdate", "price"))


def _latest_copy(spark: SparkSession, sf: str) -> DataFrame:
    orders = feeds.contract(spark, sf, "stg_orders").filter("order_id <> ''")
    return latest_per_key(orders.select("order_id", "stg_load_dt", "stg_record_id", "total_amount"), ["order_id"], ["stg_load_dt", "stg_record_id"])


def _upserted(spark: SparkSession, sf: str) -> DataFrame:
    load = lambda n: feeds.contract(spark, sf, f"stg_customers_{n}").select("customer_id", "customer_segment", "churn_risk_score")
    args = (["customer_id"], ["customer_segment", "churn_risk_score"], "sk")
    return scd1_upsert(scd1_upsert(None, load(1), *args), load(2), *args)


def _landed(source: str, table: str, feed: str) -> Query:
    return lambda spark, sf: RT.landed(spark, sf, source, table, feed)


OPERATOR_QUERIES: dict[str, Query] = {
    "surrogate_keys": _numbered_items,
    "previous_event_per_order": _previous_event,
    "running_spend_per_customer": _running_spend,
    "latest_copy_per_order": _latest_copy,
    "scd1_upsert_customers": _upserted,
    "ingest_json_incidents": _landed("hse", "raw_incident_report", "incidents"),
    "ingest_csv_downtime": _landed("maximo_eam", "raw_downtime_event", "downtime"),
    "ingest_parquet_cost_actuals": lambda spark, sf: plain(RT.landed(spark, sf, "sap_erp", "raw_cost_center_actuals", "cost_actuals")),
    "replace_batch_reload": RT.reloaded_batches,
    "reload_after_failure": RT.reloaded_after_failure,
    "reload_from_itself": RT.reloaded_from_itself,
    "ingest_rejects": RT.rejected_landing,
    "audit_log_rows": lambda spark, sf: RT.logged_gate(spark, sf, "audit"),
    "reject_log_rows": lambda spark, sf: RT.logged_gate(spark, sf, "rejects"),
    "payload_unknown_members": lambda spark, sf: unknown_members(RT.extended_payloads(spark, sf)),
    "payload_rejects": lambda spark, sf: payload_rejects(RT.damaged_payloads(spark, sf)),
    "append_and_overwrite_partitions": RT.appended_partitions,
    "stream_pipeline_flow": lambda spark, sf: plain(RT.streamed_flow(spark, sf), _BDH, ("avg_flow_rate_bpd", "avg_line_pressure_psi")),
    "stream_state_transitions": lambda spark, sf: plain(RT.streamed_transitions(spark, sf), ("transition_sk", "order_item_sk", "etl_batch_id")),
}

QUERIES: dict[str, Query] = {**ORDER_QUERIES, **OPS_QUERIES, **OPERATOR_QUERIES}
