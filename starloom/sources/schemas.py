"""Declared schemas of the raw feeds. Columns and types are fixed contracts."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Feed:
    format: str
    schema: str
    tables: dict[str, str]


FEEDS = {
    "scada_upstream": Feed("json", "curated_scada_upstream", {
        "raw_well_production_reading":
            "well_id string, field_id string, reading_ts timestamp, oil_rate_bopd double, "
            "gas_rate_mscfd double, water_rate_bwpd double, tubing_pressure_psi double, "
            "casing_pressure_psi double, choke_size_64th int, well_status_code string",
        "raw_field_header_pressure":
            "field_id string, header_id string, reading_ts timestamp, header_pressure_psi double, "
            "header_temp_f double",
        "raw_wellhead_events":
            "well_id string, event_ts timestamp, event_type string, event_detail string, raw_payload string",
    }),
    "maximo_eam": Feed("csv", "curated_maximo_eam", {
        "raw_asset_master":
            "asset_id string, asset_description string, asset_type string, facility_id string, "
            "location_code string, manufacturer string, install_date date, criticality_rank string, "
            "parent_asset_id string, record_status string, last_modified_ts timestamp",
        "raw_work_order":
            "work_order_id string, asset_id string, work_type string, priority string, status string, "
            "problem_code string, reported_ts timestamp, scheduled_start_ts timestamp, "
            "actual_start_ts timestamp, actual_finish_ts timestamp, labor_hours double, "
            "material_cost_usd double, assigned_crew_id string",
        "raw_downtime_event":
            "asset_id string, downtime_start_ts timestamp, downtime_end_ts timestamp, "
            "downtime_reason_code string, linked_work_order_id string",
    }),
    "sap_erp": Feed("parquet", "curated_sap_erp", {
        "raw_gl_journal":
            "journal_id string, posting_date date, fiscal_year int, fiscal_period int, "
            "gl_account_code string, cost_center_code string, document_type string, "
            "amount_local_ccy decimal(18,2), local_currency string, amount_usd decimal(18,2), "
            "debit_credit_indicator string, reference_document string",
        "raw_purchase_order":
            "po_number string, po_line_number int, vendor_code string, material_code string, "
            "cost_center_code string, order_qty decimal(18,3), unit_of_measure string, "
            "net_price_usd decimal(18,2), po_created_date date, po_status string",
        "raw_cost_center_actuals":
            "cost_center_code string, fiscal_year int, fiscal_period int, cost_element_code string, "
            "actual_amount_usd decimal(18,2), budget_amount_usd decimal(18,2)",
    }),
    "pipeline_scada": Feed("json", "curated_pipeline_scada", {
        "raw_pipeline_flow_reading":
            "pipeline_segment_id string, reading_ts timestamp, flow_rate_bpd double, "
            "line_pressure_psi double, line_temp_f double, pump_station_id string",
        "raw_leak_detection_alarm":
            "pipeline_segment_id string, alarm_ts timestamp, alarm_type string, severity string, "
            "acknowledged_ts timestamp, acknowledged_by string",
    }),
    "refinery_lims": Feed("csv", "curated_refinery_lims", {
        "raw_crude_assay":
            "refinery_id string, sample_id string, sample_ts timestamp, crude_grade string, "
            "api_gravity double, sulfur_content_pct double, water_content_pct double",
        "raw_product_quality_test":
            "refinery_id string, product_code string, batch_id string, test_ts timestamp, "
            "test_parameter string, test_result double, spec_min double, spec_max double, "
            "pass_fail_flag string",
    }),
    "hse": Feed("json", "curated_hse", {
        "raw_incident_report":
            "incident_id string, facility_id string, incident_ts timestamp, incident_type string, "
            "severity_rank string, lost_workdays int, involved_employee_id string, "
            "involved_contractor string, description string",
        "raw_safety_observation":
            "observation_id string, facility_id string, observation_ts timestamp, "
            "observation_category string, observer_employee_id string, corrective_action string, "
            "closed_flag boolean",
    }),
}

# The parts of a product-order document (public TM Forum 622 layout) that become item rows.
ORDER_PAYLOAD = (
    "id string, productOrderItem array<struct<id: string, quantity: string, state: string, action: string, "
    "productOffering: struct<id: string>, "
    "product: struct<productSpecification: struct<id: string>>, "
    "itemPrice: array<struct<priceType: string, "
    "price: struct<taxIncludedAmount: struct<value: string, unit: string>>>>>>"
)
