"""The operations warehouse: raw feeds to conformed facts to KPI marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.operators.dq import FACT_GATES, DQResult, Rule, evaluate_rules, gate_by, passed_only
from starloom.plans import ops_dims as dims
from starloom.plans import ops_facts as facts
from starloom.plans import ops_marts as marts
from starloom.plans.warehouse import Warehouse, month_of

AS_OF = "2024-01-31"
FIRST_LOAD = "2024-01-01"
STAMP = "2024-02-01 00:00:00"

# feed -> rules and the fact whose gate applies
GATED: dict[str, tuple[Callable[[], list[Rule]], str]] = {
    "well_readings": (facts.reading_rules, "fact_production_daily"),
    "downtime": (facts.downtime_rules, "fact_equipment_downtime"),
    "work_orders": (facts.work_order_rules, "fact_maintenance_workorder"),
    "flow_readings": (facts.flow_rules, "fact_pipeline_flow"),
    "assays": (facts.assay_rules, "fact_refinery_yield"),
    "quality_tests": (facts.quality_rules, "fact_refinery_yield"),
    "incidents": (facts.incident_rules, "fact_hse_incident"),
    "cost_actuals": (facts.financial_rules, "fact_financial_actuals"),
}


def _stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month_key", month_of("date_key"))


def result(w: Warehouse, feed: str) -> DQResult:
    """Outcome of a feed's rules, read from its stored tagged rows: feed and rules are run once."""
    tagged = w[f"tagged_{feed}"]
    if facts.DAY not in tagged.columns:  # cost lines are dated by their fiscal period
        tagged = tagged.withColumn(facts.DAY, F.make_date("fiscal_year", "fiscal_period", F.lit(1)))
    return DQResult(tagged, GATED[feed][0](), w.feed(feed).columns)


def gate_counts(w: Warehouse, feed: str) -> DataFrame:
    """Audit row of a feed over all its business dates."""
    table = GATED[feed][1]
    counted = gate_by(result(w, feed).named(target_table=table, input_name=feed), FACT_GATES.of(table), "target_table", "input_name")
    return counted.select(
        "target_table", "input_name", "total_rows", "passed_rows", "rejected_rows", "warned_rows", "dq_pass_rate_pct", "threshold_pct", "gate_result")


def gate_days(w: Warehouse, feed: str) -> DataFrame:
    """Verdict per business date of a feed: a bad day cannot hide in a good month, nor a good one be lost to it."""
    table = GATED[feed][1]
    return gate_by(result(w, feed).named(target_table=table, input_name=feed), FACT_GATES.of(table), "target_table", "input_name", facts.DAY)


def halted_days(w: Warehouse) -> DataFrame:
    """Days on which a fact is not loaded, because one of its feeds failed its gate."""
    return w["gate_days"].filter(F.col("gate_result") == "FAIL").groupBy("target_table", facts.DAY).agg(
        F.min("dq_pass_rate_pct").alias("lowest_pass_rate_pct"), F.sum("rejected_rows").alias("rejected_rows"))


def gated(w: Warehouse, feed: str) -> DataFrame:
    """Valid rows of a feed on the days that its fact is loaded: a day on which any feed of the fact failed is halted as a whole."""
    days = w[f"days_{GATED[feed][1]}"].groupBy(facts.DAY).agg(F.min("gate_result").alias("gate_result"))
    return passed_only(result(w, feed), days, facts.DAY)


def gated_flow(w: Warehouse) -> DataFrame:
    """The pipeline fact as the gate admits it, day by day."""
    return facts.build_fact_pipeline_flow(gated(w, "flow_readings"), w.feed("alarms"))


def rejects(w: Warehouse, feed: str) -> DataFrame:
    return result(w, feed).rejects.select(F.lit(GATED[feed][1]).alias("target_table"), F.lit(feed).alias("input_name"), "*")


def stacked(w: Warehouse, one: Callable[[Warehouse, str], DataFrame], table: str | None = None) -> DataFrame:
    """``one`` of every feed, or of the feeds of one fact."""
    frames = [one(w, feed) for feed, (_, fact) in GATED.items() if table in (None, fact)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _dim_asset(w: Warehouse) -> DataFrame:
    return dims.build_dim_asset(w.feed("assets_2"), dims.build_dim_asset(w.feed("assets_1"), None, FIRST_LOAD), AS_OF)


def _tagged(feed: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: evaluate_rules(w.feed(feed), GATED[feed][0]()).tagged


def _gate_days_of(table: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: stacked(w, gate_days, table)


def _gate_days(w: Warehouse) -> DataFrame:
    first, *rest = dict.fromkeys(fact for _, fact in GATED.values())
    out = w[f"days_{first}"]
    for table in rest:
        out = out.unionByName(w[f"days_{table}"])
    return out


class OpsWarehouse(Warehouse):
    builders = {
        **{f"tagged_{feed}": _tagged(feed) for feed in GATED},
        # verdicts per fact: one fact is not kept waiting for the feeds of the others
        **{f"days_{table}": _gate_days_of(table) for table in dict.fromkeys(fact for _, fact in GATED.values())},
        "gate_days": _gate_days,
        "dim_asset": _dim_asset,
        "dim_well_field": lambda w: dims.build_dim_well_field(w.feed("well_readings"), None, FIRST_LOAD),
        "dim_cost_center": lambda w: dims.build_dim_cost_center(w.feed("cost_actuals"), None, _stamp()),
        "dim_product": lambda w: dims.build_dim_product(w.feed("quality_tests"), None, _stamp()),
        "dim_employee_vendor": lambda w: dims.build_dim_employee_vendor(w.feed("work_orders"), w.feed("incidents"), None, _stamp()),
        "fact_production_daily": lambda w: _by_month(facts.build_fact_production_daily(gated(w, "well_readings"), w["dim_well_field"])),
        "fact_equipment_downtime": lambda w: _by_month(facts.build_fact_equipment_downtime(gated(w, "downtime"), w["dim_asset"])),
        "fact_maintenance_workorder": lambda w: _by_month(facts.build_fact_maintenance_workorder(gated(w, "work_orders"), w["dim_asset"])),
        "fact_pipeline_flow": lambda w: _by_month(facts.build_fact_pipeline_flow(gated(w, "flow_readings"), w.feed("alarms"))),
        "fact_refinery_yield": lambda w: _by_month(facts.build_fact_refinery_yield(gated(w, "assays"), gated(w, "quality_tests"), w["dim_product"])),
        "fact_hse_incident": lambda w: _by_month(facts.build_fact_hse_incident(gated(w, "incidents"), w["dim_employee_vendor"])),
        "fact_financial_actuals": lambda w: _by_month(facts.build_fact_financial_actuals(gated(w, "cost_actuals"), w["dim_cost_center"])),
        "mart_production_kpi": lambda w: marts.mart_production_kpi(w["fact_production_daily"], w["dim_well_field"]),
        "mart_equipment_reliability": lambda w: marts.mart_equipment_reliability(w["fact_equipment_downtime"], w["dim_asset"], AS_OF),
        "mart_hse_scorecard": lambda w: marts.mart_hse_scorecard(w["fact_hse_incident"], w["fact_maintenance_workorder"], w["dim_asset"], AS_OF),
        "mart_financial_cost": lambda w: marts.mart_financial_cost(w["fact_financial_actuals"], w["dim_cost_center"], w["mart_production_kpi"], AS_OF),
        "mart_pipeline_integrity": lambda w: marts.mart_pipeline_integrity(w["fact_pipeline_flow"], AS_OF),
        "mart_executive_summary": lambda w: executive_summary(w),
    }
    partitions = {name: ["month_key"] for name in K.FACT_GATES}


def executive_summary(w: Warehouse) -> DataFrame:
    return marts.mart_executive_summary(
        w["mart_production_kpi"], w["mart_equipment_reliability"], w["mart_hse_scorecard"], w["mart_financial_cost"],
        w["mart_pipeline_integrity"], AS_OF,
    )
