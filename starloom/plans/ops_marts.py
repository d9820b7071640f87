"""KPI marts of the operations pipeline and their alert views.

Each builder covers every month present in its inputs up to ``as_of``, or the
months asked for. All monthly measures add up, so a builder can start from the
rows of a fact or from stored sums of days (:mod:`starloom.plans.month_state`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions.columns import dbl, ratio

MONTH = "year_month"


def _until(fact: DataFrame, as_of: str, months: Sequence[int] | None = None) -> DataFrame:
    """Rows up to a day; of ``months`` (such as 202401) alone if they are given, which prunes the files of a fact cut by month."""
    last = int(as_of.replace("-", ""))
    until = fact.filter(F.col("date_key") <= last)
    if "month_key" in fact.columns:
        until = until.filter(F.col("month_key") <= last // 100)
    if months is None:
        return until
    if "month_key" in fact.columns:
        return until.filter(F.col("month_key").isin(*months))
    return until.filter(F.floor(F.col("date_key") / 100).isin(*months))


def _month() -> Column:
    digits = F.col("date_key").cast("string")
    return F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2))


def _stamped(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols, F.current_timestamp().alias("_adl_load_ts"))


def _current(dim: DataFrame, *cols: str) -> DataFrame:
    return dim.filter("current_row_flag = 'Y'").select(*cols)


def mart_production_kpi(fact: DataFrame, dim_well_field: DataFrame) -> DataFrame:
    """Field by day: volumes, efficiency against plan (at most 100 %), uptime."""
    wells = _current(dim_well_field, "well_field_sk", "field_id")
    sums = fact.join(wells, "well_field_sk").groupBy("date_key", "field_id").agg(
        F.sum("oil_volume_bbl").alias("total_oil_bbl"),
        F.sum("gas_volume_mscf").alias("total_gas_mscf"),
        F.sum("water_volume_bbl").alias("total_water_bbl"),
        F.sum("planned_volume_bbl").alias("planned_volume_bbl"),
        (F.avg(F.col("uptime_hours") / 24.0) * 100.0).alias("uptime_pct"),
    )
    actual, plan = F.col("total_oil_bbl"), F.col("planned_volume_bbl")
    reached = F.when(plan > 0, F.least(F.lit(100.0), actual / plan * 100.0)).otherwise(F.lit(100.0))
    return _stamped(
        sums, "date_key", "field_id", "total_oil_bbl", "total_gas_mscf", "total_water_bbl", "planned_volume_bbl",
        reached.alias("production_efficiency_pct"), "uptime_pct",
    )


@dataclass(frozen=True)
class Partials:
    """Aggregates that can be added up: of one month at once, or of each day and then of the days of a month.

    ``sums`` are SQL aggregates over fact rows, all of which add up by ``sum``.
    """

    keys: tuple[str, ...]
    sums: Mapping[str, str]

    def by(self, fact: DataFrame, *first: str | Column) -> DataFrame:
        return fact.groupBy(*first, *self.keys).agg(*(F.expr(e).alias(n) for n, e in self.sums.items()))

    def of_days(self, fact: DataFrame) -> DataFrame:
        """A row per day and key, with the month it belongs to."""
        return self.by(fact, "date_key").withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int"))

    def of_months(self, fact: DataFrame) -> DataFrame:
        return self.by(fact, _month().alias(MONTH))

    def folded(self, days: DataFrame) -> DataFrame:
        """Rows of days added up to months."""
        return days.groupBy(_month().alias(MONTH), *self.keys).agg(*(F.sum(n).alias(n) for n in self.sums))


RELIABILITY = Partials(("asset_sk",), {"failures": "count(1)", "down": "sum(downtime_hours)"})
INCIDENTS = Partials(("facility_id",), {"incidents": "count(1)", "lost_time": "count_if(incident_type = 'LTI')", "workdays": "sum(lost_workdays)"})
LABOR = Partials(("asset_sk",), {"hours": "sum(labor_hours)"})
COST = Partials(("cost_center_sk",), {"actual": "sum(actual_amount_usd)", "budget": "sum(budget_amount_usd)"})
FLOW = Partials(("pipeline_segment_id",), {
    "volume": "sum(avg_flow_rate_bpd)", "readings": "count(avg_flow_rate_bpd)", "alarms": "sum(leak_alarm_count)", "critical": "sum(critical_alarm_count)"})


def mart_equipment_reliability(downtime: DataFrame, dim_asset: DataFrame, as_of: str, months: Sequence[int] | None = None) -> DataFrame:
    """Asset by month: failures, MTBF, MTTR, availability. The running month counts elapsed days."""
    return reliability_of(RELIABILITY.of_months(_until(downtime, as_of, months)), dim_asset, as_of)


def reliability_of(per: DataFrame, dim_asset: DataFrame, as_of: str) -> DataFrame:
    f = per.join(_current(dim_asset, "asset_sk", "asset_id", "facility_id"), "asset_sk")
    last = F.least(F.last_day(F.to_date(F.concat(MONTH, F.lit("-01")))), F.lit(as_of).cast("date"))
    period = F.dayofmonth(last) * 24.0
    down, n = F.coalesce("down", F.lit(0.0)), F.col("failures").cast("int")
    return _stamped(
        f, MONTH, "asset_id", "facility_id", n.alias("failure_count"), down.alias("total_downtime_hours"),
        ((period - down) / n).alias("mtbf_hours"), (down / n).alias("mttr_hours"),
        F.greatest(F.lit(0.0), (period - down) / period * 100.0).alias("availability_pct"),
    )


def mart_hse_scorecard(incidents: DataFrame, work_orders: DataFrame, dim_asset: DataFrame, as_of: str, months: Sequence[int] | None = None) -> DataFrame:
    """Facility by month: incident rates per 200 000 hours, booked labour standing in for hours worked."""
    # labour per asset first: the asset join then sees one row per asset and month
    return scorecard_of(
        INCIDENTS.of_months(_until(incidents, as_of, months)), LABOR.of_months(_until(work_orders, as_of, months)), dim_asset)


def scorecard_of(counted: DataFrame, per_asset: DataFrame, dim_asset: DataFrame) -> DataFrame:
    labor = per_asset.join(_current(dim_asset, "asset_sk", "facility_id"), "asset_sk").groupBy(MONTH, "facility_id").agg(
        F.sum("hours").alias("labor_hours_worked")
    )
    f = counted.join(labor, [MONTH, "facility_id"], "left").fillna(0.0, ["labor_hours_worked"]).select(
        MONTH, "facility_id", F.col("incidents").cast("int").alias("total_incidents"), F.col("lost_time").cast("int").alias("lost_time_incidents"),
        F.coalesce("workdays", F.lit(0)).cast("int").alias("total_lost_workdays"), "labor_hours_worked")
    hours = F.col("labor_hours_worked")
    rate = lambda n: F.when(hours > 0, F.col(n) * F.lit(K.INCIDENT_RATE_HOURS) / hours)
    return _stamped(f, *f.columns, rate("total_incidents").alias("trir"), rate("lost_time_incidents").alias("ltir"))


def mart_financial_cost(actuals: DataFrame, dim_cost_center: DataFrame, production_kpi: DataFrame, as_of: str, months: Sequence[int] | None = None) -> DataFrame:
    """Cost centre by month against budget; unit cost for upstream centres only.

    Company production per month is a joined aggregate, never a driver value.
    """
    produced = _until(production_kpi, as_of, months).groupBy(_month().alias(MONTH)).agg(F.sum("total_oil_bbl").alias("production_bbl"))
    return cost_of(COST.of_months(_until(actuals, as_of, months)), dim_cost_center, produced)


def cost_of(per_key: DataFrame, dim_cost_center: DataFrame, produced: DataFrame) -> DataFrame:
    centers = dim_cost_center.select("cost_center_sk", "cost_center_code", "business_domain")
    cost = per_key.join(centers, "cost_center_sk").groupBy(MONTH, "cost_center_code", "business_domain").agg(
        F.sum("actual").cast("decimal(18,2)").alias("actual_cost_usd"), F.sum("budget").cast("decimal(18,2)").alias("budget_cost_usd")
    )
    f = cost.join(produced, MONTH, "left").fillna(0.0, ["production_bbl"])
    actual, budget, bbl = F.col("actual_cost_usd"), F.col("budget_cost_usd"), F.col("production_bbl")
    upstream = (F.col("business_domain") == "upstream") & (bbl > 0)
    return _stamped(
        f, MONTH, "cost_center_code", "business_domain", "actual_cost_usd", "budget_cost_usd",
        ratio(actual - budget, budget).alias("variance_pct"), "production_bbl",
        F.when(upstream, dbl(actual) / bbl).alias("cost_per_bbl_usd"),
    )


def mart_pipeline_integrity(flow: DataFrame, as_of: str, months: Sequence[int] | None = None) -> DataFrame:
    """Segment by month: average flow and alarms per 1000 barrels of summed daily flow."""
    return integrity_of(FLOW.of_months(_until(flow, as_of, months)))


def integrity_of(per: DataFrame) -> DataFrame:
    volume, alarms = F.col("volume"), F.col("alarms")
    return _stamped(
        per, MONTH, "pipeline_segment_id", (volume / F.col("readings")).alias("avg_flow_rate_bpd"), alarms.cast("int").alias("total_alarms"),
        F.col("critical").cast("int").alias("critical_alarms"), F.when(volume > 0, alarms / (volume / 1000.0)).alias("alarm_rate_per_1000bbl"),
    )


def mart_executive_summary(
    production: DataFrame, reliability: DataFrame, hse: DataFrame, financial: DataFrame, pipeline: DataFrame, as_of: str,
) -> DataFrame:
    """One company row per month that has data in any mart.

    Five small monthly aggregates are stacked and folded; nothing goes through the driver.
    """
    parts = [
        _until(production, as_of).groupBy(_month().alias(MONTH)).agg(
            F.sum("total_oil_bbl").alias("total_oil_bbl"), F.avg("production_efficiency_pct").alias("production_efficiency_pct")),
        reliability.groupBy(MONTH).agg(F.avg("availability_pct").alias("avg_asset_availability_pct")),
        hse.groupBy(MONTH).agg(F.avg("trir").alias("trir"), F.avg("ltir").alias("ltir")),
        financial.groupBy(MONTH).agg(
            F.sum("actual_cost_usd").cast("decimal(18,2)").alias("total_cost_usd"), F.avg("cost_per_bbl_usd").alias("avg_cost_per_bbl_usd")),
        pipeline.groupBy(MONTH).agg(F.sum("critical_alarms").cast("int").alias("critical_pipeline_alarms")),
    ]
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p, allowMissingColumns=True)
    kpis = [c for c in stacked.columns if c != MONTH]
    return _stamped(stacked.groupBy(MONTH).agg(*[F.max(c).alias(c) for c in kpis]), MONTH, *kpis)


def vw_exec_dashboard_latest(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col(MONTH) == summary.agg(F.max(MONTH)).scalar())


def vw_hse_alert_facilities(scorecard: DataFrame) -> DataFrame:
    return scorecard.filter(F.col("trir") > K.TRIR_ALERT).select(
        "facility_id", MONTH, "trir", "ltir", "total_incidents"
    ).orderBy(F.desc("trir"))


def vw_reliability_watchlist(reliability: DataFrame) -> DataFrame:
    return reliability.filter(F.col("availability_pct") < K.AVAILABILITY_WATCH).select(
        "asset_id", "facility_id", MONTH, "mtbf_hours", "mttr_hours", "availability_pct"
    ).orderBy("availability_pct")
