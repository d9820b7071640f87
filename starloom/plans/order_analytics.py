"""Business questions on the order star. Dates and years are parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions.columns import count_when, dbl, mean_of, ratio, sum_when, whole_hours
from starloom.operators.ordered import number_rows, with_running
from starloom.plans.star import (
    Star, in_year, on_days, segment, with_channel, with_customer, with_date, with_geography, with_offering,
    with_order, with_state,
)


def _n() -> Column:
    return F.count(F.lit(1))


def _mean(c: str | Column) -> Column:
    return mean_of(F.sum(c), F.count(c))


def _days_before(as_of: str, days: int) -> int:
    return int((dt.date.fromisoformat(as_of) - dt.timedelta(days=days)).strftime("%Y%m%d"))


def uc01a(star: Star, years: Sequence[int]) -> DataFrame:
    """Monthly technology adoption of completed orders by region."""
    fact = on_days(star["fact_order"], "date_sk", min(years) * 10000 + 101, max(years) * 10000 + 1231)
    done = with_state(star, fact, "order_state_sk", "left").filter("order_state_cd = 'completed'")
    f = with_date(star, done, "date_sk", "year_num", "month_num", "month_nm_en").filter(F.col("year_num").isin(*years))
    f = with_offering(star, f, "technology_tier")
    f = with_geography(star, f, "admin_region_nm_en", "admin_region_nm_ar", "has_5g_coverage")
    amount, tier = F.col("total_order_amount"), F.col("technology_tier")
    orders = F.count_distinct("order_sk")
    acv = {t: mean_of(F.sum(F.when(tier == t, amount)), count_when(tier == t)) for t in ("5G", "4G")}
    return f.groupBy("year_num", "month_nm_en", "month_num", F.col("admin_region_nm_en").alias("region"), "admin_region_nm_ar").agg(
        orders.alias("total_orders"),
        count_when(tier == "5G").alias("orders_5g"),
        count_when(tier == "4G").alias("orders_4g"),
        count_when(tier == "FIBER").alias("orders_fiber"),
        ratio(count_when(tier == "5G"), orders).alias("adoption_rate_5g_pct"),
        sum_when(tier == "5G", amount).alias("revenue_5g"),
        sum_when(tier == "4G", amount).alias("revenue_4g"),
        acv["5G"].alias("acv_5g"),
        acv["4G"].alias("acv_4g"),
        (acv["5G"] - acv["4G"]).alias("acv_5g_premium"),
        ratio(count_when(F.col("has_5g_coverage") == "Y"), _n()).alias("pct_orders_in_5g_area"),
    ).orderBy("year_num", "month_num", "region")


def uc01b(star: Star, year: int, n: int = 10) -> DataFrame:
    """Top 5G offerings by revenue.

    The rows above a row decide its rank, so ranking the first ``n`` is exact and
    no global window over all offerings is needed.
    """
    fact = in_year(star["fact_item"], "date_sk", year)
    f = with_offering(star, fact, "product_offering_name", "product_family_nm", "contract_duration_months",
                      how="inner", cond=F.col("is_5g_flag") == "Y")
    top = f.groupBy("product_offering_name", "product_family_nm", F.col("contract_duration_months").alias("contract_months")).agg(
        F.count("order_item_sk").alias("order_volume"),
        F.sum("item_total_amount").alias("total_revenue"),
        _mean("item_total_amount").alias("avg_item_value"),
        F.sum("item_mrc").alias("total_mrc"),
        F.sum(F.col("item_mrc") * F.col("contract_duration_months")).alias("expected_contract_value"),
    ).orderBy(F.desc("total_revenue"), "product_offering_name", "product_family_nm", "contract_months").limit(n)
    return top.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("total_revenue"))))


def uc02a(star: Star, as_of: str, days: int = 90) -> DataFrame:
    """Weekly service-level dashboard, worst first."""
    fact = on_days(star["fact_order"], "date_sk", _days_before(as_of, days))
    done = with_state(star, fact, "order_state_sk", "inner").filter("order_state_cd = 'completed'")
    f = with_channel(star, with_date(star, done, "date_sk", "year_num", "week_of_year"), "inner", "channel_cd")
    f = with_offering(star, with_order(star, f, "segment_cd"), "product_type_cd")
    ptype, hours = F.col("product_type_cd"), F.col("fulfilment_duration_hrs")
    within, orders = count_when(F.col("sla_breach_flag") == "N"), F.count_distinct("order_sk")
    rate = ratio(within, orders)
    return f.groupBy(
        "year_num", F.col("week_of_year").alias("iso_week"), "channel_cd", segment().alias("segment"),
        F.when(ptype == "FIBER", K.SLA_FIBER).when(ptype == "5G", K.SLA_5G).otherwise(K.SLA_DEFAULT)
        .cast("double").alias("sla_hrs"),
    ).agg(
        orders.alias("completed_orders"),
        within.alias("within_sla"),
        count_when(F.col("sla_breach_flag") == "Y").alias("breached_sla"),
        rate.alias("sla_compliance_pct"),
        F.when(rate >= K.SLA_COMPLIANCE_TARGET, "CITC COMPLIANT").otherwise("CITC NON-COMPLIANT").alias("sla_status"),
        _mean(hours).alias("avg_fulfilment_hrs"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY fulfilment_duration_hrs)").alias("p95_fulfilment_hrs"),
        F.max(hours).alias("max_fulfilment_hrs"),
    ).orderBy("year_num", "iso_week", "sla_compliance_pct")


def uc02b(star: Star, as_of: str, days: int = 30) -> DataFrame:
    """Where orders lose time: duration per transition."""
    fact = on_days(star["fact_transition"], "transition_date_sk", _days_before(as_of, days))
    f = fact.filter("duration_in_from_state_hrs > 0")
    f = with_state(star, f, "from_state_sk", "inner", order_state_cd="from_state")
    f = with_state(star, f, "to_state_sk", "inner", order_state_cd="to_state")
    hrs = F.col("duration_in_from_state_hrs")
    per = f.groupBy("from_state", "to_state").agg(
        _n().alias("transition_count"),
        _mean(hrs).alias("avg_hrs_in_state"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY duration_in_from_state_hrs)").alias("p95_hrs_in_state"),
        F.max(hrs).alias("max_hrs_in_state"),
        count_when(F.col("is_sla_critical_state") == "Y").alias("on_sla_critical_path"),
        (dbl(_n()) * _mean(hrs)).alias("time_impact_score"),
    )
    # at most one row per pair of seeded states, so one task is enough for the rank
    return per.withColumn("bottleneck_rank", F.rank().over(Window.orderBy(F.desc("avg_hrs_in_state")))).orderBy("bottleneck_rank")


def uc03a(star: Star, year: int) -> DataFrame:
    """Monthly expected revenue and VAT check by segment."""
    f = with_date(star, in_year(star["fact_order"], "date_sk", year), "date_sk", "year_month")
    f = with_order(star, with_state(star, f, "order_state_sk", "left"), "segment_cd")
    done = F.col("order_state_cd") == "completed"
    net, vat = F.col("order_amount_excl_vat"), F.col("vat_amount")
    vat_rate = F.when(net > 0, dbl(vat) / dbl(net) * F.lit(100.0))
    return f.groupBy(F.col("year_month").alias("report_month"), segment().alias("segment")).agg(
        count_when(done).alias("completed_orders"),
        sum_when(done, F.col("total_order_amount")).alias("expected_gross_revenue"),
        sum_when(done, net).alias("expected_net_revenue"),
        sum_when(done, vat).alias("expected_vat"),
        sum_when(done, F.col("discount_amount")).alias("total_discounts"),
        sum_when(done, F.col("recurring_charge_mrc") * 12).alias("expected_annual_mrc"),
        count_when(F.col("revenue_assurance_flag") == "Y").alias("orders_with_billing_issues"),
        F.avg(vat_rate).alias("effective_vat_rate_pct"),
        count_when(F.abs(vat_rate - K.VAT_PERCENT) > K.VAT_TOLERANCE).alias("vat_deviation_count"),
    ).orderBy("report_month", "segment")


def uc04(star: Star, year: int) -> DataFrame:
    """Channel performance with the share of each month's orders."""
    f = with_date(star, in_year(star["fact_order"], "date_sk", year), "date_sk", "year_num", "month_num", "month_nm_en")
    f = with_channel(star, f, "inner", "channel_cd", "channel_type_cd", "is_digital_flag", "medium_cd")
    f = with_state(star, f, "order_state_sk", "inner")
    orders = F.count_distinct("order_sk")
    per = f.groupBy("year_num", "month_num", "month_nm_en", "channel_cd", "channel_type_cd", "is_digital_flag", "medium_cd").agg(
        orders.alias("total_orders"),
        F.sum("total_order_amount").alias("gross_revenue"),
        _mean("total_order_amount").alias("avg_order_value"),
        F.count_distinct("customer_sk").alias("unique_customers"),
        count_when(F.col("is_new_customer_order") == "Y").alias("new_acquisitions"),
        ratio(count_when(F.col("order_state_cd") == "completed"), orders).alias("completion_rate_pct"),
        ratio(count_when(F.col("fallout_flag") == "Y"), orders).alias("fallout_rate_pct"),
        _mean("fulfilment_duration_hrs").alias("avg_fulfilment_hrs"),
        count_when(F.col("is_digital_flag") == "Y").alias("_digital"),
    )
    month_total = F.sum("total_orders").over(Window.partitionBy("year_num", "month_num"))
    return (
        per.withColumn("channel_market_share_pct", ratio(F.col("total_orders"), month_total))
        .withColumn("digital_share_of_total_pct", ratio(F.col("_digital"), month_total))
        .drop("_digital")
        .orderBy("year_num", "month_num", F.desc("total_orders"))
    )


def uc05(star: Star, customer_bk: str | None = None) -> DataFrame:
    """Order history of one customer, or of all, with running totals.

    The unknown customer can own a large share of all orders; totals therefore
    run over a global ordering that is cut inside a customer, too.
    """
    who = None if customer_bk is None else F.col("customer_bk") == customer_bk
    f = with_customer(star, star["fact_order"], "customer_bk", "customer_type_cd", "customer_segment_cd", "city_nm",
                      "region_nm", "activation_dt", "churn_risk_score", how="inner", cond=who)
    f = with_state(star, with_date(star, f, "date_sk", "full_date"), "order_state_sk", "inner", order_state_cd="current_state")
    f = with_order(star, f, "order_bk", "order_category_cd", how="inner")
    f = with_channel(star, f, "left", F.col("channel_cd").alias("order_channel"))
    f = with_offering(star, f, "product_offering_name", "product_type_cd", "technology_tier")
    slim = f.select(
        "order_sk", "customer_sk", "customer_bk", "customer_type_cd", "customer_segment_cd", "city_nm", "region_nm",
        F.col("activation_dt").alias("customer_since"), "churn_risk_score",
        F.col("full_date").alias("order_date"), F.col("order_bk").alias("order_id"),
        F.col("order_category_cd").alias("order_type"), "current_state", "order_channel", "product_offering_name",
        "product_type_cd", "technology_tier", F.col("total_order_amount").alias("order_value"),
        F.col("recurring_charge_mrc").alias("monthly_charge"), "discount_amount", "fulfilment_duration_hrs",
        "sla_breach_flag", "order_item_count",
    )
    # only keys and the amount are put in order and stored; the wide rows meet their totals by order
    ordered = number_rows(slim.select("order_sk", "customer_sk", "order_date", "order_id", "order_value"), ["customer_sk", "order_date", "order_id"])
    running = with_running(ordered, "customer_sk", {
        "cumulative_spend": F.col("order_value"), "order_sequence_num": F.lit(1),
    })
    lifetime = ordered.groupBy("customer_sk").agg(_n().alias("total_lifetime_orders"))
    totals = running.join(lifetime, "customer_sk").select("order_sk", "cumulative_spend", "order_sequence_num", "total_lifetime_orders")
    return slim.join(totals, "order_sk").drop("customer_sk", "order_sk").orderBy("order_date", "order_id")


def uc06(star: Star, as_of: str, days: int = 30, min_count: int = 5) -> DataFrame:
    """Root causes of failed orders."""
    fact = on_days(star["fact_transition"], "transition_date_sk", _days_before(as_of, days))
    t = fact.filter("change_reason_cd IS NOT NULL").select(
        "order_sk", "from_state_sk", "to_state_sk", "change_reason_cd", "change_reason_desc", "duration_in_from_state_hrs"
    )
    t = with_state(star, t, "to_state_sk", "inner", order_state_cd="to_state").filter(F.col("to_state").isin(*K.FAILURE_STATES))
    t = with_state(star, t, "from_state_sk", "inner", order_state_cd="failed_at_state")
    orders = star["fact_order"].select("order_sk", "channel_sk", "geography_sk", "product_offering_sk", "total_order_amount")
    f = with_channel(star, t.join(orders, "order_sk"), "left", "channel_cd")
    f = with_offering(star, with_geography(star, f, "admin_region_nm_en"), "product_type_cd")
    per = f.groupBy(
        F.col("change_reason_cd").alias("failure_reason"), "change_reason_desc", "failed_at_state", "channel_cd",
        F.col("admin_region_nm_en").alias("region"), "product_type_cd",
    ).agg(
        _n().alias("fallout_count"),
        _mean("duration_in_from_state_hrs").alias("avg_time_before_fallout"),
        F.sum("total_order_amount").alias("lost_revenue_estimate"),
        _mean("total_order_amount").alias("avg_lost_order_value"),
    ).filter(F.col("fallout_count") >= min_count)
    reason_total = F.sum("fallout_count").over(Window.partitionBy("failure_reason"))
    return per.withColumn("pct_of_reason", ratio(F.col("fallout_count"), reason_total)).orderBy(F.desc("fallout_count"))


def uc07(star: Star, year: int) -> DataFrame:
    """Product mix and bundles of completed items."""
    fact = in_year(star["fact_item"], "date_sk", year)
    f = with_state(star, fact, "item_state_sk", "inner").filter("order_state_cd = 'completed'")
    f = with_date(star, f, "date_sk", "year_num", "month_num")
    f = with_offering(star, f.drop("technology_tier"), "product_family_nm", "product_type_cd", "is_bundle_flag",
                      "is_5g_flag", "contract_duration_months", how="inner")
    f = with_customer(star, with_geography(star, f, "admin_region_nm_en"), "customer_segment_cd")
    contract = F.col("item_mrc") * F.coalesce("contract_months", F.lit(12))
    return f.groupBy(
        "product_family_nm", "product_type_cd", "is_bundle_flag", "is_5g_flag", "contract_duration_months",
        F.col("admin_region_nm_en").alias("region"), "customer_segment_cd", "year_num", "month_num",
    ).agg(
        F.count("order_item_sk").alias("units_ordered"),
        F.sum("item_total_amount").alias("gross_revenue"),
        F.sum("item_mrc").alias("total_mrc"),
        F.sum("item_otc").alias("total_otc"),
        _mean("item_total_amount").alias("avg_item_value"),
        _mean("item_mrc").alias("avg_mrc"),
        F.sum("item_discount_amount").alias("total_discounts"),
        ratio(F.sum("item_discount_amount"), F.sum("item_total_amount")).alias("discount_depth_pct"),
        F.sum(contract).alias("total_contract_value"),
        _mean(contract).alias("avg_contract_value"),
    ).orderBy(F.desc("gross_revenue"))


def uc08(star: Star, year: int, month: int) -> DataFrame:
    """Agent and store scorecard of one month, ranked within the region."""
    f = with_date(star, in_year(star["fact_order"], "date_sk", year, month), "date_sk", "year_num", "month_num")
    sellers = star["dim_party"].filter(
        "current_row_flag = 'Y' AND party_role_cd = 'seller' AND agent_id IS NOT NULL"
    ).select(F.col("party_sk").alias("seller_party_sk"), "agent_id", "agent_store_cd", F.col("party_name").alias("agent_name"))
    f = with_state(star, f.join(sellers, "seller_party_sk"), "order_state_sk", "inner")
    f = with_geography(star, f, F.col("admin_region_nm_en").alias("region"))
    done = F.col("order_state_cd") == "completed"
    fallout = count_when(F.col("fallout_flag") == "Y")
    per = f.groupBy("agent_id", "agent_store_cd", "agent_name", "region", "year_num", "month_num").agg(
        F.count_distinct("order_sk").alias("orders_handled"),
        F.sum("total_order_amount").alias("revenue_generated"),
        _mean("total_order_amount").alias("avg_order_value"),
        ratio(count_when(done), _n()).alias("completion_rate_pct"),
        ratio(count_when(done & (F.col("sla_breach_flag") == "N")), count_when(done)).alias("sla_compliance_pct"),
        fallout.alias("fallout_count"),
        ratio(fallout, _n()).alias("fallout_rate_pct"),
        count_when(F.col("is_new_customer_order") == "Y").alias("new_acquisitions"),
    )
    place = Window.partitionBy("region", "year_num", "month_num").orderBy(F.desc("revenue_generated"))
    return per.withColumn("region_revenue_rank", F.rank().over(place)).orderBy(F.desc("revenue_generated"))


def uc09(star: Star, year: int, month: int) -> DataFrame:
    """Share of a month's orders that ever reached each state."""
    cohort = in_year(star["fact_order"], "date_sk", year, month).select("order_sk").distinct()
    size = cohort.agg(_n()).scalar()
    reached = star["fact_transition"].select("order_sk", "to_state_sk").join(cohort, "order_sk", "left_semi").distinct()
    f = with_state(star, reached, "to_state_sk", "inner", order_state_cd="order_state_cd", sort_order="sort_order")
    per = f.groupBy("order_state_cd", "sort_order").agg(F.count_distinct("order_sk").alias("orders_reached_state"))
    return per.withColumn("_size", size).select(
        "order_state_cd", "sort_order", "orders_reached_state",
        ratio(F.col("orders_reached_state"), F.col("_size")).alias("pct_of_cohort"),
        (F.col("_size") - F.col("orders_reached_state")).alias("dropped_before_state"),
    ).orderBy("sort_order")


def uc10(star: Star, year: int) -> DataFrame:
    """VAT reconciliation with subtotals per period and Hijri month; NULL marks a subtotal."""
    f = with_date(star, in_year(star["fact_order"], "date_sk", year), "date_sk",
                  F.col("year_month").alias("tax_period"), F.col("hijri_month_nm_ar").alias("hijri_period"))
    f = with_order(star, with_state(star, f, "order_state_sk", "inner"), "segment_cd")
    done = F.col("order_state_cd") == "completed"
    fifteen = F.lit(K.VAT_RATE).cast("decimal(3,2)")
    net, vat, rebate = F.col("order_amount_excl_vat"), F.col("vat_amount"), F.col("discount_amount")
    return f.withColumn("segment", segment()).rollup("tax_period", "hijri_period", "segment").agg(
        F.grouping_id().alias("grouping_level"),
        F.count_distinct("order_sk").alias("total_taxable_transactions"),
        count_when(done).alias("completed_transactions"),
        count_when(F.col("order_state_cd") == "cancelled").alias("cancelled_transactions"),
        sum_when(done, net).alias("net_taxable_revenue"),
        sum_when(done, vat).alias("vat_output"),
        sum_when(done, net * fifteen).alias("vat_recomputed"),
        F.abs(sum_when(done, vat) - sum_when(done, net * fifteen)).alias("vat_variance"),
        sum_when(done, F.col("total_order_amount")).alias("gross_revenue_incl_vat"),
        sum_when(done, rebate).alias("discounts_given"),
        sum_when(done, rebate * fifteen).alias("vat_on_discounts"),
    ).orderBy("tax_period", "segment")


def order_pulse(star: Star, as_of: str) -> DataFrame:
    """Orders of one day by state, channel and segment."""
    day = int(as_of.replace("-", ""))
    f = with_state(star, on_days(star["fact_order"], "date_sk", day, day), "order_state_sk", "inner")
    f = with_order(star, with_channel(star, f, "inner", "channel_cd"), "segment_cd")
    return f.groupBy("order_state_cd", "channel_cd", segment().alias("segment")).agg(
        _n().alias("orders_count"),
        F.sum("total_order_amount").alias("revenue"),
        _mean("total_order_amount").alias("avg_order"),
        count_when(F.col("sla_breach_flag") == "Y").alias("sla_breaches"),
    )


def stuck_orders(star: Star, as_of_ts: str, age_hours: int = 24, lookback_days: int = 7) -> DataFrame:
    """Recent orders that are neither finished nor young."""
    fact = on_days(star["fact_order"], "date_sk", _days_before(as_of_ts[:10], lookback_days))
    f = with_state(star, fact, "order_state_sk", "inner", order_state_cd="current_state", is_terminal_state="_end").filter("_end = 'N'")
    f = with_order(star, f, "order_bk", "order_date", "segment_cd", how="inner")
    f = with_channel(star, f, "left", "channel_cd")
    left = F.col("sla_remaining_hrs")
    return f.withColumn("age_hours", whole_hours(F.col("order_date"), F.lit(as_of_ts).cast("timestamp_ntz"))).filter(
        F.col("age_hours") > age_hours
    ).select(
        F.col("order_bk").alias("order_id"), "order_date", "current_state", "channel_cd", segment().alias("segment"),
        F.col("total_order_amount").alias("order_value"), "sla_target_hrs", "sla_remaining_hrs",
        F.when(left < 0, "BREACHED").when(left < 2, "AT_RISK").otherwise("OK").alias("sla_status"), "age_hours",
    ).orderBy(F.desc("age_hours"))
