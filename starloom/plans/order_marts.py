"""KPI marts over the order star and the views on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions.columns import count_when, mean_of, ratio, sum_when
from starloom.operators.asof import merge_as_of
from starloom.plans.star import (
    Star, in_year, on_days, segment, with_channel, with_date, with_geography, with_offering, with_order, with_state,
)


def _n() -> Column:
    return F.count(F.lit(1))


def order_kpi(star: Star, load_date: str | None = None) -> DataFrame:
    """Daily order KPIs over twelve keys; one day, or every day in the fact."""
    fact = star["fact_order"]
    if load_date:
        key = int(load_date.replace("-", ""))
        fact = on_days(fact, "date_sk", key, key)
    f = with_date(star, fact, "date_sk", "full_date")
    f = with_channel(star, f, "left", "channel_cd")
    f = with_state(star, f, "order_state_sk", "left")
    f = with_order(star, f, "segment_cd")
    f = with_offering(star, f, "product_type_cd", "product_family_nm", "technology_tier")
    f = with_geography(star, f, "admin_region_cd")
    unknown = F.lit("UNKNOWN")
    state, hours, amount = F.col("order_state_cd"), F.col("fulfilment_duration_hrs"), F.col("total_order_amount")
    is_ = lambda c: F.col(c) == "Y"
    completed = state == "completed"
    kept_sla = (F.col("sla_breach_flag") == "N") & completed
    return f.groupBy(
        F.col("date_sk").alias("kpi_date_sk"),
        F.col("full_date").alias("kpi_date"),
        F.coalesce("channel_cd", unknown).alias("channel_cd"),
        F.coalesce("order_state_cd", unknown).alias("order_state_cd"),
        F.coalesce("order_category_cd", unknown).alias("order_category_cd"),
        segment().alias("segment_cd"),
        F.coalesce("admin_region_cd", unknown).alias("admin_region_cd"),
        F.coalesce("product_type_cd", unknown).alias("product_type_cd"),
        F.coalesce("product_family_nm", unknown).alias("product_family_nm"),
        F.coalesce("technology_tier", unknown).alias("technology_tier"),
        F.coalesce("is_5g_order", F.lit("N")).alias("is_5g_flag"),
        F.coalesce("is_bundle_order", F.lit("N")).alias("is_bundle_flag"),
    ).agg(
        _n().alias("total_orders"),
        count_when(completed).alias("completed_orders"),
        count_when(state == "cancelled").alias("cancelled_orders"),
        count_when(state == "failed").alias("failed_orders"),
        count_when(state.isin("pending", "held")).alias("pending_orders"),
        F.sum(amount).alias("gross_order_value"),
        F.sum(amount - F.col("discount_amount")).alias("net_order_value"),
        F.sum("vat_amount").alias("vat_collected"),
        F.sum("recurring_charge_mrc").alias("total_mrc"),
        F.sum("one_time_charge_otc").alias("total_otc"),
        F.sum("discount_amount").alias("total_discount"),
        mean_of(F.sum(amount), F.count(amount)).alias("avg_order_value"),
        F.sum("expected_annual_revenue").alias("expected_annual_revenue"),
        count_when(is_("sla_breach_flag")).alias("sla_breached_orders"),
        count_when(kept_sla).alias("sla_compliant_orders"),
        ratio(count_when(kept_sla), count_when(completed)).alias("sla_compliance_rate_pct"),
        mean_of(F.sum(hours), F.count(hours)).alias("avg_fulfilment_hrs"),
        F.max(hours).alias("max_fulfilment_hrs"),
        count_when(hours <= 24).alias("orders_within_24hrs"),
        count_when(hours <= 48).alias("orders_within_48hrs"),
        count_when(is_("fallout_flag")).alias("fallout_orders"),
        ratio(count_when(is_("fallout_flag")), _n()).alias("fallout_rate_pct"),
        F.count_distinct("customer_sk").alias("unique_customers"),
        count_when(is_("is_new_customer_order")).alias("new_customer_orders"),
        count_when(is_("is_upgrade_order")).alias("upgrade_orders"),
        count_when(is_("is_digital_channel")).alias("digital_orders"),
        ratio(count_when(is_("is_digital_channel")), _n()).alias("digital_order_share_pct"),
        count_when(is_("is_bundle_order")).alias("bundle_orders"),
        count_when(is_("is_5g_order")).alias("order_5g_count"),
        F.sum("order_item_count").alias("total_order_items"),
        mean_of(F.sum("order_item_count"), F.count("order_item_count")).alias("avg_items_per_order"),
    )


def sla_compliance(star: Star, month: str | None = None) -> DataFrame:
    """Monthly service-level report rolled up over service type, segment and region.

    A subtotal is labelled ALL and a missing value UNKNOWN, so the two never merge;
    ``grouping_level`` tells them apart as well.
    """
    fact = star["fact_order"]
    if month:
        y, m = (int(p) for p in month.split("-"))
        fact = in_year(fact, "date_sk", y, m)
    done = with_state(star, fact, "order_state_sk", "inner").filter("order_state_cd = 'completed'")
    f = with_date(star, done, "date_sk", F.col("year_month").alias("report_period"))
    f = with_geography(star, with_offering(star, with_order(star, f, "segment_cd"), "product_type_cd"), "admin_region_cd")
    hours, breached = F.col("fulfilment_duration_hrs"), F.col("sla_breach_flag") == "Y"
    over = hours - F.col("sla_target_hrs")
    keys = ["service_type", "segment_cd", "admin_region_cd"]
    slim = f.select(
        "report_period",
        F.coalesce("product_type_cd", F.lit("UNKNOWN")).alias("service_type"),
        F.coalesce("segment_cd", F.lit("UNKNOWN")).alias("segment_cd"),
        F.coalesce("admin_region_cd", F.lit("UNKNOWN")).alias("admin_region_cd"),
        hours.alias("hours"),
        breached.alias("breached"),
        F.when(breached & (over <= K.BREACH_SLIGHT), "SLIGHT").when(breached & (over <= K.BREACH_MODERATE), "MODERATE")
        .when(breached, "SEVERE").alias("breach_class"),
    )
    sets = [["report_period", *keys[:n]] for n in (3, 2, 1, 0)]
    within = ratio(count_when(~F.col("breached")), _n())
    rolled = slim.groupingSets(sets, "report_period", *keys).agg(
        F.grouping_id().alias("grouping_level"),
        _n().alias("total_orders"),
        count_when(~F.col("breached")).alias("orders_within_sla"),
        count_when(F.col("breached")).alias("orders_breached_sla"),
        within.alias("sla_compliance_rate"),
        F.when(within >= K.SLA_COMPLIANCE_TARGET, "Y").otherwise("N").alias("is_compliant"),
        mean_of(F.sum("hours"), F.count("hours")).alias("avg_fulfilment_hrs"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY hours)").alias("p95_fulfilment_hrs"),
        F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY hours)").alias("p99_fulfilment_hrs"),
        F.max("hours").alias("max_fulfilment_hrs"),
        count_when(F.col("breach_class") == "SLIGHT").alias("breach_0_6hrs"),
        count_when(F.col("breach_class") == "MODERATE").alias("breach_6_24hrs"),
        count_when(F.col("breach_class") == "SEVERE").alias("breach_24hrs_plus"),
    )
    first_day = F.to_date(F.concat("report_period", F.lit("-01")))
    label = {k: F.coalesce(k, F.lit("ALL")) for k in keys}
    return rolled.select(
        (F.year(first_day) * 10000 + F.month(first_day) * 100 + 1).alias("report_date_sk"),
        first_day.alias("report_date"),
        "report_period",
        *[label[k].alias(k) for k in keys],
        F.when(label["service_type"] == "FIBER", K.SLA_FIBER).when(label["service_type"] == "5G", K.SLA_5G)
        .otherwise(K.SLA_DEFAULT).cast("double").alias("sla_threshold_hrs"),
        *[c for c in rolled.columns if c not in ("report_period", *keys)],
        F.lit(K.SLA_COMPLIANCE_TARGET).alias("target_rate"),
    )


def adoption(star: Star) -> DataFrame:
    """Technology adoption per day, region, segment and product family."""
    f = with_date(star, star["fact_order"], "date_sk", F.col("full_date").alias("report_date"))
    f = with_order(star, f, "segment_cd")
    f = with_offering(star, f, "technology_tier", "product_family_nm")
    f = with_geography(star, f, "admin_region_cd", "admin_region_nm_en", "has_5g_coverage")
    amount, tier = F.col("total_order_amount"), F.col("technology_tier")
    value = {t: mean_of(F.sum(F.when(tier == t, amount)), count_when(tier == t)) for t in ("5G", "4G")}
    return f.groupBy(
        F.col("date_sk").alias("report_date_sk"), "report_date",
        F.coalesce("admin_region_cd", F.lit("UNKNOWN")).alias("admin_region_cd"), "admin_region_nm_en",
        segment().alias("segment_cd"), "product_family_nm",
    ).agg(
        _n().alias("total_orders_all"),
        count_when(tier == "5G").alias("orders_5g"),
        count_when(tier == "4G").alias("orders_4g"),
        count_when(tier == "FIBER").alias("orders_fiber"),
        ratio(count_when(tier == "5G"), _n()).alias("adoption_rate_5g_pct"),
        ratio(count_when(tier == "FIBER"), _n()).alias("adoption_rate_fiber_pct"),
        sum_when(tier == "5G", amount).alias("revenue_5g"),
        sum_when(tier == "4G", amount).alias("revenue_4g"),
        value["5G"].alias("avg_contract_value_5g"),
        value["4G"].alias("avg_contract_value_4g"),
        ratio(value["5G"] - value["4G"], value["4G"]).alias("acv_uplift_5g_vs_4g_pct"),
        ratio(count_when(F.col("has_5g_coverage") == "Y"), _n()).alias("pct_orders_in_5g_coverage"),
    )


def revenue_assurance(star: Star, billing: DataFrame) -> DataFrame:
    """Expected against billed revenue of completed orders, per month, segment and product type.

    ``billing``: ``order_id, billed_amount, billed_vat``; several charges per order add up.
    """
    charges = billing.groupBy(F.col("order_id").alias("order_bk")).agg(
        F.sum("billed_amount").alias("billed"), F.sum("billed_vat").alias("billed_vat")
    )
    done = with_state(star, star["fact_order"], "order_state_sk", "inner").filter("order_state_cd = 'completed'")
    f = with_date(star, done, "date_sk", "year_month")
    f = with_order(star, f, "segment_cd", "order_bk")
    f = with_offering(star, f, "product_type_cd").join(charges, "order_bk", "left")
    expected, billed = F.col("total_order_amount"), F.col("billed")
    unbilled = billed.isNull()
    under, over = expected - billed > K.BILLING_TOLERANCE, billed - expected > K.BILLING_TOLERANCE
    leak = sum_when(under, expected - billed) + sum_when(unbilled, expected)
    first_day = F.to_date(F.concat("report_month", F.lit("-01")))
    out = f.groupBy(
        F.col("year_month").alias("report_month"), segment().alias("segment_cd"),
        F.coalesce("product_type_cd", F.lit("UNKNOWN")).alias("product_type_cd"),
    ).agg(
        _n().alias("completed_orders"),
        F.sum(expected).alias("expected_total_revenue"),
        F.sum("recurring_charge_mrc").alias("expected_mrc"),
        F.sum("one_time_charge_otc").alias("expected_otc"),
        F.sum("vat_amount").alias("expected_vat"),
        count_when(unbilled).alias("orders_no_billing_record"),
        count_when(under | over).alias("orders_billing_mismatch"),
        count_when(over).alias("orders_overbilled"),
        count_when(under).alias("orders_underbilled"),
        sum_when(under, expected - billed).alias("underbilling_amount"),
        sum_when(over, billed - expected).alias("overbilling_amount"),
        sum_when(unbilled, expected).alias("uncollected_revenue"),
        leak.alias("total_leakage_amount"),
        F.coalesce(F.sum("billed_vat"), F.lit(0)).alias("vat_billed"),
        (F.sum("vat_amount") - F.coalesce(F.sum("billed_vat"), F.lit(0))).alias("vat_variance"),
        ratio(leak, F.sum(expected)).alias("leakage_rate_pct"),
    )
    return out.select(
        (F.year(first_day) * 10000 + F.month(first_day) * 100 + 1).alias("report_date_sk"),
        first_day.alias("report_date"), "*",
    )


def vw_exec_order_summary(kpi: DataFrame) -> DataFrame:
    """Monthly totals; the weighted average stands next to the average of averages."""
    total = F.sum("total_orders")
    return kpi.groupBy(F.date_format("kpi_date", "yyyy-MM").alias("report_month")).agg(
        total.alias("monthly_orders"),
        F.sum("completed_orders").alias("completed"),
        F.sum("cancelled_orders").alias("cancelled"),
        F.sum("failed_orders").alias("failed"),
        F.sum("gross_order_value").alias("gross_revenue"),
        F.sum("net_order_value").alias("net_revenue"),
        F.sum("vat_collected").alias("vat"),
        F.sum("total_discount").alias("discounts"),
        F.avg("avg_order_value").alias("avg_order_value"),
        mean_of(F.sum("gross_order_value"), total).alias("avg_order_value_weighted"),
        F.sum("digital_orders").alias("digital_orders"),
        ratio(F.sum("digital_orders"), total).alias("digital_share_pct"),
        F.sum("order_5g_count").alias("orders_5g"),
        ratio(F.sum("order_5g_count"), total).alias("pct_5g_adoption"),
        F.avg("sla_compliance_rate_pct").alias("avg_sla_compliance_pct"),
        F.sum("fallout_orders").alias("fallout_orders"),
        F.avg("fallout_rate_pct").alias("avg_fallout_rate_pct"),
    ).orderBy(F.desc("report_month"))


def vw_channel_comparison(kpi: DataFrame) -> DataFrame:
    """Digital against physical sales; the type comes from the channel's digital share."""
    kind = F.when(F.col("digital_orders") > 0, "DIGITAL").otherwise("PHYSICAL")
    return kpi.groupBy("kpi_date", "channel_cd", kind.alias("channel_type")).agg(
        F.sum("total_orders").alias("orders"),
        F.sum("net_order_value").alias("revenue"),
        F.avg("avg_order_value").alias("avg_order"),
        F.avg("sla_compliance_rate_pct").alias("sla_compliance_pct"),
        F.avg("fallout_rate_pct").alias("fallout_rate_pct"),
    )


def vw_5g_regional_adoption(kpi: DataFrame) -> DataFrame:
    return kpi.groupBy(F.date_format("kpi_date", "yyyy-MM").alias("report_month"), "admin_region_cd").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("order_5g_count").alias("orders_5g"),
        ratio(F.sum("order_5g_count"), F.sum("total_orders")).alias("pct_5g_adoption"),
        F.sum("gross_order_value").alias("total_revenue"),
        sum_when(F.col("is_5g_flag") == "Y", F.col("gross_order_value")).alias("revenue_5g"),
    )


def sales_by_segment(ods_orders: DataFrame, dim_customer: DataFrame, since: str, as_recorded: bool = True) -> DataFrame:
    """Orders and revenue by month and customer segment.

    ``as_recorded`` takes the segment that the customer had on the day of the
    order; otherwise today's. Orders before ``since``, the first load of the
    dimension, count on that day, as nothing earlier was recorded.
    """
    people = dim_customer.select("customer_bk", F.col("customer_segment_cd").alias("segment"), "row_eff_dt", "row_exp_dt", "current_row_flag")
    orders = ods_orders.select("order_bk", "customer_bk", "order_date", "total_order_amount").withColumn(
        "recorded_on", F.greatest(F.to_date("order_date"), F.lit(since).cast("date")))
    if as_recorded:
        dated = merge_as_of(orders, people.drop("current_row_flag"), ["customer_bk"], "recorded_on")
    else:
        dated = orders.join(people.filter("current_row_flag = 'Y'").select("customer_bk", "segment"), "customer_bk", "left")
    return dated.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month"), F.coalesce("segment", F.lit("UNKNOWN")).alias("segment")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_order_amount").alias("revenue"))
