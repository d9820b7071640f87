"""Typed, standardised, de-duplicated order headers and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import columns as C
from starloom.operators.keyed import latest_per_key
from starloom.session import written


#: What a cleansed header is made of.
HEADER = (
    "order_id", "stg_load_dt", "stg_record_id", "order_href", "external_id", "order_date", "requested_start_date",
    "requested_completion_dt", "expected_completion_dt", "completion_date", "order_state", "category", "priority",
    "cancellation_reason", "notification_contact", "channel_name", "channel_id", "customer_id", "billing_account_id",
    "seller_id", "segment", "order_item_count", "total_amount", "vat_amount", "discount_amount", "region_code",
    "stg_source_system", "stg_batch_id",
)


def _zero() -> Column:
    return F.lit(0).cast("decimal(14,2)")


def _newest(valid: DataFrame) -> DataFrame:
    """One row per order, the latest load.

    Ids that come more than once are found first, from ids alone. Only their
    rows travel to their key; all others are the only ones of their order.
    """
    copied = written(valid.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("order_id"), "copied_orders")
    rows, known = valid.select(*HEADER), F.col("order_id").isNotNull()
    meet = rows.join(copied, "order_id", "left_semi").unionByName(rows.filter(~known))
    alone = rows.filter(known).join(copied, "order_id", "left_anti")
    return alone.unionByName(latest_per_key(meet.select(*HEADER), ["order_id"], ["stg_load_dt", "stg_record_id"]))


def cleanse_orders(stg_orders: DataFrame, batch_id: str) -> DataFrame:
    """Valid headers of one batch, one row per order (latest load wins)."""
    valid = stg_orders.filter((F.col("stg_batch_id") == batch_id) & (F.col("stg_record_status") == "V"))
    newest = _newest(valid)
    no_amount = F.lit(0).cast("decimal(18,2)")
    total = F.coalesce(C.money("total_amount"), no_amount)
    vat = C.money("vat_amount")
    nothing = F.lit(None).cast("string")
    return newest.select(
        F.col("order_id").alias("order_bk"),
        "order_href",
        "external_id",
        C.parse_ts("order_date").alias("order_date"),
        C.parse_date("requested_start_date").alias("requested_start_dt"),
        C.parse_date("requested_completion_dt").alias("requested_completion_dt"),
        C.parse_date("expected_completion_dt").alias("expected_completion_dt"),
        C.parse_ts("completion_date").alias("completion_dt"),
        C.std_state("order_state").alias("order_state_cd"),
        C.std_category("category").alias("order_category_cd"),
        F.col("priority").alias("priority_cd"),
        "cancellation_reason",
        F.lit(None).cast("date").alias("cancellation_dt"),
        C.mask_contact("notification_contact").alias("notification_contact"),
        C.std_channel("channel_name", "channel_id").alias("channel_cd"),
        F.col("customer_id").alias("customer_bk"),
        "billing_account_id",
        F.col("seller_id").alias("seller_party_bk"),
        C.std_segment("segment").alias("segment_cd"),
        F.col("order_item_count").try_cast("int").alias("order_item_count"),
        total.alias("total_order_amount"),
        C.without_vat(total).alias("order_amount_excl_vat"),
        F.when(vat > 0, vat).otherwise(C.vat_share(total)).alias("vat_amount"),
        F.coalesce(C.money("discount_amount"), no_amount).alias("discount_amount"),
        _zero().alias("recurring_charge_mrc"),
        _zero().alias("one_time_charge_otc"),
        nothing.alias("delivery_city"),
        F.col("region_code").alias("delivery_region"),
        nothing.alias("delivery_postal_code"),
        F.col("stg_source_system").alias("source_system_cd"),
        "stg_batch_id",
        C.change_hash(
            [F.upper(F.trim("order_state")), "expected_completion_dt", "requested_completion_dt",
             F.upper(F.trim("segment"))], "md5", "",
        ).alias("change_hash"),
        F.lit("I").alias("record_action"),
    )


def cleanse_items(stg_items: DataFrame, batch_id: str) -> DataFrame:
    """Valid item rows with prices on both VAT bases and a masked number."""
    price = C.money("price_amount", 14, 4)
    gross = F.col("price_tax_included_flag").isin("Y", "true")
    rate = F.lit("1.15").cast("decimal(3,2)")
    excl = F.when(gross, price / rate).otherwise(price).cast("decimal(14,4)")
    incl = F.when(gross, price).otherwise(price * rate).cast("decimal(14,4)")
    qty = F.coalesce(F.col("item_quantity").try_cast("int"), F.lit(1))
    yes = lambda c: C.flag(F.lower(F.trim(c)).isin("true", "y"))
    recurring = F.col("price_type") == "recurring"
    valid = stg_items.filter(
        (F.col("stg_batch_id") == batch_id) & (F.col("stg_record_status") == "V") & ~C.is_blank("order_id")
    )
    priced = valid.withColumn("_excl", excl).withColumn("_incl", incl).withColumn("_qty", qty)
    amount = F.col("_incl").cast("decimal(14,2)")
    return priced.select(
        F.col("order_id").alias("order_bk"),
        "order_item_id",
        C.std_state("item_state").alias("item_state_cd"),
        F.col("action").alias("action_cd"),
        F.col("product_offering_id").alias("product_offering_bk"),
        F.col("product_spec_id").alias("product_spec_bk"),
        F.col("_qty").alias("item_quantity"),
        F.col("_excl").alias("unit_price_excl_vat"),
        F.col("_incl").alias("unit_price_incl_vat"),
        (F.col("_incl") * F.col("_qty")).cast("decimal(18,2)").alias("item_total_amount"),
        C.money("discount_amount").alias("item_discount_amount"),
        F.when(recurring, amount).otherwise(_zero()).alias("item_mrc"),
        F.when(recurring, _zero()).otherwise(amount).alias("item_otc"),
        (F.col("_excl") * F.lit("0.15").cast("decimal(3,2)") * F.col("_qty")).cast("decimal(14,2)")
        .alias("item_vat_amount"),
        C.mask_contact("product_msisdn").alias("product_msisdn_masked"),
        F.col("product_sim_type").alias("sim_type_cd"),
        F.col("product_contract_months").try_cast("int").alias("contract_months"),
        F.upper("technology_tier").alias("technology_tier"),
        yes("is_5g").alias("is_5g_item"),
        yes("is_bundle").alias("is_bundle_item"),
        F.col("shipping_city").alias("delivery_city"),
        F.col("shipping_region").alias("delivery_region"),
        F.col("shipping_postcode").alias("delivery_postal_code"),
        F.col("stg_load_dt").alias("ods_load_dt"),
        "stg_batch_id",
    )
