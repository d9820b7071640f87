"""Dimensions of the order warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions import columns as C
from starloom.operators.scd import ORDER_HISTORY, scd1_upsert, scd2_apply

CUSTOMER_TYPE2 = ["customer_segment_cd", "lifetime_value_tier", "credit_rating_cd", "region_nm", "city_nm"]
CUSTOMER_TYPE1 = ["churn_risk_score", "is_vip_flag"]


def conform_customers(stg: DataFrame) -> DataFrame:
    return stg.select(
        F.col("customer_id").alias("customer_bk"),
        F.coalesce("customer_type", F.lit("INDIVIDUAL")).alias("customer_type_cd"),
        C.id_digest("national_id").alias("national_id_hash"),
        F.col("nationality_code").alias("nationality_cd"),
        F.col("credit_rating").alias("credit_rating_cd"),
        F.col("customer_segment").alias("customer_segment_cd"),
        "lifetime_value_tier",
        F.col("city").alias("city_nm"),
        F.col("region").alias("region_nm"),
        "postal_code",
        F.coalesce("preferred_language", F.lit("AR")).alias("preferred_language"),
        C.parse_date("activation_date").alias("activation_dt"),
        C.money("churn_risk_score", 5, 4).alias("churn_risk_score"),
        C.flag(F.col("customer_segment").isin("PLATINUM", "VIP")).alias("is_vip_flag"),
        C.flag(F.col("customer_type") == "GOV").alias("is_gov_entity"),
    )


def build_dim_customer(stg: DataFrame, target: DataFrame | None, as_of: str) -> DataFrame:
    """Type-2 on segment, tier, rating, region, city; Type-1 on churn score and VIP flag."""
    return scd2_apply(
        target, conform_customers(stg), ["customer_bk"], CUSTOMER_TYPE2, as_of, "customer_sk",
        ORDER_HISTORY, type1=CUSTOMER_TYPE1,
    )


def conform_offerings(stg: DataFrame) -> DataFrame:
    price = C.money("base_price", 14, 4)
    digest = C.change_hash(
        ["product_offering_name", "product_type", "product_family", "technology_tier", "contract_duration"],
        ORDER_HISTORY.algo, ORDER_HISTORY.sep,
    )
    return stg.select(
        F.col("product_offering_id").alias("product_offering_bk"),
        "product_offering_name",
        "product_offering_desc",
        "product_spec_id",
        "product_spec_name",
        F.upper(F.trim("product_type")).alias("product_type_cd"),
        F.upper(F.trim("product_category")).alias("product_category_cd"),
        F.col("product_family").alias("product_family_nm"),
        F.upper(F.trim("technology_tier")).alias("technology_tier"),
        F.col("is_5g").alias("is_5g_flag"),
        F.col("is_bundle").alias("is_bundle_flag"),
        C.flag(F.upper("product_type") == "IOT").alias("is_iot_flag"),
        F.col("contract_duration").try_cast("int").alias("contract_duration_months"),
        C.parse_date("launch_date").alias("launch_dt"),
        C.parse_date("end_of_sale_date").alias("end_of_sale_dt"),
        price.alias("base_price"),
        (price * F.lit("1.15").cast("decimal(3,2)")).cast("decimal(14,4)").alias("base_price_incl_vat"),
        F.coalesce("currency", F.lit("SAR")).alias("currency_cd"),
        digest.alias(ORDER_HISTORY.digest),
    )


def build_dim_offering(stg: DataFrame, target: DataFrame | None, as_of: str) -> DataFrame:
    return scd2_apply(
        target, conform_offerings(stg), ["product_offering_bk"], [], as_of, "product_offering_sk", ORDER_HISTORY
    )


def build_dim_order(ods_orders: DataFrame, target: DataFrame | None, as_of: str) -> DataFrame:
    """Order headers with history; the digest comes with the cleansed row."""
    source = ods_orders.select(
        "order_bk", "order_href", "external_id", "order_date", "requested_start_dt", "requested_completion_dt",
        "expected_completion_dt", "completion_dt", "order_state_cd", "order_category_cd", "priority_cd",
        "cancellation_reason", "cancellation_dt", "notification_contact", "segment_cd", "billing_account_id",
        "channel_cd", ORDER_HISTORY.digest,
    )
    return scd2_apply(target, source, ["order_bk"], [], as_of, "order_sk", ORDER_HISTORY, unique=True)


def build_dim_geography(reference: DataFrame, target: DataFrame | None) -> DataFrame:
    update = [c for c in reference.columns if c != "geography_bk"]
    return scd1_upsert(target, reference, ["geography_bk"], update, "geography_sk")


def build_dim_related_party(parties: DataFrame, target: DataFrame | None, as_of: str) -> DataFrame:
    tracked = [c for c in parties.columns if c != "party_bk"]
    return scd2_apply(target, parties, ["party_bk"], tracked, as_of, "party_sk", ORDER_HISTORY)


def unknown_member(dim: DataFrame, values: dict[str, object]) -> DataFrame:
    """The row that unresolved keys point to, in the layout of ``dim``."""
    history = {
        ORDER_HISTORY.eff: K.UNKNOWN_SINCE, ORDER_HISTORY.exp: K.OPEN_END, ORDER_HISTORY.flag: "Y",
    }
    values = {**history, **values}
    row = dim.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return row


def with_unknown(dim: DataFrame, values: dict[str, object]) -> DataFrame:
    return dim.unionByName(unknown_member(dim, values))


UNKNOWN_CUSTOMER = {
    "customer_sk": -1, "customer_bk": "UNKNOWN", "customer_type_cd": "UNKNOWN", "customer_segment_cd": "UNKNOWN",
    "lifetime_value_tier": "UNKNOWN", "city_nm": "Unknown", "region_nm": "Unknown", "preferred_language": "AR",
    "is_vip_flag": "N", "is_gov_entity": "N",
}
UNKNOWN_OFFERING = {
    "product_offering_sk": -1, "product_offering_bk": "UNKNOWN", "product_offering_name": "Unknown Product",
    "product_type_cd": "UNKNOWN", "product_category_cd": "UNKNOWN", "product_family_nm": "UNKNOWN",
    "technology_tier": "UNKNOWN", "is_5g_flag": "N", "is_bundle_flag": "N", "is_iot_flag": "N",
    "contract_duration_months": 0, "base_price": 0, "base_price_incl_vat": 0, "currency_cd": "SAR",
}
UNKNOWN_GEOGRAPHY = {
    "geography_sk": -1, "geography_bk": "UNKNOWN", "country_cd": "SAU", "admin_region_cd": "UNKNOWN",
    "admin_region_nm_en": "Unknown Region", "admin_region_nm_ar": "منطقة غير معروفة", "city_nm_en": "UNKNOWN",
    "has_5g_coverage": "N", "has_fiber_coverage": "N",
}
UNKNOWN_PARTY = {"party_sk": -1, "party_bk": "UNKNOWN", "party_name": "Unknown"}
