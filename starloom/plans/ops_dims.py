"""Dimensions of the operations pipeline (assets, wells, cost centres, products, parties)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions.columns import family_of
from starloom.operators.keyed import latest_per_key
from starloom.operators.scd import scd1_upsert, scd2_apply

ASSET_TRACKED = [
    "asset_description", "asset_type", "facility_id", "location_code", "manufacturer", "criticality_rank",
    "parent_asset_id", "record_status",
]


def build_dim_asset(raw: DataFrame, target: DataFrame | None, as_of: str) -> DataFrame:
    """Newest record per asset, versioned on eight attributes."""
    newest = latest_per_key(raw, ["asset_id"], ["last_modified_ts"])
    return scd2_apply(
        target, newest.select("asset_id", *ASSET_TRACKED, "install_date"), ["asset_id"], ASSET_TRACKED, as_of, "asset_sk",
        unique=True,
    )


def build_dim_well_field(readings: DataFrame, target: DataFrame | None, as_of: str) -> DataFrame:
    pairs = readings.select("well_id", "field_id").distinct().withColumn("business_domain", F.lit("upstream"))
    return scd2_apply(target, pairs, ["well_id", "field_id"], ["business_domain"], as_of, "well_field_sk", unique=True)


def _reference(raw: DataFrame, code: str, name: str, kind: str, value: Column, stamp: Column | None) -> DataFrame:
    return raw.select(code).distinct().select(
        code, F.col(code).alias(name), value.alias(kind),
        (F.current_timestamp() if stamp is None else stamp).alias("last_updated_ts"),
    )


def build_dim_cost_center(actuals: DataFrame, target: DataFrame | None, stamp: Column | None = None) -> DataFrame:
    domain = family_of("cost_center_code", K.COST_CENTER_DOMAINS, "other")
    rows = _reference(actuals, "cost_center_code", "cost_center_name", "business_domain", domain, stamp)
    return scd1_upsert(target, rows, ["cost_center_code"], rows.columns[1:], "cost_center_sk")


def build_dim_product(tests: DataFrame, target: DataFrame | None, stamp: Column | None = None) -> DataFrame:
    family = family_of("product_code", K.PRODUCT_FAMILIES, "OTHER")
    rows = _reference(tests, "product_code", "product_name", "product_family", family, stamp)
    return scd1_upsert(target, rows, ["product_code"], rows.columns[1:], "product_sk")


def build_dim_employee_vendor(work_orders: DataFrame, incidents: DataFrame, target: DataFrame | None,
                              stamp: Column | None = None) -> DataFrame:
    """Crews and employees as one party dimension; an identifier seen as both is a crew."""
    crews = work_orders.select(F.col("assigned_crew_id").alias("party_id"), F.lit("CREW").alias("party_type"))
    people = incidents.select(F.col("involved_employee_id").alias("party_id"), F.lit("EMPLOYEE").alias("party_type"))
    rows = crews.unionByName(people).filter("party_id IS NOT NULL").groupBy("party_id").agg(
        F.min("party_type").alias("party_type")  # CREW sorts first
    ).select(
        "party_id", "party_type", F.col("party_id").alias("party_name"),
        F.lit(None).cast("string").alias("department_code"),
        (F.current_timestamp() if stamp is None else stamp).alias("last_updated_ts"),
    )
    return scd1_upsert(target, rows, ["party_id"], rows.columns[1:], "party_sk")
