"""The order warehouse: which table is built from which, in load order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions import columns as C
from starloom.plans import calendar as cal
from starloom.plans import order_dims as dims
from starloom.plans import order_facts as facts
from starloom.plans import order_marts as marts
from starloom.plans import order_quality as quality
from starloom.plans.order_cleanse import cleanse_items, cleanse_orders
from starloom.plans.warehouse import Warehouse, month_of
from starloom.sources import contracts as feeds


def _calendar(w: Warehouse) -> DataFrame:
    """Whole years from the first to the last day of any order or event, so no fact is without its day.

    The days come from what the facts are built of: a report on one fact does not wait for the others.
    """
    orders = w["ods_orders"].select(C.date_key("order_date").alias("d"))
    days = orders.union(w.feed("stg_events").select(C.date_key(C.parse_ts("event_timestamp"))))
    first, last = days.filter("d > 0").agg(F.min("d"), F.max("d")).first()
    if first is None:
        first = last = int(feeds.AS_OF[:4]) * 10000
    return cal.dim_date(w.spark, f"{first // 10000:04d}-01-01", f"{last // 10000:04d}-12-31")


def _checked_orders(w: Warehouse) -> DataFrame:
    customers = w.feed("stg_customers_1").unionByName(w.feed("stg_customers_2"))
    return quality.check_orders(w.feed("stg_orders"), w.feed("stg_items"), customers, feeds.AS_OF)


def _dim_customer(w: Warehouse) -> DataFrame:
    first = dims.build_dim_customer(w.feed("stg_customers_1"), None, feeds.FIRST_LOAD)
    both = dims.build_dim_customer(w.feed("stg_customers_2"), first, feeds.AS_OF)
    return dims.with_unknown(both, dims.UNKNOWN_CUSTOMER)


def _dim_offering(w: Warehouse) -> DataFrame:
    first = dims.build_dim_offering(w.feed("stg_offerings_1"), None, feeds.FIRST_LOAD)
    both = dims.build_dim_offering(w.feed("stg_offerings_2"), first, feeds.AS_OF)
    return dims.with_unknown(both, dims.UNKNOWN_OFFERING)


def _events(w: Warehouse) -> DataFrame:
    return w.feed("stg_events").withColumn("stg_record_status", F.lit("V"))


def order_dimensions(w: Warehouse) -> dict[str, DataFrame]:
    return {
        "order": w["dim_order"], "customer": w["dim_customer"], "offering": w["dim_offering"],
        "geography": w["dim_geography"], "party": w["dim_party"], "state": w["dim_state"],
        "channel": w["dim_channel"], "action": w["dim_action"],
    }


def _fact_transition(w: Warehouse) -> DataFrame:
    built = facts.build_fact_transition(_events(w), w["dim_order"], w["dim_state"], w["dim_party"], feeds.BATCH)
    return built.withColumn("month_sk", month_of("transition_date_sk"))


def _fact_order(w: Warehouse) -> DataFrame:
    built = facts.build_fact_order(
        w["ods_orders"], w["ods_items"], order_dimensions(w), w["fact_transition"], None,
        f"{feeds.AS_OF} 12:00:00", feeds.BATCH,
    )
    return built.withColumn("month_sk", month_of("date_sk"))


def _fact_item(w: Warehouse) -> DataFrame:
    return facts.build_fact_item(
        w["ods_items"], w["ods_orders"], order_dimensions(w), feeds.BATCH, cut_by={"month_sk": month_of("date_sk")})


def _checked_items(w: Warehouse) -> DataFrame:
    offerings = w.feed("stg_offerings_2")
    return quality.check_items(w.feed("stg_items"), offerings, w["dim_offering"])


class OrderWarehouse(Warehouse):
    builders = {
        "dim_state": lambda w: cal.seed_order_states(w.spark),
        "dim_channel": lambda w: cal.seed_channels(w.spark),
        "dim_action": lambda w: cal.seed_actions(w.spark),
        "dim_geography": lambda w: dims.with_unknown(
            dims.build_dim_geography(w.feed("ref_geography"), None), dims.UNKNOWN_GEOGRAPHY),
        "dim_party": lambda w: dims.with_unknown(
            dims.build_dim_related_party(w.feed("ref_parties"), None, feeds.FIRST_LOAD), dims.UNKNOWN_PARTY),
        "dim_customer": _dim_customer,
        "dim_offering": _dim_offering,
        "checked_orders": _checked_orders,
        "checked_items": _checked_items,
        "ods_orders": lambda w: cleanse_orders(w["checked_orders"], feeds.BATCH),
        # straight from the rules: the log of their violations is stored only for who asks for it
        "ods_items": lambda w: cleanse_items(_checked_items(w), feeds.BATCH),
        "dim_order": lambda w: dims.build_dim_order(w["ods_orders"], None, feeds.AS_OF),
        "fact_transition": _fact_transition,
        "fact_order": _fact_order,
        "fact_item": _fact_item,
        "dim_date": _calendar,
        "mart_order_kpi": lambda w: marts.order_kpi(w).withColumn("month_sk", month_of("kpi_date_sk")),
    }
    partitions = {
        "fact_transition": ["month_sk"], "fact_order": ["month_sk"], "mart_order_kpi": ["month_sk"],
    }
    laid_out = frozenset({"fact_item"})  # numbered over all items, in folders by month


@dataclass(frozen=True)
class BatchReport:
    """What one daily batch produced."""

    score: DataFrame
    staging: DataFrame
    warehouse: Warehouse


def run_daily_batch(w: OrderWarehouse, gate: float | None = K.ORDER_GATE) -> BatchReport:
    """Quality gate, dimensions, cleansing, order dimension, transitions, order and item facts.

    The order is fixed: transitions come before the order fact, which counts them.
    Staging rows that were valid end up as processed. A batch below ``gate`` stops
    here, before any dimension or fact is built; None lets every batch pass.
    """
    from starloom.operators.dq import enforce_gate
    from starloom.sources.tables import mark_processed

    score = quality.dq_batch_score(w["checked_orders"])
    if gate is not None:
        row = score.filter(F.col("batch_id") == feeds.BATCH).first()  # one row per batch
        enforce_gate(row["dq_pass_rate_pct"], gate, "stg_product_order")
    w.build(["dim_customer", "dim_offering", "ods_orders", "dim_order", "fact_transition", "fact_order", "fact_item"])
    return BatchReport(score, mark_processed(w["checked_orders"].drop(quality.VIOLATIONS), feeds.BATCH), w)
