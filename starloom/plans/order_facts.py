"""Fact builds of the order warehouse: snapshot, item and transition grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions import columns as C
from starloom.operators.keyed import lookup
from starloom.operators.ordered import RN, assign_surrogate_keys, first_free, number_rows, with_previous


UNKNOWN_SK = -1


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("current_row_flag = 'Y'")


def _code_sk(facts: DataFrame, seed: DataFrame, code: str, key: str, sk: str, out: str) -> DataFrame:
    """Key of a seeded dimension (a dozen fixed rows, so the broadcast is bounded)."""
    side = seed.select(F.col(key).alias("_code"), F.col(sk).alias(out))
    joined = facts.join(F.broadcast(side), F.col(code) == F.col("_code"), "left").drop("_code")
    return joined.withColumn(out, F.coalesce(out, F.lit(UNKNOWN_SK)))


def _sk(facts: DataFrame, dim: DataFrame, on: Column | str, bk: str, take: dict[str, str], row_id: list[str]) -> DataFrame:
    out = lookup(facts, dim, on, bk, take, row_id)
    key = next(iter(take.values()))
    return out.withColumn(key, F.coalesce(key, F.lit(UNKNOWN_SK).cast("long")))


def region_key(region: str, postcode: str) -> Column:
    return F.concat(F.col(region), F.coalesce(postcode, F.lit("")))


def sla_target(segment: Column, is_5g: Column, product_type: Column) -> Column:
    return (
        F.when(segment == "ENTERPRISE", K.SLA_ENTERPRISE)
        .when(segment == "SMB", K.SLA_SMB)
        .when(is_5g == "Y", K.SLA_5G)
        .when(product_type == "FIBER", K.SLA_FIBER)
        .otherwise(K.SLA_DEFAULT)
    )


def sla_by_segment(segment: Column) -> Column:
    """Threshold used by breach and remaining time; knows segments only."""
    return F.when(segment == "ENTERPRISE", K.SLA_ENTERPRISE).when(segment == "SMB", K.SLA_SMB).otherwise(K.SLA_DEFAULT)


def build_fact_transition(
    events: DataFrame, dim_order: DataFrame, dim_state: DataFrame, dim_party: DataFrame, batch_id: str | None,
    all_events: DataFrame | None = None, baseline_hrs: int = K.SLA_BASELINE, key_start: int | DataFrame = 0,
    last_seen: DataFrame | None = None,
) -> DataFrame:
    """One row per state change, with the time spent in the state it leaves.

    ``last_seen`` (``order_id, last_ts``) continues orders of earlier loads. With
    ``batch_id`` None every row is taken and keeps its own batch id.

    The keys and the "previous event" both come from one global ordering by
    order and time, so an order with very many events is cut over partitions.
    """
    stamp = C.parse_ts("event_timestamp")
    first_seen = (all_events if all_events is not None else events).groupBy("order_id").agg(F.min(stamp).alias("first_ts"))
    mine = F.lit(True) if batch_id is None else F.col("stg_batch_id") == batch_id
    batch = events.filter(mine & (F.col("stg_record_status") == "V")).select(
        F.col("stg_batch_id").alias("etl_batch_id"), "order_id", "stg_record_id", stamp.alias("evt_ts"), "change_reason_code", "change_reason_desc",
        "is_automated_change", "event_source", "changed_by_user_id",
        C.std_state("from_state").alias("from_cd"), C.std_state("to_state").alias("to_cd"),
    )
    orders = current(dim_order).select("order_sk", F.col("order_bk").alias("order_id"))
    known = batch.join(orders, "order_id").join(first_seen, "order_id", "left")
    if last_seen is not None:
        known = known.join(last_seen.select("order_id", "last_ts"), "order_id", "left")
    ranked = with_previous(number_rows(known, ["order_id", "evt_ts", "stg_record_id"]), "order_id", "evt_ts", "prev_ts")
    if last_seen is not None:
        ranked = ranked.withColumn("prev_ts", F.coalesce("prev_ts", "last_ts"))
    ranked = _code_sk(ranked, dim_state, "from_cd", "order_state_cd", "order_state_sk", "from_state_sk")
    ranked = _code_sk(ranked, dim_state, "to_cd", "order_state_cd", "order_state_sk", "to_state_sk")
    ranked = _sk(ranked, current(dim_party), "changed_by_user_id", "party_bk",
                 {"party_sk": "changed_by_party_sk"}, ["order_id", RN])
    repeated = F.col("prev_ts").isNotNull()
    elapsed = F.when(repeated, C.dbl(C.whole_hours("first_ts", "evt_ts")) / F.lit(float(baseline_hrs)) * F.lit(100.0))
    key = F.col(RN) + first_free(key_start)
    return ranked.select(
        key.cast("long").alias("transition_sk"),
        "order_sk",
        F.lit(None).cast("long").alias("order_item_sk"),
        "from_state_sk",
        "to_state_sk",
        C.date_key("evt_ts").alias("transition_date_sk"),
        C.time_key("evt_ts").alias("transition_time_sk"),
        "changed_by_party_sk",
        F.col("order_id").alias("order_bk"),
        F.col("change_reason_code").alias("change_reason_cd"),
        "change_reason_desc",
        F.coalesce("is_automated_change", F.lit("N")).alias("is_automated_change"),
        F.col("event_source").alias("event_source_cd"),
        F.when(repeated, C.whole_hours("prev_ts", "evt_ts")).otherwise(F.lit(0)).cast("decimal(14,4)")
        .alias("duration_in_from_state_hrs"),
        C.flag(F.col("from_cd").isin(*K.CRITICAL_STATES)).alias("is_sla_critical_state"),
        elapsed.alias("sla_elapsed_pct"),
        "etl_batch_id",
    )


def primary_offering(ods_items: DataFrame) -> DataFrame:
    """Offering of the highest-priced item per order (ties: greatest item id)."""
    best = F.struct("unit_price_incl_vat", "order_item_id")
    return ods_items.groupBy("order_bk").agg(F.max_by("product_offering_bk", best).alias("primary_offering_bk"))


def primary_items(ods_items: DataFrame) -> DataFrame:
    """The item per order that :func:`primary_offering` looks at; it finds the same offering in these rows as in all."""
    best = F.struct("unit_price_incl_vat", "order_item_id")
    row = F.struct("unit_price_incl_vat", "order_item_id", "product_offering_bk")
    return ods_items.groupBy("order_bk").agg(F.max_by(row, best).alias("_row")).select("order_bk", "_row.*")


def first_order_dates(ods_orders: DataFrame, dim_customer: DataFrame, prior_fact: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Earliest order date per customer key, and one row for the unknown customer.

    Replaces a correlated inequality by two aggregates on two narrow columns.
    Rows of the batch count as well, so loading a span of days at once sets the
    same flags as loading them one by one.
    """
    members = current(dim_customer).select("customer_sk", "customer_bk")
    per_bk = ods_orders.groupBy("customer_bk").agg(F.min(C.date_key("order_date")).alias("first_sk"))
    known = per_bk.join(members, "customer_bk")
    strangers = per_bk.join(members, "customer_bk", "left_anti").select("first_sk")
    if prior_fact is not None:
        before = prior_fact.groupBy("customer_sk").agg(F.min("date_sk").alias("_before"))
        known = known.join(before, "customer_sk", "left").withColumn("first_sk", F.least("first_sk", "_before")).drop("_before")
        strangers = strangers.unionByName(before.filter(F.col("customer_sk") == UNKNOWN_SK).select(F.col("_before").alias("first_sk")))
    return known, strangers.agg(F.min("first_sk").alias("_stranger_first"))


def build_fact_order(
    ods_orders: DataFrame, ods_items: DataFrame, dims: dict[str, DataFrame], transitions: DataFrame,
    prior_fact: DataFrame | None, as_of: str, batch_id: str,
) -> DataFrame:
    """Order snapshot rows with resolved keys, service-level measures and flags.

    ``as_of`` is the moment the running service clock is read.
    """
    batch = ods_orders.filter(F.col("stg_batch_id") == batch_id)
    known, stranger = first_order_dates(batch, dims["customer"], prior_fact)
    # Keys are resolved on rows that carry nothing but natural keys; if dimensions are
    # too large to broadcast, only these short rows move once per dimension.
    k = batch.select("order_bk", "customer_bk", "seller_party_bk", region_key("delivery_region", "delivery_postal_code").alias("_region"))
    k = k.join(primary_offering(ods_items), "order_bk", "left")
    k = _sk(k, known, "customer_bk", "customer_bk", {"customer_sk": "customer_sk", "first_sk": "_first"}, ["order_bk"])
    k = _sk(k, current(dims["offering"]), "primary_offering_bk", "product_offering_bk", {
        "product_offering_sk": "product_offering_sk", "contract_duration_months": "_months",
        "is_5g_flag": "_5g", "is_bundle_flag": "_bundle", "product_type_cd": "_ptype",
    }, ["order_bk"])
    k = _sk(k, dims["geography"], "_region", "geography_bk", {"geography_sk": "geography_sk"}, ["order_bk"])
    k = _sk(k, current(dims["party"]), "seller_party_bk", "party_bk", {"party_sk": "seller_party_sk"}, ["order_bk"])
    k = k.drop("customer_bk", "seller_party_bk", "_region", "primary_offering_bk")
    # order-grain sides share the order key: the full header rows move once for all three
    headers = current(dims["order"]).select("order_sk", "order_bk")
    changes = transitions.groupBy("order_bk").agg(F.count(F.lit(1)).cast("int").alias("_changes"))
    f = batch.join(headers, "order_bk").join(k, "order_bk").join(changes, "order_bk", "left")
    f = _code_sk(f, dims["state"], "order_state_cd", "order_state_cd", "order_state_sk", "order_state_sk")
    digital = dims["channel"].select(F.col("channel_cd").alias("_ch"), "channel_sk", "is_digital_flag")
    f = f.join(F.broadcast(digital), F.col("channel_cd") == F.col("_ch"), "left")

    seg, done = F.col("segment_cd"), F.col("completion_dt").isNotNull()
    day = C.date_key("order_date")
    hours = F.when(done, C.whole_hours("order_date", "completion_dt"))
    target, simple = sla_target(seg, F.col("_5g"), F.col("_ptype")), sla_by_segment(seg)
    age = C.whole_hours(F.col("order_date"), F.lit(as_of).cast("timestamp_ntz"))
    hrs = lambda c: c.cast("decimal(10,2)")
    first = F.when(F.col("customer_sk") == UNKNOWN_SK, stranger.scalar()).otherwise(F.col("_first"))
    return f.select(
        (F.col("order_sk") * 100000000 + day).alias("order_snapshot_key"),
        "order_sk",
        day.alias("date_sk"),
        "customer_sk",
        "product_offering_sk",
        F.coalesce("channel_sk", F.lit(UNKNOWN_SK)).alias("channel_sk"),
        "geography_sk",
        "order_state_sk",
        C.time_key("order_date").alias("time_sk"),
        "seller_party_sk",
        F.lit(None).cast("long").alias("billing_account_sk"),
        "total_order_amount",
        "order_amount_excl_vat",
        "vat_amount",
        "discount_amount",
        "recurring_charge_mrc",
        "one_time_charge_otc",
        (F.col("recurring_charge_mrc") * F.coalesce("_months", F.lit(12))).cast("decimal(18,2)").alias("expected_annual_revenue"),
        F.coalesce("order_item_count", F.lit(0)).alias("order_item_count"),
        hrs(hours).alias("fulfilment_duration_hrs"),
        F.coalesce("_changes", F.lit(0)).alias("state_transition_count"),
        hrs(target).alias("sla_target_hrs"),
        hrs(F.when(~done, simple - age)).alias("sla_remaining_hrs"),
        "priority_cd",
        "order_category_cd",
        C.flag(hours > simple).alias("sla_breach_flag"),
        C.flag(hours > target).alias("sla_breach_consistent_flag"),
        C.flag(F.col("order_state_cd").isin(*K.FALLOUT_STATES)).alias("fallout_flag"),
        F.coalesce("_bundle", F.lit("N")).alias("is_bundle_order"),
        F.coalesce("_5g", F.lit("N")).alias("is_5g_order"),
        F.coalesce("is_digital_flag", F.lit("N")).alias("is_digital_channel"),
        F.when(first < day, "N").otherwise("Y").alias("is_new_customer_order"),
        C.flag(F.col("order_category_cd") == "MODIFY").alias("is_upgrade_order"),
        F.lit("N").alias("revenue_assurance_flag"),
        F.lit(batch_id).alias("etl_batch_id"),
        "source_system_cd",
        F.lit(1).alias("record_version"),
        # what reports ask of the header, so that none of them meets the order dimension for it
        "order_bk",
        "order_date",
        "segment_cd",
    )


def build_fact_item(
    ods_items: DataFrame, ods_orders: DataFrame, dims: dict[str, DataFrame], batch_id: str,
    loaded_since: str | None = None, key_start: int | DataFrame = 0, cut_by: dict[str, Column] | None = None,
) -> DataFrame:
    """Item rows with resolved keys and price fallbacks.

    ``cut_by`` adds columns by which the numbered rows are laid out in folders, so
    that the result can be read as it is instead of being written once more.
    """
    ods_items = ods_items.filter(F.col("stg_batch_id") == batch_id)
    items = ods_items if loaded_since is None else ods_items.filter(F.col("ods_load_dt") >= F.lit(loaded_since).cast("timestamp_ntz"))
    headers = current(dims["order"]).select("order_bk", "order_sk", "order_date")
    # what belongs to the order is resolved once per order, not once per item
    owners = ods_orders.select("order_bk", "customer_bk", "channel_cd")
    owners = _sk(owners, current(dims["customer"]), "customer_bk", "customer_bk", {"customer_sk": "customer_sk"}, ["order_bk"])
    owners = _code_sk(owners, dims["channel"], "channel_cd", "channel_cd", "channel_sk", "channel_sk")
    row = ["order_bk", "order_item_id"]
    f = items.join(headers, "order_bk").join(owners.select("order_bk", "customer_sk", "channel_sk"), "order_bk", "left")
    f = f.withColumns({c: F.coalesce(c, F.lit(UNKNOWN_SK)) for c in ("customer_sk", "channel_sk")})
    f = _sk(f, current(dims["offering"]), "product_offering_bk", "product_offering_bk", {
        "product_offering_sk": "product_offering_sk", "is_5g_flag": "_5g", "product_type_cd": "_ptype"}, row)
    f = _sk(f, dims["geography"], region_key("delivery_region", "delivery_postal_code"), "geography_bk",
            {"geography_sk": "geography_sk"}, row)
    f = _code_sk(f, dims["state"], "item_state_cd", "order_state_cd", "order_state_sk", "item_state_sk")
    f = _code_sk(f, dims["action"], "action_cd", "action_cd", "action_sk", "action_sk")
    zero = F.lit(0).cast("decimal(14,2)")
    qty = F.coalesce("item_quantity", F.lit(1))
    fifteen = F.lit(K.VAT_RATE).cast("decimal(3,2)")
    shaped = f.select(
        "order_bk",
        "order_sk",
        C.date_key("order_date").alias("date_sk"),
        "customer_sk",
        "product_offering_sk",
        F.lit(None).cast("long").alias("product_spec_sk"),
        "item_state_sk",
        "action_sk",
        "geography_sk",
        "channel_sk",
        "order_item_id",
        F.coalesce("unit_price_excl_vat", zero.cast("decimal(14,4)")).alias("unit_price_excl_vat"),
        F.coalesce("unit_price_incl_vat", zero.cast("decimal(14,4)")).alias("unit_price_incl_vat"),
        qty.alias("item_quantity"),
        F.coalesce("item_total_amount", (F.col("unit_price_incl_vat") * qty).cast("decimal(18,2)")).alias("item_total_amount"),
        F.coalesce("item_discount_amount", zero.cast("decimal(18,2)")).alias("item_discount_amount"),
        F.coalesce("item_vat_amount", (F.col("unit_price_excl_vat") * fifteen * qty).cast("decimal(14,2)")).alias("item_vat_amount"),
        F.coalesce("item_mrc", zero).alias("item_mrc"),
        F.coalesce("item_otc", zero).alias("item_otc"),
        F.lit(None).cast("decimal(10,2)").alias("provisioning_duration_hrs"),
        F.when(F.col("_ptype") == "FIBER", K.SLA_FIBER).when(F.col("_5g") == "Y", K.SLA_5G).otherwise(K.SLA_DEFAULT)
        .cast("decimal(10,2)").alias("item_sla_target_hrs"),
        F.lit("N").alias("item_sla_breach_flag"),
        "product_msisdn_masked",
        "sim_type_cd",
        "contract_months",
        "technology_tier",
        F.coalesce("is_5g_item", F.lit("N")).alias("is_5g_item"),
        F.coalesce("is_bundle_item", F.lit("N")).alias("is_bundle_item"),
        F.lit(batch_id).alias("etl_batch_id"),
    )
    # rows are numbered where they lie: an item that comes twice gets two keys, and nothing is joined back
    return assign_surrogate_keys(shaped.withColumns(cut_by or {}), row, "order_item_sk", key_start, list(cut_by or {}))
