"""Quality rules of the order feed, evaluated in one pass per input table.

Each row gets its final status and the list of its violations; the error log is
the exploded list. A rule only sees rows that earlier rules left valid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import constants as K
from starloom.functions.columns import (
    count_when, dbl, is_blank, money, parse_date, ratio, vat_share,
)
from starloom.operators.keyed import lookup, with_flag

VIOLATIONS = "_violations"
KNOWN_STATES = sorted(a for names in K.STATE_ALIASES.values() for a in names)
CONTACT = f"({K.MOBILE_LOCAL})|({K.MOBILE_PLUS})|({K.MOBILE_INTL})|({K.EMAIL})"


def _issue(cond: Column, code: str, name: str, severity: str, field: str, value: Column, text: Column) -> Column:
    return F.when(cond, F.array(F.struct(
        F.lit(code).alias("rule_code"), F.lit(name).alias("rule_name"), F.lit(severity).alias("severity"),
        F.lit(field).alias("field_name"), value.cast("string").alias("field_value"),
        text.alias("description"),
    ))).otherwise(F.array())


def _issues(found: Sequence[Column]) -> Column:
    """Lists of no or one issue, laid end to end. ``array_compact`` would run a lambda, which is never compiled."""
    return F.concat(*found)


def check_orders(orders: DataFrame, items: DataFrame, customers: DataFrame, as_of: str) -> DataFrame:
    """Rules on order headers. Adds status, error text, corrected VAT and violations."""
    blank = is_blank("order_id")
    stated = F.upper(F.trim(F.coalesce("order_state", F.lit(""))))
    bad_state = ~blank & ~stated.isin(*KNOWN_STATES, "")
    alive = ~blank & ~bad_state

    # Copies of an order, its latest copy and its real item count, each reduced per
    # map task first, so a much-repeated id never travels row by row. Both sides end
    # up partitioned by order id and join in place.
    stamp = F.struct("stg_load_dt", "stg_record_id")
    heads = orders.filter(~blank).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_copies"), F.count_if(alive).alias("_live_copies"),
        F.max(stamp).alias("_latest"), F.max(F.when(alive, stamp)).alias("_latest_live"),
    )
    lines = items.filter(~is_blank("order_id")).groupBy("order_id").agg(F.count(F.lit(1)).alias("_items"))
    per_order = heads.join(lines, "order_id", "left")
    seen = lookup(
        orders.withColumn("_id", F.when(~blank, F.col("order_id"))), per_order, "_id", "order_id",
        {c: c for c in ("_copies", "_live_copies", "_latest", "_latest_live", "_items")}, ["stg_record_id"],
    )
    seen = with_flag(seen, customers, "customer_id", "customer_id", "_customer_known", ["stg_record_id"], asked=orders)

    total, vat = money("total_amount"), money("vat_amount")
    should_be = vat_share(total)
    wrong_vat = alive & (F.abs(dbl(vat) - dbl(total) / F.lit(1.15) * F.lit(0.15)) > K.VAT_TOLERANCE)
    superseded = alive & (F.col("_copies") > 1) & (stamp != F.col("_latest"))
    left = alive & ~superseded
    negative = left & (total < 0)
    kept = left & ~F.coalesce(negative, F.lit(False))
    ordered, done = parse_date("order_date"), parse_date("completion_date")
    contact = F.trim(F.col("notification_contact"))
    claimed = F.col("order_item_count").try_cast("int")
    tomorrow = F.date_add(F.lit(as_of).cast("date"), 1)

    found = [
        _issue(blank, "DQ-01", "Order ID Not Null", "REJECT", "order_id", F.lit(None),
               F.lit("order id is missing")),
        _issue(bad_state, "DQ-02", "Valid Order State", "REJECT", "order_state", F.col("order_state"),
               F.lit("state is not one of the known codes")),
        _issue(alive & (done < ordered), "DQ-03", "Date Chronology", "WARN", "completion_date",
               F.col("completion_date"), F.lit("completed before it was ordered")),
        _issue(alive & F.col("customer_id").isNotNull() & ~F.col("_customer_known"), "DQ-04",
               "Customer Reference Exists", "WARN", "customer_id", F.col("customer_id"),
               F.lit("customer is not in the CRM feed; resolves to the unknown member")),
        _issue(wrong_vat, "DQ-05", "VAT Calculation 15%", "WARN", "vat_amount", F.col("vat_amount"),
               F.concat(F.lit("VAT corrected to "), should_be.cast("string"))),
        _issue(alive & (F.col("_live_copies") > 1) & (stamp == F.col("_latest_live")), "DQ-06",
               "Duplicate Order in Batch", "WARN", "order_id", F.col("order_id"),
               F.lit("order was delivered more than once; the latest load is kept")),
        _issue(left & ~is_blank("notification_contact") & ~contact.rlike(CONTACT), "DQ-07",
               "Mobile Number Format", "WARN", "notification_contact", F.col("notification_contact"),
               F.lit("neither a national mobile number nor an e-mail address")),
        _issue(left & (total > K.LARGE_AMOUNT), "DQ-10", "High Value Order", "WARN", "total_amount",
               F.col("total_amount"), F.lit("amount needs manual approval")),
        _issue(left & (ordered > tomorrow), "DQ-11", "Order Date Not Future", "WARN", "order_date",
               F.col("order_date"), F.lit("order date is after tomorrow")),
        _issue(negative, "DQ-12", "Negative Amount", "REJECT", "total_amount", F.col("total_amount"),
               F.lit("order total is negative")),
        _issue(left & F.col("total_amount").isNotNull() & total.isNull(), "DQ-13", "Amount Is Numeric", "WARN",
               "total_amount", F.col("total_amount"), F.lit("amount is not a number; taken as missing")),
        _issue(kept & (claimed != F.col("_items")), "DQ-20", "Order Item Count", "WARN",
               "order_item_count", F.col("order_item_count"), F.lit("header and item feed disagree")),
    ]
    reason = (
        F.when(blank, F.lit("DQ-01: order id is missing"))
        .when(bad_state, F.concat(F.lit("DQ-02: invalid state "), F.coalesce("order_state", F.lit("NULL"))))
        .when(superseded, F.lit("DQ-06: superseded by a later copy"))
        .when(negative, F.lit("DQ-12: negative amount"))
    )
    return (
        seen.withColumn(VIOLATIONS, _issues(found))
        .withColumn("stg_error_desc", reason)
        .withColumn("stg_record_status", F.when(F.col("stg_error_desc").isNull(), "V").otherwise("E"))
        .withColumn("vat_amount", F.when(wrong_vat, should_be.cast("string")).otherwise(F.col("vat_amount")))
        .select(*orders.columns, *[c for c in ("stg_error_desc",) if c not in orders.columns], VIOLATIONS)
    )


def check_items(items: DataFrame, offerings: DataFrame, dim_offering: DataFrame) -> DataFrame:
    """Offering reference exists in the feed or as a current dimension row."""
    known = offerings.select("product_offering_id").unionByName(
        dim_offering.filter("current_row_flag = 'Y'").select(
            F.col("product_offering_bk").alias("product_offering_id")
        )
    )
    tagged = with_flag(items, known, "product_offering_id", "product_offering_id", "_known",
                       ["order_id", "order_item_id"])
    unknown = F.col("product_offering_id").isNotNull() & ~F.col("_known")
    found = [_issue(unknown, "DQ-08", "Product Offering Exists", "WARN", "product_offering_id",
                    F.col("product_offering_id"), F.lit("offering is not in the catalogue"))]
    return tagged.withColumn(VIOLATIONS, _issues(found)).withColumn("stg_record_status", F.lit("V")).drop("_known")


def check_customers(customers: DataFrame) -> DataFrame:
    """National identifier format; the value itself is never logged."""
    bad = ~is_blank("national_id") & ~F.trim("national_id").rlike(K.NATIONAL_ID)
    found = [_issue(bad, "DQ-09", "National ID Format", "WARN", "national_id", F.lit("***MASKED***"),
                    F.lit("identifier is not ten digits starting with 1 or 2"))]
    return customers.withColumn(VIOLATIONS, _issues(found)).withColumn("stg_record_status", F.lit("V"))


def error_log(tagged: DataFrame, source_table: str, batch_id: str, logged_at: Column | None = None,
              order_id: str | None = "order_id") -> DataFrame:
    """One row per violation, with the whole record as JSON; identity numbers stay out of it."""
    at = F.current_timestamp() if logged_at is None else logged_at
    order = F.lit(None).cast("string") if order_id is None else F.nullif(F.trim(F.col(order_id)), F.lit(""))
    item = F.col("order_item_id") if "order_item_id" in tagged.columns else F.lit(None).cast("string")
    whole = F.to_json(F.struct(*(c for c in tagged.columns if c not in (VIOLATIONS, "national_id"))))
    found = tagged.filter(F.size(VIOLATIONS) > 0)
    rows = found.select(order.alias("order_id"), item.alias("order_item_id"), whole.alias("raw"), F.explode(VIOLATIONS).alias("v"))
    return rows.select(
        at.alias("err_dt"),
        F.lit(batch_id).alias("err_batch_id"),
        F.lit(source_table).alias("err_source_table"),
        F.lit("order_quality").alias("err_graph_name"),
        F.col("v.rule_code").alias("err_rule_code"),
        F.col("v.rule_name").alias("err_rule_name"),
        F.col("v.severity").alias("err_severity"),
        F.col("v.field_name").alias("err_field_name"),
        F.col("v.field_value").alias("err_field_value"),
        "order_id",
        "order_item_id",
        F.col("v.description").alias("err_description"),
        F.col("raw").alias("raw_record_data"),
        F.lit("O").alias("resolution_status"),
        F.lit(None).cast("string").alias("resolved_by"),
        F.lit(None).cast("timestamp").alias("resolved_dt"),
    )


def dq_scorecard(err_log: DataFrame, staging: DataFrame) -> DataFrame:
    """Violations per batch and rule, with the share of the batch's orders affected."""
    batch_total = staging.groupBy(F.col("stg_batch_id").alias("batch_id")).agg(
        F.count_distinct("order_id").alias("_orders")
    )
    per_rule = err_log.groupBy(
        F.col("err_batch_id").alias("batch_id"), "err_rule_code", "err_rule_name", "err_severity", "err_source_table"
    ).agg(
        F.count(F.lit(1)).alias("error_count"),
        F.count_distinct("order_id").alias("orders_affected"),
        F.min("err_dt").cast("date").alias("batch_date"),
        F.min("err_dt").alias("first_occurrence"),
        F.max("err_dt").alias("last_occurrence"),
    )
    return per_rule.join(batch_total, "batch_id", "left").select(
        "batch_id", "batch_date", "err_rule_code", "err_rule_name", "err_severity", "err_source_table",
        "error_count", "orders_affected",
        ratio(F.col("orders_affected"), F.col("_orders")).alias("pct_orders_affected"),
        "first_occurrence", "last_occurrence",
    )


def dq_batch_score(staging: DataFrame, threshold: float = K.ORDER_GATE) -> DataFrame:
    valid = count_when(F.col("stg_record_status") == "V")
    rate = ratio(valid, F.count(F.lit(1)))
    return staging.groupBy(F.col("stg_batch_id").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("total_records"),
        valid.alias("valid_records"),
        count_when(F.col("stg_record_status") == "E").alias("rejected_records"),
        rate.alias("dq_pass_rate_pct"),
        F.when(rate >= threshold, "PASS").otherwise("FAIL - BATCH HALTED").alias("dq_verdict"),
    )
