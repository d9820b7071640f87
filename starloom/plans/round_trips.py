"""Readers, sinks and streams exercised end to end on the benchmark tables.

Each query writes a feed the way a source system delivers it, loads it through
the library, and returns the loaded table.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dq import GateContext, GateFailed, run_dq_gate
from starloom.plans.ops_facts import flow_rules
from starloom.plans.order_facts import build_fact_order, primary_items
from starloom.plans.order_warehouse import OrderWarehouse, order_dimensions
from starloom.plans.warehouse import open_warehouse
from starloom.session import prepare, shared_dir, written
from starloom.sources import tables
from starloom.sources.contracts import AS_OF, contract
from starloom.sources.landing import ingest_source, landing_path
from starloom.sources.schemas import FEEDS
from starloom.streaming import events as S

DAY = "2024-01-31"


def _scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """A folder and a database of this application, both below the shared folder."""
    prepare(spark)
    tag = uuid.uuid4().hex[:12]  # every call starts from nothing
    folder = f"{shared_dir(spark)}/round_trips/{name}-{tag}"
    database = f"round_trip_{tag}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}/tables'")
    return folder, database


def landed(spark: SparkSession, sf_dir: str, source: str, table: str, feed: str) -> DataFrame:
    """Deliver a feed as landing files of its source, ingest it twice, read the raw table."""
    folder, database = _scratch(spark, f"{source}.{table}")
    spec = FEEDS[source]
    have = contract(spark, sf_dir, feed)
    wanted = spark.createDataFrame([], spec.tables[table]).schema
    out = have.select(*[
        (F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted
    ])
    writer = out.write.mode("overwrite").format(spec.format)
    if spec.format == "csv":
        writer = writer.option("header", True)
    writer.save(landing_path(folder, source, table, DAY))
    for run in ("first", "again"):
        ingest_source(spark, source, DAY, run, folder, [table], database)
    raw = spark.table(f"{database}.{table}")
    return raw.select(*[f.name for f in wanted if f.name in have.columns], "_business_date", "_ingestion_run_id")


def reloaded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the first loaded twice: every row once."""
    _, database = _scratch(spark, "batches")
    rows = contract(spark, sf_dir, "stg_items").select("order_id", "order_item_id", "price_amount")
    half = F.when(F.crc32("order_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B"))
    batches = rows.withColumn("etl_batch_id", half)
    name = f"{database}.items"
    for batch in ("A", "B", "A"):
        tables.replace_batch(batches.filter(F.col("etl_batch_id") == batch), name, batch)
    return spark.table(name).select("order_id", "order_item_id", "price_amount")


def _number(order_id: str) -> Column:
    return F.coalesce(F.substring(order_id, 2, 18).try_cast("long"), F.lit(0))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contract(spark, sf_dir, "stg_items").select("order_id", "order_item_id", "price_amount")
    return rows.withColumn("etl_batch_id", F.when(_number("order_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")))


def reloaded_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches are loaded; a reload of one fails half way: every row is still there."""
    _, database = _scratch(spark, "failure")
    batches, name = _items(spark, sf_dir), f"{database}.items"
    for batch in ("A", "B"):
        tables.replace_batch(batches.filter(F.col("etl_batch_id") == batch), name, batch)
    try:
        tables.replace_batch(batches, name, "A")  # holds rows of another batch
    except PySparkException:
        return spark.table(name)
    raise RuntimeError("a load with foreign rows has to fail")


def reloaded_from_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch is recomputed from its own stored rows."""
    _, database = _scratch(spark, "itself")
    batches, name = _items(spark, sf_dir), f"{database}.items"
    for batch in ("A", "B"):
        tables.replace_batch(batches.filter(F.col("etl_batch_id") == batch), name, batch)
    own = spark.table(name).filter("etl_batch_id = 'A'")
    tables.replace_batch(own.withColumn("price_amount", F.concat("price_amount", F.lit("0"))), name, "A")
    return spark.table(name)


def rejected_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost lines as CSV, some with a word for a number and some cut short: those are logged whole, the rest is loaded."""
    folder, database = _scratch(spark, "rejects")
    have = contract(spark, sf_dir, "cost_actuals").filter("cost_center_code IS NOT NULL")
    name = "raw_downtime_event"
    wanted = spark.createDataFrame([], FEEDS["maximo_eam"].tables[name]).schema.names
    key = F.concat_ws("-", "cost_center_code", "fiscal_year", "fiscal_period", "cost_element_code")
    period, where = F.col("fiscal_period"), landing_path(folder, "maximo_eam", name, DAY)
    start = F.when(period == 2, "yesterday").otherwise("2024-01-31 06:00:00")
    whole = [{"asset_id": key, "downtime_start_ts": start}.get(c, F.lit("")).alias(c) for c in wanted]
    have.filter(period != 1).select(*whole).write.mode("append").option("header", True).csv(where)
    have.filter(period == 1).select(key.alias("asset_id"), F.lit("cut").alias("downtime_start_ts")).write.mode("append").option("header", True).csv(where)
    for run in ("first", "again"):
        ingest_source(spark, "maximo_eam", DAY, run, folder, [name], database)
    good = spark.table(f"{database}.{name}").select(F.col("asset_id").alias("item"), F.lit("loaded").alias("outcome"), "_ingestion_run_id")
    bad = spark.table(f"{database}.ingest_rejects").select(F.substring_index("raw_record", ",", 1).alias("item"), F.lit("rejected").alias("outcome"), "_ingestion_run_id")
    return good.unionByName(bad)


def logged_gate(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    """The flow feed through the gate, twice under one run id and once under another: what the logs hold."""
    _, database = _scratch(spark, "gate")
    feed = contract(spark, sf_dir, "flow_readings")
    for run, stamp, rows in (("r1", "2024-02-01 01:00:00", feed), ("r1", "2024-02-01 02:00:00", feed), ("r2", "2024-02-01 03:00:00", feed.filter("flow_rate_bpd >= 0"))):
        ctx = GateContext(run, DAY, f"{database}.err_reject_log", f"{database}.dq_audit_log", evaluated_ts=stamp)
        try:
            run_dq_gate(rows, flow_rules(), "bdh.fact_pipeline_flow", ctx, "flow_readings")
        except GateFailed:
            pass  # logged as such
    if part == "audit":
        return spark.table(f"{database}.dq_audit_log").select(
            "ingestion_run_id", "input_name", "target_table", "business_date", "total_rows", "passed_rows", "rejected_rows", "warned_rows",
            "dq_pass_rate_pct", "threshold_pct", "gate_result", F.col("evaluated_ts").cast("timestamp_ntz").alias("evaluated_ts"))
    log = spark.table(f"{database}.err_reject_log")
    row = F.from_json("rejected_row_json", feed.schema)
    return log.select("ingestion_run_id", "rule_id", "severity", "rejection_reason", row["pipeline_segment_id"].alias("pipeline_segment_id"),
                      row["flow_rate_bpd"].cast("double").alias("flow_rate_bpd"), row["_business_date"].alias("_business_date"))


def appended_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append every day, then rebuild every day by partition overwrite: the last version stays."""
    _, database = _scratch(spark, "partitions")
    daily = contract(spark, sf_dir, "flow_readings").groupBy(F.date_format("_business_date", "yyyyMMdd").cast("int").alias("date_key")).agg(
        F.count(F.lit(1)).alias("readings"))
    name = f"{database}.daily"
    tables.write_overwrite(daily.withColumn("version", F.lit(1)).select("readings", "version", "date_key"), name, ["date_key"])
    tables.write_append(daily.withColumn("version", F.lit(2)), name, ["date_key"])
    tables.overwrite_partitions(daily.withColumn("version", F.lit(3)), name)
    return spark.table(name)


def streamed_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State events arriving in two deliveries with repeats, as a stream into the transition fact."""
    folder, database = _scratch(spark, "stream")
    w = open_warehouse(OrderWarehouse, spark, sf_dir)
    feed = contract(spark, sf_dir, "stg_events").withColumn("ts", F.col("event_timestamp").cast("timestamp"))
    split = F.lit("2024-01-15").cast("timestamp")
    raw, fact = f"{database}.raw_events", f"{database}.fact_transition"
    for part in (feed.filter(F.col("ts") < split), feed.filter(F.col("ts") >= split)):
        repeated = part.unionByName(part.filter(F.col("stg_record_id") % 10 == 0))
        repeated.write.mode("append").parquet(f"{folder}/arriving")
        stream = S.read_events(spark, f"{folder}/arriving", feed.schema.simpleString()[7:-1].replace(":", " "))
        unique = S.without_repeats(stream, ["stg_record_id"], "ts", "60 days")
        sink = S.to_transition_fact(raw, fact, w["dim_order"], w["dim_state"], w["dim_party"])
        query = S.stream_events(unique, sink, "order_state_events", f"{folder}/progress")
        query.awaitTermination()
    return spark.table(fact).drop(S.EPOCH)


def orders_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact loaded in three consecutive batches, the second one twice: as if loaded at once."""
    _, database = _scratch(spark, "daily")
    w = open_warehouse(OrderWarehouse, spark, sf_dir)
    year = F.year("order_date")
    batches = F.when(year < 1995, "D1").when(year < 1997, "D2").otherwise("D3")
    orders, fact = w["ods_orders"].withColumn("stg_batch_id", batches), f"{database}.fact_order"
    # all items meet their orders once; a load then reads the rows of its own batch
    by_order = primary_items(w["ods_items"]).join(orders.select("order_bk", "stg_batch_id"), "order_bk")
    items = written(by_order, "daily_items", ["stg_batch_id"])
    for batch in ("D1", "D2", "D2", "D3"):
        mine = items.filter(F.col("stg_batch_id") == batch)
        before = spark.table(fact).filter(F.col("etl_batch_id") < batch) if tables.table_exists(spark, fact) else None
        rows = build_fact_order(orders, mine, order_dimensions(w), w["fact_transition"], before, f"{AS_OF} 12:00:00", batch)
        tables.replace_batch(rows, fact, batch)
    return spark.table(fact)


def streamed_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow readings and alarms arriving in two deliveries, as a stream into the daily flow fact."""
    folder, database = _scratch(spark, "flow_stream")
    feed, raised = contract(spark, sf_dir, "flow_readings"), contract(spark, sf_dir, "alarms")
    fact, late = f"{database}.fact_flow", F.hour("reading_ts") >= 12  # each day is delivered in two halves
    for part in (feed.filter(~late), feed.filter(late)):
        part.write.mode("append").parquet(f"{folder}/arriving")
        stream = S.read_events(spark, f"{folder}/arriving", feed.schema.simpleString()[7:-1].replace(":", " "))
        sink = S.to_pipeline_flow(f"{database}.raw_flow", lambda _: raised, fact)
        S.stream_events(stream, sink, "pipeline_flow", f"{folder}/progress").awaitTermination()
    return spark.table(fact)


def extended_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents that have grown: every fourth has a note, and the first item of every sixth a warranty."""
    rows = contract(spark, sf_dir, "raw_payloads")
    n, text = _number("order_id"), F.col("raw_json_payload")
    noted = F.concat(F.lit('{"note":{"by":"'), (n % 3).cast("string"), F.lit('","urgent":true},'), F.substring(text, 2, 1_000_000))
    grown = F.when(n % 4 == 0, noted).otherwise(text)
    warranty = F.replace(grown, F.lit('"productOrderItem":[{'), F.concat(F.lit('"productOrderItem":[{"warrantyMonths":'), (n % 36).cast("string"), F.lit(",")))
    return rows.withColumn("raw_json_payload", F.when(n % 6 == 0, warranty).otherwise(grown))


def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents of which every seventh is cut in half, and every eleventh is empty."""
    rows = contract(spark, sf_dir, "raw_payloads")
    n = _number("order_id")
    text = F.col("raw_json_payload")
    cut = F.substring(text, 1, 12)
    return rows.withColumn("raw_json_payload", F.when(n % 7 == 0, cut).when(n % 11 == 0, F.lit(" ")).otherwise(text))
