"""Event feeds as streams into the same builders the batch uses.

Each micro-batch is written under its own number, so a batch that is replayed
after a failure replaces its first attempt instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.functions.columns import parse_ts
from starloom.plans.ops_facts import build_fact_pipeline_flow
from starloom.plans.order_facts import build_fact_transition
from starloom.session import shared_dir
from starloom.sources.tables import overwrite_partitions, table_exists

EPOCH = "stream_epoch"
Sink = Callable[[DataFrame, int], None]


def read_events(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", name_filter: str | None = None) -> DataFrame:
    """Files arriving in ``path`` as a stream with a declared schema."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.format(fmt).load(path)


def without_repeats(stream: DataFrame, keys: Sequence[str], ts_col: str, watermark: str = "1 day") -> DataFrame:
    """Drop events delivered again within the watermark; state older than that is released."""
    return stream.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def stream_events(stream: DataFrame, sink: Sink, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Run everything that is available through ``sink`` and stop (schedule again for more)."""
    where = checkpoint or f"{shared_dir(stream.sparkSession)}/streams/{name}"
    return (
        stream.writeStream.foreachBatch(sink).queryName(name)
        .option("checkpointLocation", where).trigger(availableNow=True).start()
    )


def to_raw_table(table: str) -> Sink:
    """Append each micro-batch to a raw table, one partition per batch number."""

    def write(batch: DataFrame, epoch: int) -> None:
        overwrite_partitions(batch.withColumn(EPOCH, F.lit(epoch)), table, [EPOCH], clear=[{EPOCH: epoch}])

    return write


BUCKETS = 64  # parts of the order state; a micro-batch rewrites those it touches


def _seen(spark: SparkSession, table: str, now: DataFrame, epoch: int) -> DataFrame:
    """First and last event times, as of before this micro-batch, of the orders it touches.

    A row remembers what held before the batch that wrote it, so a replayed
    batch sees the same as its first attempt.
    """
    if not table_exists(spark, table):
        return now.filter("false").select("order_id", F.col("lo").alias("first_ts"), F.col("hi").alias("last_ts"))
    again = F.col(EPOCH) == epoch
    return spark.table(table).join(now.select("bucket", "order_id"), ["bucket", "order_id"], "left_semi").select(
        "order_id", F.when(again, F.col("first_before")).otherwise(F.col("first_ts")).alias("first_ts"),
        F.when(again, F.col("last_before")).otherwise(F.col("last_ts")).alias("last_ts")).filter("last_ts IS NOT NULL")


def _remember(spark: SparkSession, table: str, now: DataFrame, epoch: int) -> None:
    columns = "order_id string, first_ts timestamp_ntz, last_ts timestamp_ntz, first_before timestamp_ntz, last_before timestamp_ntz, stream_epoch int, bucket int"
    known = spark.table(table) if table_exists(spark, table) else spark.createDataFrame([], columns)
    touched = F.broadcast(now.select("bucket").distinct())  # BUCKETS rows at most
    both = known.join(touched, "bucket", "left_semi").join(now, ["bucket", "order_id"], "full_outer")
    untouched, again = F.col("lo").isNull(), F.col(EPOCH) == epoch
    before = lambda side: F.when(untouched | again, F.col(f"{side}_before")).otherwise(F.col(f"{side}_ts")).alias(f"{side}_before")
    state = both.select(
        "order_id", F.least("first_ts", "lo").alias("first_ts"), F.greatest("last_ts", "hi").alias("last_ts"), before("first"), before("last"),
        F.when(untouched, F.col(EPOCH)).otherwise(F.lit(epoch)).alias(EPOCH), "bucket")
    overwrite_partitions(state, table, ["bucket"])


def to_transition_fact(raw_table: str, fact_table: str, dim_order: DataFrame, dim_state: DataFrame,
                       dim_party: DataFrame) -> Sink:
    """State changes of each micro-batch as transition rows.

    An order may continue from an earlier batch: first and last event times of
    the orders seen so far are kept in a keyed table beside the fact, and the
    highest key of each batch in another, so a micro-batch costs what it
    touches and never reads the history of events. A trigger may find several
    load batches; each row keeps the id of its own.
    """
    state, keys = f"{fact_table}_orders", f"{fact_table}_keys"

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        to_raw_table(raw_table)(batch, epoch)
        fresh = spark.table(raw_table).filter(F.col(EPOCH) == epoch).withColumn("stg_record_status", F.lit("V"))
        stamp = parse_ts("event_timestamp")
        now = fresh.groupBy("order_id").agg(F.min(stamp).alias("lo"), F.max(stamp).alias("hi")).filter("lo IS NOT NULL").withColumn(
            "bucket", F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)).cast("int"))
        if now.isEmpty():
            return
        seen = _seen(spark, state, now, epoch)
        start: int | DataFrame = 0
        if table_exists(spark, keys):
            start = spark.table(keys).filter(F.col(EPOCH) < epoch).agg(F.max("highest").alias("k"))
        earliest = fresh.select("order_id", "event_timestamp").unionByName(
            seen.select("order_id", F.col("first_ts").cast("string").alias("event_timestamp")))
        rows = build_fact_transition(
            fresh, dim_order, dim_state, dim_party, None, all_events=earliest, key_start=start,
            last_seen=seen.select("order_id", "last_ts"),
        )
        overwrite_partitions(rows.withColumn(EPOCH, F.lit(epoch)), fact_table, [EPOCH], clear=[{EPOCH: epoch}])
        own = spark.table(fact_table).filter(F.col(EPOCH) == epoch).agg(F.max("transition_sk").alias("highest"))
        overwrite_partitions(own.select("highest", F.lit(epoch).alias(EPOCH)), keys, [EPOCH])
        _remember(spark, state, now, epoch)

    return write


def to_pipeline_flow(raw_readings: str, alarms: Callable[[SparkSession], DataFrame], fact_table: str) -> Sink:
    """Rebuild the flow fact for exactly the business dates a micro-batch touches."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        to_raw_table(raw_readings)(batch, epoch)
        days = spark.table(raw_readings).filter(F.col(EPOCH) == epoch).select("_business_date").distinct()
        readings = spark.table(raw_readings).filter(F.col(EPOCH) <= epoch).join(F.broadcast(days), "_business_date", "left_semi")
        raised = alarms(spark).join(F.broadcast(days), "_business_date", "left_semi")
        overwrite_partitions(build_fact_pipeline_flow(readings, raised), fact_table, ["date_key"])

    return write
