"""Daily batch, version store, increments and month state exercised end to end on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dq import GateFailed
from starloom.operators.histogram import percentiles, rolled_up, value_counts
from starloom.operators.sketches import distinct_counts, distinct_sketches
from starloom.operators.version_store import VersionStore
from starloom.plans import ops_facts, ops_marts
from starloom.plans.bucketed import BucketedStar
from starloom.plans.daily_batch import STATUS, DailyBatch, Delivery, seeded_dimensions
from starloom.plans.month_state import MonthState, month_name, refresh_months
from starloom.plans.ops_warehouse import OpsWarehouse
from starloom.plans.ops_warehouse import AS_OF as OPS_AS_OF
from starloom.plans.order_dims import CUSTOMER_TYPE1, CUSTOMER_TYPE2, conform_customers
from starloom.plans.order_warehouse import OrderWarehouse
from starloom.plans.round_trips import _scratch
from starloom.plans.warehouse import open_warehouse
from starloom.sources import tables
from starloom.sources.contracts import AS_OF, BATCH, FIRST_LOAD, contract
from starloom.sources.increments import DAY, SilverFact, back_fill, load_increment

FIRST_BATCH = "B0"


class _Stopped(RuntimeError):
    """A run is cut off here."""


def _batch(spark: SparkSession, sf_dir: str, name: str, gate: float | None, hook=lambda moment, step: None) -> DailyBatch:
    """A database as the load before left it, and the delivery of the day."""
    _, database = _scratch(spark, name)
    feed = lambda n: contract(spark, sf_dir, n)
    delivery = Delivery(feed("stg_orders"), feed("stg_items"), feed("stg_events"), feed("stg_customers_2"), feed("stg_offerings_2"))
    batch = DailyBatch(spark, database, delivery, BATCH, AS_OF, gate, hook)
    batch.references(feed("ref_geography"), feed("ref_parties"), FIRST_LOAD)
    seeded_dimensions(batch, feed("stg_customers_1"), feed("stg_offerings_1"), FIRST_LOAD)
    for table, rows in (("stg_customers", feed("stg_customers_1")), ("stg_offerings", feed("stg_offerings_1"))):
        tables.replace_batch(rows.withColumn("stg_batch_id", F.lit(FIRST_BATCH)), batch.name(table), FIRST_BATCH, "stg_batch_id")
    return batch


_resumed: dict[tuple[str, str], DailyBatch] = {}


def resumed_batch(spark: SparkSession, sf_dir: str) -> DailyBatch:
    """The whole daily batch, cut off at every step: after its work before the ledger knows of it, or right after that."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _resumed:
        cut: set[str] = set()

        def hook(moment: str, step: str) -> None:
            place = [s for s, _ in DailyBatch.STEPS].index(step)
            if step not in cut and moment == ("worked" if place % 2 else "recorded"):
                cut.add(step)
                raise _Stopped(step)

        batch = _batch(spark, sf_dir, "daily_batch", None, hook)
        while True:
            try:
                batch.run()
                break
            except _Stopped:  # another process takes over: nothing but the tables is left
                batch = DailyBatch(spark, batch.database, batch.delivery, BATCH, AS_OF, None, hook)
        _resumed[key] = batch
    return _resumed[key]


def batch_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging after the batch: the status is a partition, and has been moved on in the table itself."""
    return resumed_batch(spark, sf_dir).table("stg_orders").select("stg_record_id", "order_id", STATUS)


def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = resumed_batch(spark, sf_dir).table("run_ledger")
    return ledger.select("batch_id", "step", "position", F.explode_outer("rows_written").alias("table_name", "rows"))


def batch_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored error log, with what its raw records say of amount, price and customer."""
    record = F.from_json("raw_record_data", "total_amount string, price_amount string, customer_id string, national_id string")
    return resumed_batch(spark, sf_dir).table("err_log").select(
        "err_batch_id", "err_rule_code", "err_source_table", "order_id", "order_item_id", record["total_amount"].alias("total_amount"),
        record["price_amount"].alias("price_amount"), record["customer_id"].alias("customer_id"), record["national_id"].alias("national_id"))


def batch_halted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delivery behind its gate: it is judged and logged, and no dimension or fact is touched."""
    from starloom import constants as K

    batch = _batch(spark, sf_dir, "halted", K.ORDER_GATE)
    try:
        batch.run()
        halted = False
    except GateFailed:
        halted = True
    steps = batch.table("run_ledger").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "step"))), lambda s: s["step"]), ",").alias("steps"))
    versions = batch.table("dim_customer").filter(F.col("row_eff_dt") == F.lit(AS_OF).cast("date")).agg(F.count(F.lit(1)).alias("new_versions"))
    return batch.score().select("batch_id", "total_records", "valid_records", "dq_verdict").withColumns({
        "halted": F.lit(halted), "steps_finished": steps.scalar(), "new_versions": versions.scalar(),
        "fact_loaded": F.lit(tables.table_exists(spark, batch.name("fact_order")))})


def touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded into a version store: two snapshots, and the second one again."""
    _, database = _scratch(spark, "version_store")
    store = VersionStore(spark, f"{database}.customer", ["customer_bk"], "customer_sk", buckets=16)
    for snapshot, day in ((1, FIRST_LOAD), (2, AS_OF), (2, AS_OF)):
        store.load(conform_customers(contract(spark, sf_dir, f"stg_customers_{snapshot}")), CUSTOMER_TYPE2, day, CUSTOMER_TYPE1)
    return store.history()


FLOW = SilverFact("fact_pipeline_flow", ("raw_flow", "raw_alarm"), ops_facts.flow_rules, ops_facts.build_fact_pipeline_flow)


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow readings and alarms in three deliveries, the last of which repeats a day of the first: the fact after all of them."""
    _, database = _scratch(spark, "silver")
    readings, alarms = contract(spark, sf_dir, "flow_readings"), contract(spark, sf_dir, "alarms")
    day = F.dayofmonth(DAY)
    for run, mine in (("r1", day <= 10), ("r2", day.between(11, 20)), ("r3", (day > 20) | (day == 3))):
        # the first delivery of the third is short of half its readings
        short = (day == 3) & (F.hour("reading_ts") >= 12) if run == "r1" else F.lit(False)
        back_fill(readings.filter(mine & ~short), f"{database}.raw_flow", run)
        back_fill(alarms.filter(mine), f"{database}.raw_alarm", run)
        load_increment(spark, database, FLOW, "high_water")
    return spark.table(f"{database}.fact_pipeline_flow")


MONTHS = [202311, 202312, 202401]


def late_day(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    """Three months kept as sums of days, of which one day comes late and another one comes twice."""
    _, database = _scratch(spark, f"late_{mart}")
    w = open_warehouse(OpsWarehouse, spark, sf_dir)
    last = int(OPS_AS_OF.replace("-", ""))
    fact, partials = {
        "reliability": (w["fact_equipment_downtime"], ops_marts.RELIABILITY), "integrity": (w["fact_pipeline_flow"], ops_marts.FLOW)}[mart]
    fact, state = fact.filter(F.col("month_key").isin(*MONTHS)), MonthState(spark, f"{database}.{mart}_days", partials)
    days = fact.agg(F.max("date_key"), F.min("date_key")).first()  # two numbers
    late, again = (days[0] or last), (days[1] or last)
    state.put(fact.filter(F.col("date_key") != late))
    state.put(fact, [late])
    state.put(fact, [again])
    per = state.months(MONTHS, last)
    return ops_marts.reliability_of(per, w["dim_asset"], OPS_AS_OF) if mart == "reliability" else ops_marts.integrity_of(per)


def refreshed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard of three months, of which two are loaded again later."""
    _, database = _scratch(spark, "refreshed")
    w = open_warehouse(OpsWarehouse, spark, sf_dir)
    name = f"{database}.mart_hse_scorecard"
    rows = lambda months: ops_marts.mart_hse_scorecard(w["fact_hse_incident"], w["fact_maintenance_workorder"], w["dim_asset"], OPS_AS_OF, months)
    tables.write_append(rows(MONTHS), name, [ops_marts.MONTH])
    refresh_months(rows, name, MONTHS[1:])
    return spark.table(name).filter(F.col(ops_marts.MONTH).isin(*map(month_name, MONTHS)))


def approximate_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per month and channel from daily sketches, beside the exact count and whether they differ by less than 5 % or two."""
    fact = open_warehouse(OrderWarehouse, spark, sf_dir)["fact_order"]
    keys = ["month_sk", "channel_sk"]
    daily = distinct_sketches(fact, ["date_sk", *keys], {"estimate": "customer_sk"})
    exact = fact.groupBy(*keys).agg(F.count_distinct("customer_sk").alias("customers"))
    both = exact.join(distinct_counts(daily, keys, ["estimate"]), keys)
    return both.select(*keys, "customers", (F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(2.0), F.col("customers") * 0.05)).alias("close"))


def counted_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fulfilment hours by channel and region with subtotals, from counted values of the lowest groups."""
    fact = open_warehouse(OrderWarehouse, spark, sf_dir)["fact_order"]
    keys = ["channel_sk", "geography_sk"]
    counts = value_counts(fact, keys, "fulfilment_duration_hrs")
    rolled = rolled_up(counts, [keys, keys[:1], []], keys, "fulfilment_duration_hrs")
    return percentiles(rolled, [*keys, "grouping_level"], "fulfilment_duration_hrs", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def purged_by_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging cut by load date, eight of them a month apart, after the 90-day purge."""
    _, database = _scratch(spark, "purge")
    name = f"{database}.stg_orders"
    rows = contract(spark, sf_dir, "stg_orders").select(
        "order_id", "stg_record_id", F.date_sub(F.to_date("stg_load_dt"), (F.col("stg_record_id") % 8 * 30).cast("int")).alias("load_date"))
    tables.write_append(rows, name, ["load_date"])
    tables.purge_partitions(spark, [name], "load_date", AS_OF)
    return spark.table(name)


_stars: dict[tuple[str, str], BucketedStar] = {}


def bucketed_star(spark: SparkSession, sf_dir: str) -> BucketedStar:
    """The order star with its facts in buckets by order."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = BucketedStar(open_warehouse(OrderWarehouse, spark, sf_dir), _scratch(spark, "bucketed")[1])
    return _stars[key]


def seeds_in_use(spark: SparkSession, sf_dir: str, dimension: str) -> DataFrame:
    """A seeded dimension, every column of it, with the rows of its fact that point to each member."""
    w = open_warehouse(OrderWarehouse, spark, sf_dir)
    fact, mine, key = {
        "state": ("fact_order", "order_state_sk", "order_state_sk"), "channel": ("fact_order", "channel_sk", "channel_sk"), "action": ("fact_item", "action_sk", "action_sk")}[dimension]
    used = w[fact].groupBy(F.col(mine).cast("int").alias(key)).agg(F.count(F.lit(1)).alias("fact_rows"))
    return w[f"dim_{dimension}"].join(used, key, "left").fillna(0, ["fact_rows"])
