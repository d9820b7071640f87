"""Runs that are cut off, deliveries that come again, and stores that rewrite only what a load touches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators import version_store
from starloom.operators.dq import REJECT, GateContext, Rule, run_dq_gate
from starloom.operators.histogram import percentiles, rolled_up, value_counts
from starloom.operators.scd import scd2_apply
from starloom.operators.sketches import distinct_counts, distinct_sketches
from starloom.operators.version_store import VersionStore
from starloom.plans import ops_marts as marts
from starloom.plans.batch_trips import FLOW, resumed_batch
from starloom.plans.daily_batch import DailyBatch, Delivery
from starloom.plans.month_state import MonthState, refresh_months
from starloom.sources import tables as t
from starloom.sources.increments import DAY, HighWater, back_fill, load_increment
from starloom.sources.ledger import RunLedger, input_version

SF = "/root/testdata/sf0.001"


def files(spark, table, **values):
    rows = spark.table(table)
    for name, value in values.items():
        rows = rows.filter(F.col(name) == value)
    return set(rows.inputFiles())


# -- ledger and daily batch --------------------------------------------------


def test_ledger_counts_a_step_for_its_input_only(spark, database):
    ledger = RunLedger(spark, f"{database}.ledger")
    assert ledger.finished("B1", "v1") == set()
    ledger.record("B1", "stage", 1, "v1", {"a": 3, "b": 0})
    ledger.record("B1", "stage", 1, "v1", {"a": 3, "b": 0})
    ledger.record("B1", "check", 2, "v1", {})
    assert ledger.finished("B1", "v1") == {"stage", "check"} and ledger.finished("B1", "v2") == set() and ledger.finished("B2", "v1") == set()
    assert spark.table(f"{database}.ledger").count() == 2


def test_input_version_is_that_of_the_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    one = lambda: input_version([spark.read.parquet(str(tmp_path / "a"))])
    before = one()
    assert one() == before
    spark.range(1).write.mode("append").parquet(str(tmp_path / "a"))
    assert one() != before


def test_a_finished_batch_does_nothing_and_another_delivery_starts_again(spark):
    batch = resumed_batch(spark, SF)
    before = files(spark, batch.name("fact_order"))
    assert batch.run() == [] and files(spark, batch.name("fact_order")) == before
    d = batch.delivery
    fewer = Delivery(d.orders, d.items, d.events, d.customers, spark.read.parquet(f"{SF}/part.parquet").limit(0).selectExpr("'x' as other"))
    assert fewer.version != d.version
    again = DailyBatch(spark, batch.database, fewer, batch.batch_id, batch.load_date, None)
    assert again.ledger.finished(batch.batch_id, fewer.version) == set()


def test_batch_leaves_no_staging_row_under_two_status(spark):
    batch = resumed_batch(spark, SF)
    rows = batch.table("stg_orders").groupBy("stg_record_id").count().filter("count > 1")
    assert rows.count() == 0
    status = {r[0] for r in batch.table("stg_orders").select("stg_record_status").distinct().collect()}
    assert status == {"P", "E"}
    assert {r[0] for r in batch.table("stg_events").select("stg_record_status").distinct().collect()} == {"P"}
    raw = batch.table("err_log").filter("err_source_table = 'stg_customer'").first().raw_record_data
    assert "customer_id" in raw and "national_id" not in raw


def test_partition_advances_whole_also_when_cut_off(spark, database, monkeypatch):
    name = f"{database}.stg"
    rows = spark.createDataFrame([(1, "B", "V"), (2, "B", "E"), (3, "C", "V")], "id int, batch string, status string")
    t.write_append(rows, name, ["batch", "status"])
    old, new = {"batch": "B", "status": "V"}, {"batch": "B", "status": "P"}
    t.overwrite_partitions(spark.table(name).filter("id = 1").withColumn("status", F.lit("P")), name)  # cut off before the old rows went
    for _ in range(2):
        t.advance_partition(spark, name, old, new)
        assert sorted((r.id, r.status) for r in spark.table(name).collect()) == [(1, "P"), (2, "E"), (3, "V")]


# -- version store -----------------------------------------------------------


def people(spark, rows):
    return spark.createDataFrame(rows, "k string, a string, b int")


def store_of(spark, database):
    return VersionStore(spark, f"{database}.people", ["k"], "sk", buckets=8)


FIRST = [(f"k{i}", "x", i) for i in range(60)]
SECOND = [("k3", "y", 3), ("k4", "x", 400), ("k5", "x", 5), ("new", "z", 1), ("k3", "y", 3), (None, "q", 0)]


def load(store, spark, rows, day):
    return store.load(people(spark, rows), ["a"], day, ["b"])


def expected(spark):
    one = scd2_apply(None, people(spark, FIRST), ["k"], ["a"], "2026-01-01", "sk", version_store.ORDER_HISTORY, type1=["b"])
    return scd2_apply(one, people(spark, SECOND), ["k"], ["a"], "2026-01-02", "sk", version_store.ORDER_HISTORY, type1=["b"])


def told(df):
    return sorted(str(tuple(r)) for r in df.select("sk", "k", "a", "b", "row_eff_dt", "row_exp_dt", "current_row_flag").collect())


def test_store_equals_the_frame_function_and_rewrites_touched_buckets_only(spark, database):
    store = store_of(spark, database)
    load(store, spark, FIRST, "2026-01-01")
    before = {b: files(spark, store.table, slice="current", bucket=b) for b in range(8)}
    touched = load(store, spark, SECOND, "2026-01-02")
    assert told(store.history()) == told(expected(spark))
    after = {b: files(spark, store.table, slice="current", bucket=b) for b in range(8)}
    assert 0 < len(touched) < 8
    for b in range(8):
        assert (after[b] == before[b]) == (b not in touched), b
    closed = files(spark, store.table, slice="closed 2026-01-02")
    everything = files(spark, store.table)
    assert load(store, spark, SECOND, "2026-01-02") == [] and load(store, spark, FIRST[10:20], "2026-01-03") == []
    assert files(spark, store.table) == everything and closed
    assert {r.k for r in store.current().collect()} == {*(f"k{i}" for i in range(60)), "new"}
    # a later load neither reads nor writes closed versions
    load(store, spark, [("k3", "w", 3)], "2026-01-04")
    assert files(spark, store.table, slice="closed 2026-01-02") == closed
    assert [r.a for r in store.history().filter("k = 'k3'").orderBy("row_eff_dt").collect()] == ["x", "y", "w"]


@pytest.mark.parametrize("writes", [1, 2])
def test_store_survives_a_load_that_is_cut_off(spark, database, monkeypatch, writes):
    store = store_of(spark, database)
    load(store, spark, FIRST, "2026-01-01")
    real, done = version_store.overwrite_partitions, []

    def cut(*args, **named):
        if len(done) == writes:
            raise RuntimeError("cut off")
        done.append(1)
        real(*args, **named)

    monkeypatch.setattr(version_store, "overwrite_partitions", cut)
    with pytest.raises(RuntimeError):
        load(store, spark, SECOND, "2026-01-02")
    monkeypatch.setattr(version_store, "overwrite_partitions", real)
    load(store, spark, SECOND, "2026-01-02")
    assert told(store.history()) == told(expected(spark))


# -- increments --------------------------------------------------------------


def readings(spark, *rows):
    schema = "pipeline_segment_id string, reading_ts timestamp_ntz, flow_rate_bpd double, line_pressure_psi double, _business_date date"
    return spark.createDataFrame([(s, dt.datetime(2026, 1, d, 3), v, 1.0, dt.date(2026, 1, d)) for s, d, v in rows], schema)


def alarms(spark, *rows):
    return spark.createDataFrame([(s, "LEAK", "CRITICAL", dt.date(2026, 1, d)) for s, d in rows], "pipeline_segment_id string, alarm_type string, severity string, _business_date date")


def flows(spark, database):
    return sorted((r.date_key, r.pipeline_segment_id, r.avg_flow_rate_bpd, r.leak_alarm_count) for r in spark.table(f"{database}.fact_pipeline_flow").collect())


def test_increment_reads_pending_days_only(spark, database):
    raw, alarm = f"{database}.raw_flow", f"{database}.raw_alarm"
    back_fill(readings(spark, ("S1", 1, 10.0), ("S1", 2, 20.0), ("S2", 2, 4.0)), raw, "r1")
    back_fill(alarms(spark, ("S1", 2)), alarm, "r1")
    first = load_increment(spark, database, FLOW, "marks")
    assert first.days == ["2026-01-01", "2026-01-02"]
    assert flows(spark, database) == [(20260101, "S1", 10.0, 0), (20260102, "S1", 20.0, 1), (20260102, "S2", 4.0, 0)]
    assert load_increment(spark, database, FLOW, "marks").days == []
    kept = files(spark, f"{database}.fact_pipeline_flow", date_key=20260101)
    # one more day, one day delivered again, one alarm that comes late
    back_fill(readings(spark, ("S1", 3, 7.0), ("S1", 2, 30.0)), raw, "r2")
    second = load_increment(spark, database, FLOW, "marks")
    assert second.days == ["2026-01-02", "2026-01-03"]
    assert all("_business_date=2026-01-01" not in f for df in second.read.values() for f in df.inputFiles())
    assert flows(spark, database) == [(20260101, "S1", 10.0, 0), (20260102, "S1", 30.0, 1), (20260103, "S1", 7.0, 0)]
    back_fill(alarms(spark, ("S1", 3)), alarm, "r3")
    assert load_increment(spark, database, FLOW, "marks").days == ["2026-01-03"]
    assert flows(spark, database)[-1] == (20260103, "S1", 7.0, 1) and files(spark, f"{database}.fact_pipeline_flow", date_key=20260101) == kept
    # another consumer has read nothing yet
    assert HighWater(spark, f"{database}.marks").pending("other", [raw]) == ["2026-01-01", "2026-01-02", "2026-01-03"]


def test_a_day_below_its_gate_is_not_loaded_until_it_is_delivered_again(spark, database, monkeypatch):
    raw = f"{database}.raw_flow"
    back_fill(alarms(spark, ("S9", 9)), f"{database}.raw_alarm", "r1")
    back_fill(readings(spark, ("S1", 1, 10.0), ("S1", 2, -1.0), ("S1", 2, 5.0)), raw, "r1")
    load_increment(spark, database, FLOW, "marks")
    assert flows(spark, database) == [(20260101, "S1", 10.0, 0)]
    told = {str(r[DAY]): r.gate_result for r in spark.table(f"{database}.fact_pipeline_flow_verdicts").collect()}
    assert told == {"2026-01-01": "PASS", "2026-01-02": "FAIL"}
    back_fill(readings(spark, ("S1", 2, 6.0)), raw, "r2")
    # cut off before the mark moves: the day is read once more
    real = HighWater.advance
    monkeypatch.setattr(HighWater, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
    with pytest.raises(RuntimeError):
        load_increment(spark, database, FLOW, "marks")
    monkeypatch.setattr(HighWater, "advance", real)
    assert load_increment(spark, database, FLOW, "marks").days == ["2026-01-02"]
    assert flows(spark, database) == [(20260101, "S1", 10.0, 0), (20260102, "S1", 6.0, 0)]


# -- months, sketches, percentiles, metrics ----------------------------------


def downtime(spark, *rows):
    return spark.createDataFrame([(d, a, h, d // 100) for d, a, h in rows], "date_key int, asset_sk long, downtime_hours double, month_key int")


def test_late_day_replaces_its_own_partition(spark, database):
    rows = [(20260101, 1, 2.0), (20260101, 2, 1.0), (20260115, 1, None), (20260203, 1, 4.0)]
    state = MonthState(spark, f"{database}.days", marts.RELIABILITY)
    state.put(downtime(spark, *rows))
    before = {d: files(spark, state.table, date_key=d) for d in (20260101, 20260115, 20260203)}
    state.put(downtime(spark, *rows, (20260120, 1, 3.0)), [20260120])
    assert all(files(spark, state.table, date_key=d) == f for d, f in before.items())
    got = {(r.year_month, r.asset_sk): (r.failures, r.down) for r in state.months([202601]).collect()}
    assert got == {("2026-01", 1): (3, 5.0), ("2026-01", 2): (1, 1.0)}
    assert all("month_key=202601" in f for f in state.spark.table(state.table).filter("month_key = 202601").inputFiles())
    state.put(downtime(spark, (20260203, 1, 4.0)).limit(0), [20260101])  # the day was delivered empty
    assert {(r.asset_sk, r.failures) for r in state.months([202601]).collect()} == {(1, 2)}
    assert state.months([202601], 20260116).first().failures == 1


def test_refreshed_month_is_emptied_and_others_stay(spark, database):
    fact, name = downtime(spark, (20260101, 1, 2.0), (20260203, 1, 4.0)), f"{database}.m"
    asset = spark.createDataFrame([(1, "A1", "F1", "Y")], "asset_sk long, asset_id string, facility_id string, current_row_flag string")
    rows = lambda f: lambda months: marts.mart_equipment_reliability(f, asset, "2026-02-28", months)
    t.write_append(rows(fact)(None), name, [marts.MONTH])
    january = files(spark, name, year_month="2026-01")
    refresh_months(rows(fact.filter("month_key = 202601")), name, [202602])
    assert [r.year_month for r in spark.table(name).collect()] == ["2026-01"] and files(spark, name, year_month="2026-01") == january


def test_months_asked_for_are_pruned(spark, tmp_path):
    downtime(spark, *[(20260001 + 100 * m, 1, 1.0) for m in range(1, 13)]).write.partitionBy("month_key").parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    plan = marts._until(fact, "2026-12-31", [202603])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "202603" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_counted_percentiles_equal_percentile_disc(spark):
    rows = [(i % 3, i % 2, float((i * 7919) % 23)) for i in range(500)] + [(0, 0, None), (1, 1, 99.0), (None, 1, 5.0)]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    sets = [["a", "b"], ["a"], []]
    got = percentiles(rolled_up(value_counts(df, ["a", "b"], "v"), sets, ["a", "b"], "v"), ["a", "b", "grouping_level"], "v", {"p1": 0.01, "p50": 0.5, "p95": 0.95, "p100": 1.0})
    want = df.filter("v IS NOT NULL").groupingSets(sets, "a", "b").agg(F.grouping_id().alias("grouping_level"), *(
        F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").alias(n) for n, p in (("p1", 0.01), ("p50", 0.5), ("p95", 0.95), ("p100", 1.0))))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_sketches_of_days_unite_within_their_error(spark):
    df = spark.range(200_000).selectExpr("cast(id % 30 as int) as day", "id % 3 as g", "(id * 7919) % 50021 as who")
    names, exact = ["n"], {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("who").alias("n")).collect()}
    for precision, error in ((14, 0.03), (10, 0.12)):
        daily = distinct_sketches(df, ["day", "g"], {"n": "who"}, precision)
        got = {r.g: r.n for r in distinct_counts(daily, ["g"], names).collect()}
        assert all(abs(got[g] - exact[g]) <= error * exact[g] for g in exact)
    none = distinct_counts(distinct_sketches(df.select("day", "g", F.lit(None).cast("long").alias("who")), ["day", "g"], {"n": "who"}), ["g"], names)
    assert {r.n for r in none.collect()} == {0}


def test_gate_evaluates_every_row_once(spark, database):
    seen = spark.sparkContext.accumulator(0)

    def positive(v):
        seen.add(1)
        return v is not None and v > 0

    rule = Rule("R1", "not positive", REJECT, F.udf(positive, "boolean")("v"))
    df = spark.createDataFrame([(i - 1,) for i in range(100)], "v int")
    ctx = GateContext("run", "2026-01-01", f"{database}.rejects", f"{database}.audit")
    valid = run_dq_gate(df, [rule], "bdh.fact_equipment_downtime", ctx)
    row = spark.table(ctx.audit_table).first()
    assert (row.total_rows, row.passed_rows, row.rejected_rows, row.warned_rows) == (100, 98, 2, 0)
    assert valid.count() == 98 and spark.table(ctx.reject_table).count() == 2 and seen.value == 100
    assert run_dq_gate(df.limit(0), [rule], "bdh.x", ctx, "empty").count() == 0
