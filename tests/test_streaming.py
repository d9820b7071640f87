import pytest
from pyspark.sql import functions as F

from starloom.plans import calendar as cal
from starloom.plans.ops_facts import build_fact_pipeline_flow
from starloom.plans.order_facts import build_fact_transition
from starloom.streaming import events as S

SCHEMA = (
    "stg_record_id long, stg_batch_id string, order_id string, from_state string, to_state string, event_timestamp string, "
    "change_reason_code string, change_reason_desc string, changed_by_user_id string, is_automated_change string, event_source string, ts timestamp"
)


def event(i, order, day, hour):
    stamp = f"2024-01-{day:02d} {hour:02d}:30:00"
    return (i, "B", order, "ACK", "pending", stamp, None, None, None, None, "OMS", stamp)


FIRST = [event(1, "O1", 1, 1), event(2, "O1", 1, 5), event(3, "O2", 1, 2)]
SECOND = [event(4, "O1", 2, 3), event(5, "O2", 2, 2), event(5, "O2", 2, 2), event(6, "O9", 2, 2)]


@pytest.fixture
def star(spark):
    orders = spark.createDataFrame([(1, "O1", "Y"), (2, "O2", "Y")], "order_sk long, order_bk string, current_row_flag string")
    party = spark.createDataFrame([], "party_sk long, party_bk string, current_row_flag string")
    return orders, cal.seed_order_states(spark), party


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.replace("ts timestamp", "ts string")).withColumn("ts", F.col("ts").cast("timestamp"))


def key(rows):
    return sorted((r.order_bk, r.transition_date_sk, r.transition_time_sk, float(r.duration_in_from_state_hrs), r.sla_elapsed_pct) for r in rows)


def test_two_micro_batches_equal_one_load(spark, database, star, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "ckpt")
    raw, fact = f"{database}.raw_events", f"{database}.fact_transition"
    for rows in (FIRST, SECOND):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = S.without_repeats(S.read_events(spark, folder, SCHEMA), ["stg_record_id"], "ts", "30 days")
        query = S.stream_events(stream, S.to_transition_fact(raw, fact, *star), "t_events", state)
        query.awaitTermination(120)
        assert query.exception() is None
    assert spark.table(raw).count() == 6  # the repeated event came once
    whole = frame(spark, FIRST + SECOND).dropDuplicates(["stg_record_id"]).withColumn("stg_record_status", F.lit("V"))
    batch = build_fact_transition(whole, *star, "B")
    assert key(spark.table(fact).collect()) == key(batch.collect())
    keys = sorted(r.transition_sk for r in spark.table(fact).collect())
    assert keys == list(range(1, len(keys) + 1))


def test_replayed_micro_batch_replaces_itself(spark, database, star):
    raw, fact = f"{database}.raw_events", f"{database}.fact_transition"
    sink = S.to_transition_fact(raw, fact, *star)
    sink(frame(spark, FIRST), 0)
    once = key(spark.table(fact).collect())
    sink(frame(spark, FIRST), 0)
    assert key(spark.table(fact).collect()) == once


def test_flow_days_are_rebuilt(spark, database):
    schema = "pipeline_segment_id string, flow_rate_bpd double, line_pressure_psi double, _business_date date"
    rows = lambda *r: spark.createDataFrame([(s, f, 1.0, d) for s, f, d in r], schema.replace("date date", "date string")).withColumn(
        "_business_date", F.col("_business_date").cast("date"))
    alarms = spark.createDataFrame([("S1", "CRITICAL", "2024-01-01")], "pipeline_segment_id string, severity string, d string").select(
        "pipeline_segment_id", "severity", F.col("d").cast("date").alias("_business_date"))
    raw, fact = f"{database}.raw_flow", f"{database}.fact_flow"
    sink = S.to_pipeline_flow(raw, lambda _: alarms, fact)
    a, b = [("S1", 10.0, "2024-01-01"), ("S2", 1.0, "2024-01-02")], [("S1", 30.0, "2024-01-01")]
    sink(rows(*a), 0)
    sink(rows(*b), 1)
    want = build_fact_pipeline_flow(rows(*a, *b), alarms)
    pick = lambda d: sorted((r.date_key, r.pipeline_segment_id, r.avg_flow_rate_bpd, r.critical_alarm_count) for r in d.collect())
    assert pick(spark.table(fact)) == pick(want)
