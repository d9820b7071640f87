import datetime as dt

from pyspark.sql import functions as F

from starloom.operators.dq import evaluate_rules
from starloom.plans import ops_dims as D
from starloom.plans import ops_facts as facts
from starloom.plans import ops_marts as marts


def readings(spark, *rows):
    schema = ("well_id string, field_id string, reading_ts timestamp_ntz, oil_rate_bopd double, gas_rate_mscfd double, water_rate_bwpd double, "
              "tubing_pressure_psi double, well_status_code string, _business_date date")
    return spark.createDataFrame([(w, "F1", dt.datetime(2026, 1, d, h), oil, 1.0, 1.0, 100.0, s, dt.date(2026, 1, d)) for w, d, h, oil, s in rows], schema)


def test_plan_is_the_trailing_week_and_never_looks_ahead(spark):
    rows = [("W1", d, 3, float(d), "PRODUCING") for d in (1, 2, 9, 20)] + [("W1", 2, 4, 4.0, "SHUT_IN")]
    wells = D.build_dim_well_field(readings(spark, *rows), None, "2026-01-01")
    whole = {r.date_key: r for r in facts.build_fact_production_daily(readings(spark, *rows), wells).collect()}
    plan = {k: r.planned_volume_bbl for k, r in whole.items()}
    assert plan == {20260101: 1.0, 20260102: 1.0, 20260109: 3.0, 20260120: 20.0}
    assert (whole[20260102].uptime_hours, whole[20260102].downtime_hours) == (1.0, 23.0)
    # day by day over history gives the same, also when a day is run again
    done = None
    for d in (1, 2, 9, 20, 9):
        day = readings(spark, *[r for r in rows if r[1] == d])
        new = facts.build_fact_production_daily(day, wells, done)
        assert {r.date_key: r.planned_volume_bbl for r in new.collect()} == {20260100 + d: plan[20260100 + d]}
        keep = new if done is None else done.filter(F.col("date_key") != 20260100 + d).unionByName(new)
        done = spark.createDataFrame(keep.collect(), keep.schema)


def test_open_downtime_is_kept_and_reversed_is_rejected(spark):
    at = dt.datetime(2026, 1, 1, 5)
    df = spark.createDataFrame([("A1", at, None), ("A1", at, at.replace(hour=3)), ("A1", at, at.replace(hour=8)), (None, at, at)],
                               "asset_id string, downtime_start_ts timestamp_ntz, downtime_end_ts timestamp_ntz")
    assert evaluate_rules(df, facts.downtime_rules()).valid.count() == 2


def test_crew_wins_over_employee(spark):
    work = spark.createDataFrame([("P1",), (None,)], "assigned_crew_id string")
    hurt = spark.createDataFrame([("P1",), ("P2",)], "involved_employee_id string")
    got = {r.party_id: r.party_type for r in D.build_dim_employee_vendor(work, hurt, None).collect()}
    assert got == {"P1": "CREW", "P2": "EMPLOYEE"}


def test_running_month_counts_elapsed_days(spark):
    down = spark.createDataFrame([(20260110, 1, 24.0), (20260210, 1, 12.0)], "date_key int, asset_sk long, downtime_hours double")
    asset = spark.createDataFrame([(1, "A1", "F1", "Y")], "asset_sk long, asset_id string, facility_id string, current_row_flag string")
    got = {r.year_month: r for r in marts.mart_equipment_reliability(down, asset, "2026-02-10").collect()}
    assert got["2026-01"].mtbf_hours == 31 * 24 - 24 and got["2026-02"].mtbf_hours == 10 * 24 - 12
    assert set(r.year_month for r in marts.mart_equipment_reliability(down, asset, "2026-01-31").collect()) == {"2026-01"}


def test_unit_cost_only_for_upstream_and_zero_budget(spark):
    actual = spark.createDataFrame([(20260101, 1, 50, 0), (20260101, 2, 50, 25)], "date_key int, cost_center_sk long, actual_amount_usd int, budget_amount_usd int")
    actual = actual.select("date_key", "cost_center_sk", *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("actual_amount_usd", "budget_amount_usd")])
    center = spark.createDataFrame([(1, "UP-1", "upstream"), (2, "DS-1", "downstream")], "cost_center_sk long, cost_center_code string, business_domain string")
    made = spark.createDataFrame([(20260105, 10.0)], "date_key int, total_oil_bbl double")
    got = {r.cost_center_code: r for r in marts.mart_financial_cost(actual, center, made, "2026-01-31").collect()}
    assert (got["UP-1"].variance_pct, got["UP-1"].cost_per_bbl_usd) == (None, 5.0)
    assert (got["DS-1"].variance_pct, got["DS-1"].cost_per_bbl_usd) == (100.0, None)


def test_a_fact_waits_only_for_its_own_feeds(spark):
    from starloom.plans.ops_warehouse import OpsWarehouse
    from starloom.session import shared_dir

    fresh = OpsWarehouse(spark, "/root/testdata/sf0.001", f"{shared_dir(spark)}/warehouse/ops_only")
    fresh["fact_hse_incident"]
    assert {n for n in fresh._ready if n.startswith("tagged_")} == {"tagged_incidents"}
    # one fact's verdicts are those of the whole list
    whole = fresh["gate_days"].filter("target_table = 'fact_hse_incident'")
    assert sorted(map(str, whole.collect())) == sorted(map(str, fresh["days_fact_hse_incident"].collect())) != []
