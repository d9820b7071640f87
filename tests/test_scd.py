import pytest
import datetime as dt

from pyspark.sql import functions as F

from starloom.operators.scd import classify_changes, lookup_as_of, scd1_upsert, scd2_apply, PIPELINE_HISTORY

OPEN = dt.date(9999, 12, 31)


def assets(spark, *rows):
    return spark.createDataFrame(list(rows), "asset_id string, status string")


def load(target, source, as_of, **kw):
    return scd2_apply(target, source, ["asset_id"], ["status"], as_of, "asset_sk", **kw)


def versions(df, key="A1"):
    return sorted(df.filter(F.col("asset_id") == key).collect(), key=lambda r: r.row_eff_date)


def one_current_no_overlap(df):
    for key in {r.asset_id for r in df.select("asset_id").collect()}:
        rows = versions(df, key)
        assert [r.current_row_flag for r in rows].count("Y") <= 1
        for a, b in zip(rows, rows[1:]):
            assert a.row_exp_date < b.row_eff_date


def test_change_expires_and_new_key_opens(spark):
    first = load(None, assets(spark, ("A1", "ACTIVE")), "2026-01-01")
    second = load(first, assets(spark, ("A1", "INACTIVE"), ("A2", "ACTIVE")), "2026-01-02")
    old, new = versions(second)
    assert (old.current_row_flag, old.row_exp_date) == ("N", dt.date(2026, 1, 1))
    assert (new.current_row_flag, new.row_eff_date, new.row_exp_date) == ("Y", dt.date(2026, 1, 2), OPEN)
    assert versions(second, "A2")[0].current_row_flag == "Y"
    assert sorted(r.asset_sk for r in second.collect()) == [1, 2, 3]
    one_current_no_overlap(second)


def test_unchanged_is_a_no_op_and_replay_changes_nothing(spark):
    first = load(None, assets(spark, ("A1", "ACTIVE"), ("A2", "X")), "2026-01-01")
    same = load(first, assets(spark, ("A1", "ACTIVE")), "2026-01-02")
    assert sorted(same.collect()) == sorted(first.collect())
    batch = assets(spark, ("A1", "INACTIVE"), ("A3", "NEW"))
    once = load(first, batch, "2026-01-02")
    twice = load(once, batch, "2026-01-02")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_null_attribute_does_not_make_a_false_version(spark):
    first = load(None, assets(spark, ("A1", None)), "2026-01-01")
    assert load(first, assets(spark, ("A1", None)), "2026-01-02").count() == 1


def test_null_key_is_ignored_and_duplicates_collapse(spark):
    first = load(None, assets(spark, (None, "X"), ("A1", "ACTIVE"), ("A1", "ACTIVE")), "2026-01-01")
    assert first.count() == 1


def test_target_row_without_hash_counts_as_changed(spark):
    first = load(None, assets(spark, ("A1", "ACTIVE")), "2026-01-01").withColumn("change_hash", F.lit(None).cast("string"))
    assert load(first, assets(spark, ("A1", "ACTIVE")), "2026-01-05").count() == 2


def test_missing_keys_stay_open_unless_asked(spark):
    first = load(None, assets(spark, ("A1", "ACTIVE"), ("A2", "ACTIVE")), "2026-01-01")
    assert versions(load(first, assets(spark, ("A1", "ACTIVE")), "2026-01-02"), "A2")[0].current_row_flag == "Y"
    gone = load(first, assets(spark, ("A1", "ACTIVE")), "2026-01-02", expire_missing=True)
    assert versions(gone, "A2")[0].current_row_flag == "N"


def test_type1_column_is_overwritten_in_place(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "asset_id string, status string, score int")
    first = load(None, rows(("A1", "ACTIVE", 1), ("A2", "ACTIVE", 1)), "2026-01-01", type1=["score"])
    second = load(first, rows(("A1", "ACTIVE", 9), ("A2", "DOWN", 7)), "2026-01-02", type1=["score"])
    assert [r.score for r in versions(second)] == [9]
    assert [r.score for r in versions(second, "A2")] == [1, 7]


def centers(spark, *rows):
    return spark.createDataFrame(list(rows), "cost_center_code string, cost_center_name string")


def test_type1_seed_update_and_new(spark):
    args = (["cost_center_code"], ["cost_center_name"], "cost_center_sk")
    first = scd1_upsert(None, centers(spark, ("CC1", "Upstream Ops"), ("CC2", "Downstream Ops")), *args)
    assert sorted((r.cost_center_sk, r.cost_center_code) for r in first.collect()) == [(1, "CC1"), (2, "CC2")]
    second = scd1_upsert(first, centers(spark, ("CC1", "Renamed"), ("CC3", "Brand New"), ("CC2", None)), *args)
    got = {r.cost_center_code: (r.cost_center_sk, r.cost_center_name) for r in second.collect()}
    assert got == {"CC1": (1, "Renamed"), "CC2": (2, None), "CC3": (3, "Brand New")}


def test_classes_and_point_in_time(spark):
    names = PIPELINE_HISTORY
    rows = lambda *r: spark.createDataFrame(list(r), "asset_id string, status string, score int")
    first = load(None, rows(("A", "1", 1), ("B", "1", 1), ("C", "1", 1)), "2026-01-01")
    classes = classify_changes(first, rows(("A", "1", 1), ("B", "2", 1), ("C", "1", 5), ("D", "1", 1)), ["asset_id"], ["status"], ["score"], names)
    assert {r.asset_id: r.change_type for r in classes.collect()} == {
        "A": "UNCHANGED", "B": "SCD2_CHANGE", "C": "SCD1_CHANGE", "D": "NEW"}
    second = load(first, rows(("B", "2", 1)), "2026-02-01")
    facts = spark.createDataFrame([("B", dt.date(2026, 1, 15)), ("B", dt.date(2026, 2, 1)), ("B", dt.date(2025, 1, 1))], "asset_id string, d date")
    got = {r.d: r.status for r in lookup_as_of(facts, second, ["asset_id"], "d", names).collect()}
    assert got == {dt.date(2026, 1, 15): "1", dt.date(2026, 2, 1): "2", dt.date(2025, 1, 1): None}


def test_point_in_time_refuses_clashing_names_and_keeps_missing_keys(spark):
    names = PIPELINE_HISTORY
    dim = spark.sql(f"SELECT 'a' AS k, 's' AS status, DATE '2026-01-01' AS {names.eff}, DATE '9999-12-31' AS {names.exp}, 1 AS d")
    facts = spark.createDataFrame([("a", "2026-02-01"), (None, "2026-02-01"), ("a", None)], "k string, d string")
    with pytest.raises(ValueError, match="prefix"):
        lookup_as_of(facts, dim, ["k"], "d", names)
    got = lookup_as_of(facts, dim, ["k"], "d", names, prefix="dim_").collect()
    assert sorted(str(r.dim_status) for r in got) == ["None", "None", "s"] and len(got) == 3


def test_merged_lookup_equals_the_range_test_with_a_hot_key(spark):
    """One key holds nearly all facts and is cut over partitions; others have gaps, late versions, or none."""
    from starloom.operators.asof import merge_as_of

    day = lambda n: dt.date(2026, 1, 1) + dt.timedelta(n)
    versions = [("hot", f"v{i}", day(10 * i), day(10 * i + 9) if i < 20 else OPEN) for i in range(3, 21)]
    versions += [("gap", "g1", day(5), day(9)), ("gap", "g2", day(20), OPEN), ("late", "l1", day(500), OPEN), ("one", "o", day(0), OPEN)]
    dim = spark.createDataFrame(versions, "k string, name string, row_eff_dt date, row_exp_dt date")
    rows = [("hot", dt.datetime(2026, 1, 1, 7) + dt.timedelta(i % 300), i) for i in range(3000)]
    rows += [(k, dt.datetime(2026, 1, 1) + dt.timedelta(n), 10_000 + n) for k in ("gap", "late", "one", "none") for n in (0, 5, 9, 10, 19, 20, 40)]
    rows += [(None, dt.datetime(2026, 1, 5), 1), ("one", None, 2), ("one", dt.datetime(2026, 1, 5), 3), ("one", dt.datetime(2026, 1, 5), 3)]
    facts = spark.createDataFrame(rows, "k string, at timestamp_ntz, id int").repartition(7)
    want = lookup_as_of(facts, dim, ["k"], "at", prefix="d_")
    got = merge_as_of(facts, dim, ["k"], "at", prefix="d_")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        merge_as_of(facts.withColumn("name", F.lit(1)), dim, ["k"], "at")
    assert merge_as_of(facts.limit(0), dim, ["k"], "at").count() == 0
    assert merge_as_of(facts, dim.limit(0), ["k"], "at").filter("name IS NOT NULL").count() == 0
