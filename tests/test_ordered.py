"""Global numbering, previous value and running totals against brute force, with a hot key."""

import random

from pyspark.sql import functions as F

from starloom.operators.keyed import latest_per_key, lookup
from starloom.operators.ordered import PID, RN, assign_surrogate_keys, number_rows, with_previous, with_running


def skewed(n=3000):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(200)}", rng.randrange(10**6), i) for i in range(n)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v long, id long").repartition(7)


def test_numbering_equals_a_global_row_number(spark):
    rows = skewed()
    numbered = number_rows(frame(spark, rows), ["k", "v", "id"], 6)
    got = {r.id: r[RN] for r in numbered.collect()}
    assert got == {r[2]: i for i, r in enumerate(sorted(rows), 1)}
    # the hot key is spread over several partitions
    assert numbered.filter("k = 'hot'").select(PID).distinct().count() > 1


def test_numbering_is_stable_over_actions(spark):
    numbered = number_rows(frame(spark, skewed(500)), ["k", "v", "id"])
    assert sorted(numbered.collect()) == sorted(numbered.collect())


def test_layout_in_folders_has_the_same_numbers(spark):
    rows = skewed(600)
    numbered = number_rows(frame(spark, rows).withColumn("m", F.when(F.col("v") % 3 > 0, F.col("v") % 3)), ["k", "v", "id"], 6, cut_by=["m"])
    assert {r.id: r[RN] for r in numbered.collect()} == {r[2]: i for i, r in enumerate(sorted(rows), 1)}
    assert {r.m for r in numbered.select("m").distinct().collect()} == {None, 1, 2}
    # a table to read from: its folders are pruned, and numbers cost neither a join nor an exchange
    plan = numbered.filter("m = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan and "Join" not in plan and "Exchange" not in plan


def test_numbering_of_no_rows(spark):
    assert number_rows(frame(spark, skewed(10)).filter("id < 0"), ["k", "v", "id"]).collect() == []


def test_keys_continue_after_the_highest(spark):
    df = spark.createDataFrame([("b",), ("a",)], "bk string")
    for start in (10, spark.sql("SELECT 10 AS m")):
        assert sorted((r.bk, r.sk) for r in assign_surrogate_keys(df, ["bk"], "sk", start).collect()) == [("a", 11), ("b", 12)]
    empty = spark.sql("SELECT max(id) AS m FROM range(0)")
    assert min(r.sk for r in assign_surrogate_keys(df, ["bk"], "sk", empty).collect()) == 1


def test_previous_value_crosses_partitions(spark):
    rows = skewed()
    got = {r.id: r.prev for r in with_previous(number_rows(frame(spark, rows), ["k", "v", "id"], 6), "k", "v", "prev").collect()}
    want, last = {}, {}
    for k, v, i in sorted(rows):
        want[i], last[k] = last.get(k), v
    assert got == want


def test_running_total_crosses_partitions(spark):
    rows = skewed()
    out = with_running(number_rows(frame(spark, rows), ["k", "v", "id"], 6), "k", {"total": "v", "seq": F.lit(1)})
    got = {r.id: (r.total, r.seq) for r in out.collect()}
    want, sums = {}, {}
    for k, v, i in sorted(rows):
        s, n = sums.get(k, (0, 0))
        sums[k] = want[i] = (s + v, n + 1)
    assert got == want


def test_latest_per_key_and_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, t int, v string")
    assert sorted((r.k, r.v) for r in latest_per_key(df, ["k"], ["t"]).collect()) == [("a", "y"), ("b", None)]


def test_lookup_spreads_missing_keys(spark):
    facts = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.lit("a")).alias("k"), "id")
    dim = spark.createDataFrame([("a", 1), (None, 2)], "bk string, sk int")
    out = lookup(facts, dim, "k", "bk", {"sk": "sk"}, ["id"])
    assert out.count() == 1000
    assert out.filter("sk = 1").count() == 100 and out.filter("sk IS NULL").count() == 900
