import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators.scd import merge_scd1, merge_scd2, scd2_apply
from starloom.sources import tables as t
from starloom.sources.landing import AUDIT_COLUMNS, explode_order_items, ingest_source, payload_rejects, landing_path, read_landing, unknown_members, with_audit
from starloom.sources.schemas import FEEDS


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "d int, v int")


def test_partition_overwrite_leaves_other_partitions(spark, database):
    name = f"{database}.f"
    t.write_append(days(spark, (1, 1), (2, 2)), name, ["d"])
    t.overwrite_partitions(days(spark, (2, 20)).select("v", "d"), name)
    assert sorted((r.d, r.v) for r in spark.table(name).collect()) == [(1, 1), (2, 20)]


def test_empty_result_clears_the_named_partition(spark, database):
    name = f"{database}.f"
    t.write_append(days(spark, (1, 1), (2, 2)), name, ["d"])
    t.overwrite_partitions(days(spark, (2, 2)).limit(0), name, clear=[{"d": 2}])
    assert [r.d for r in spark.table(name).collect()] == [1]


def test_append_aligns_columns_by_name(spark, database):
    name = f"{database}.f"
    t.write_append(spark.sql("SELECT 1 AS a, 'x' AS b"), name)
    t.write_append(spark.sql("SELECT 'y' AS b, 2 AS a"), name)
    assert sorted((r.a, r.b) for r in spark.table(name).collect()) == [(1, "x"), (2, "y")]


def test_batch_reload_replaces_only_its_batch(spark, database):
    name = f"{database}.f"
    rows = lambda *r: spark.createDataFrame(list(r), "v int, etl_batch_id string")
    t.replace_batch(rows((1, "A")), name, "A")
    t.replace_batch(rows((2, "B")), name, "B")
    t.replace_batch(rows((3, "A"), (4, "A")), name, "A")
    assert sorted(r.v for r in spark.table(name).collect()) == [2, 3, 4]
    t.replace_batch(rows((3, "A")).limit(0), name, "A")
    assert [r.v for r in spark.table(name).collect()] == [2]
    with pytest.raises(Exception, match="outside batch"):
        t.replace_batch(rows((5, "C")), name, "A")


def test_batch_load_writes_its_rows_where_they_are(spark, database):
    """No row is sent to another task, so every task writes a file."""
    rows = spark.range(0, 4000, 1, 4).withColumn("etl_batch_id", F.lit("A"))
    for _ in range(2):
        t.replace_batch(rows, f"{database}.f", "A")
        assert len(spark.table(f"{database}.f").inputFiles()) == 4
    t.advance_partition(spark, f"{database}.f", {"etl_batch_id": "A"}, {"etl_batch_id": "P"})
    assert spark.table(f"{database}.f").filter("etl_batch_id = 'P'").count() == 4000 == spark.table(f"{database}.f").count()


def test_batch_load_does_not_sort_its_rows(spark, database, monkeypatch):
    """A few partition values are few open files, and the session is left as it was."""
    key, seen, aligned = "spark.sql.maxConcurrentOutputFileWriters", [], t._aligned
    monkeypatch.setattr(t, "_aligned", lambda df, table: seen.append(int(spark.conf.get(key))) or aligned(df, table))
    rows = spark.range(100).selectExpr("id", "if(id % 3 = 0, 'E', 'V') status", "'A' batch")
    for few in (True, True, False):
        t.overwrite_partitions(rows, f"{database}.f", ["batch", "status"], few=few)
        assert {r.status: r["count"] for r in spark.table(f"{database}.f").groupBy("status").count().collect()} == {"E": 34, "V": 66}
    assert seen[0] > 1 and seen[1] > 1 and seen[2] == 0 == int(spark.conf.get(key))


def test_advanced_partition_keeps_its_files(spark, database):
    import os
    from urllib.parse import urlparse

    name, old, new = f"{database}.f", {"batch": "A", "status": "V"}, {"batch": "A", "status": "P"}
    files = lambda: {os.path.basename(f) for f in spark.table(name).inputFiles()}
    t.overwrite_partitions(spark.range(0, 100, 1, 4).selectExpr("id", "'A' batch", "'V' status"), name, ["batch", "status"], few=True)
    before = files()
    t.advance_partition(spark, name, old, new)
    assert files() == before and spark.table(name).filter("status = 'P'").count() == 100
    # cut off between the files and the catalog: they lie under the next name, which the catalog does not know
    place = urlparse(spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]).path
    os.rename(f"{place}/batch=A/status=P", f"{place}/batch=A/status=Q")
    spark.catalog.refreshTable(name)
    for _ in range(2):
        t.advance_partition(spark, name, new, {"batch": "A", "status": "Q"})
        assert spark.table(name).filter("status = 'Q'").count() == 100 == spark.table(name).count()


def test_published_version_may_read_the_current_one(spark, database):
    name = f"{database}.dim"
    src = lambda *r: spark.createDataFrame(list(r), "k string, s string")
    t.publish_version(scd2_apply(None, src(("a", "1")), ["k"], ["s"], "2026-01-01", "sk"), name)
    t.publish_version(scd2_apply(spark.table(name), src(("a", "2"), ("b", "1")), ["k"], ["s"], "2026-01-02", "sk"), name)
    assert sorted((r.k, r.s, r.current_row_flag) for r in spark.table(name).collect()) == [("a", "1", "N"), ("a", "2", "Y"), ("b", "1", "Y")]


def test_stored_dimensions_take_batches(spark, database):
    src = lambda *r: spark.createDataFrame(list(r), "k string, s string")
    for day, rows in (("2026-01-01", [("a", "1")]), ("2026-01-02", [("a", "2"), ("b", "1")]), ("2026-01-02", [("a", "2"), ("b", "1")])):
        merge_scd2(src(*rows), f"{database}.two", ["k"], ["s"], day, "sk")
        merge_scd1(src(*rows), f"{database}.one", ["k"], ["s"], "sk")
    assert sorted((r.sk, r.k, r.s, r.current_row_flag) for r in spark.table(f"{database}.two").collect()) == [
        (1, "a", "1", "N"), (2, "a", "2", "Y"), (3, "b", "1", "Y")]
    assert sorted((r.sk, r.k, r.s) for r in spark.table(f"{database}.one").collect()) == [(1, "a", "2"), (2, "b", "1")]


def test_retention(spark, database):
    df = spark.createDataFrame([(dt.date(2026, 1, 1),), (dt.date(2026, 6, 1),), (None,)], "d date")
    assert t.purge_older_than(df, "d", "2026-06-02").count() == 2
    name = f"{database}.stg"
    t.write_append(df.filter("d IS NOT NULL").withColumn("v", F.lit(1)), name, ["d"])
    t.purge_partitions(spark, [name], "d", "2026-06-02")
    assert [r.d for r in spark.table(name).collect()] == [dt.date(2026, 6, 1)]


def test_mark_processed(spark):
    df = spark.createDataFrame([("B1", "V"), ("B1", "E"), ("B2", "V")], "stg_batch_id string, stg_record_status string")
    assert sorted(r.stg_record_status for r in t.mark_processed(df, "B1").collect()) == ["E", "P", "V"]


def test_overwrite_refreshes(spark, database):
    name = f"{database}.r"
    for n in (3, 2):
        t.write_overwrite(spark.range(n).toDF("v"), name)
    assert spark.table(name).count() == 2


@pytest.mark.parametrize("source,table,row", [
    ("pipeline_scada", "raw_leak_detection_alarm", {"pipeline_segment_id": "S1", "severity": "CRITICAL"}),
    ("maximo_eam", "raw_downtime_event", {"asset_id": "A1", "downtime_reason_code": "R1"}),
    ("sap_erp", "raw_cost_center_actuals", {"cost_center_code": "UP-1", "fiscal_year": 2026}),
])
def test_ingest_is_audited_and_repeatable(spark, tmp_path, source, table, row):
    feed = FEEDS[source]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {feed.schema}")
    day = "2026-03-01"
    df = spark.range(3).select(*[
        F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], feed.tables[table]).schema
    ])
    writer = df.write.format(feed.format)
    if feed.format == "csv":
        writer = writer.option("header", True)
    writer.save(landing_path(str(tmp_path), source, table, day))
    for _ in range(2):
        assert ingest_source(spark, source, day, "run", str(tmp_path), [table]) == {table: 3}
    stored = spark.table(f"{feed.schema}.{table}")
    assert stored.count() == 3 and set(AUDIT_COLUMNS) <= set(stored.columns)
    got = stored.first()
    assert str(got._business_date) == day and got._ingestion_run_id == "run" and table in got._source_file
    assert all(got[c] == v for c, v in row.items())
    named = with_audit(read_landing(spark, source, table, day, str(tmp_path)), day, "r", "feed.csv")
    assert named.first()._source_file == "feed.csv"
    spark.sql(f"DROP DATABASE {feed.schema} CASCADE")


def test_payload_explodes_to_items(spark):
    doc = ('{"id":"O1","productOrderItem":[{"id":"1","quantity":"2","state":"held","action":"add","productOffering":{"id":"P1"},'
           '"itemPrice":[{"priceType":"recurring","price":{"taxIncludedAmount":{"value":"11.5"}}}]},{"id":"2"}]}')
    raw = spark.createDataFrame([("O1", doc), ("O2", "not json")], "order_id string, raw_json_payload string")
    rows = sorted(explode_order_items(raw).collect())
    assert [(r.order_item_id, r.product_offering_id, r.price_amount) for r in rows] == [("1", "P1", "11.5"), ("2", None, None)]


def test_items_with_several_prices_and_unreadable_documents(spark):
    price = lambda kind, v: f'{{"priceType":"{kind}","price":{{"taxIncludedAmount":{{"value":"{v}"}}}}}}'
    doc = f'{{"id":"O1","productOrderItem":[{{"id":"1","itemPrice":[{price("recurring", 5)},{price("once", 7)}]}},{{"id":"2","itemPrice":[]}}]}}'
    raw = spark.createDataFrame([("O1", doc), ("O2", "not json"), ("O3", '{"id":"O3","productOrderItem":[]}'), ("O4", None)], "order_id string, raw_json_payload string")
    rows = sorted((r.order_item_id, r.price_type, r.price_amount) for r in explode_order_items(raw).collect() if r.price_type) + [
        (r.order_item_id, None, None) for r in explode_order_items(raw).collect() if not r.price_type]
    assert rows == [("1", "once", "7"), ("1", "recurring", "5"), ("2", None, None)]
    assert {(r.order_id, r.reason) for r in payload_rejects(raw).collect()} == {("O2", "not readable"), ("O3", "no items"), ("O4", "no document")}


def test_failed_reload_keeps_the_old_rows(spark, database):
    name = f"{database}.f"
    rows = lambda *r: spark.createDataFrame(list(r), "v int, etl_batch_id string")
    t.replace_batch(rows((1, "A"), (2, "A")), name, "A")
    with pytest.raises(Exception, match="outside batch"):
        t.replace_batch(rows((5, "C")), name, "A")
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 2]
    t.replace_batch(spark.table(name).withColumn("v", F.col("v") + 10), name, "A")
    assert sorted(r.v for r in spark.table(name).collect()) == [11, 12]


def test_dates_are_whole_texts(spark):
    from starloom.functions.columns import parse_date
    rows = spark.createDataFrame([("2026-01-15",), ("2026-01-15 10:30:00",), ("2026-01-15junk",), ("junk",), (None,)], "d string")
    assert [str(r[0]) for r in rows.select(parse_date("d")).collect()] == ["2026-01-15", "2026-01-15", "None", "None", "None"]


def test_old_versions_go(spark, database):
    name = f"{database}.v"
    for n in range(4):
        t.publish_version(spark.range(n + 1).toDF("v"), name)
    base = spark.catalog.getDatabase(database).locationUri.removeprefix("file:")
    import os
    assert sorted(os.listdir(f"{base}/v_versions")) == ["v3", "v4"] and spark.table(name).count() == 4


def test_unknown_members_of_any_shape(spark):
    rows = [("a", '{"id":"1","x":1.5,"y":[1,{"z":null}],"productOrderItem":[{"id":"1"},{"id":"2","w":{"a":"b"}},7]}'), ("b", '{"id":"2"}'), ("c", "not json"), ("d", None), ("e", "[1]"), ("f", "{}"),
            ("g", '{"productOrderItem":{"id":"no list"},"é":"ü"}')]
    got = {tuple(r) for r in unknown_members(spark.createDataFrame(rows, "order_id string, raw_json_payload string")).collect()}
    assert got == {("a", "order", -1, "x", "1.5"), ("a", "order", -1, "y", '[1,{"z":null}]'), ("a", "item", 1, "w", '{"a":"b"}'), ("g", "order", -1, "é", '"ü"')}
