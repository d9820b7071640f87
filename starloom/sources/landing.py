"""Landing-zone readers and the audited ingest into raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import written
from starloom.sources.schemas import FEEDS, ORDER_PAYLOAD
from starloom.sources.tables import overwrite_partitions

AUDIT_COLUMNS = ["_ingest_ts", "_source_file", "_business_date", "_ingestion_run_id"]


def landing_path(root: str, source: str, table: str, business_date: str) -> str:
    return f"{root}/{source}/{table}/business_date={business_date}"


CORRUPT = "_corrupt_record"


def read_landing(spark: SparkSession, source: str, table: str, business_date: str, root: str, corrupt: bool = False) -> DataFrame:
    """One table of one day, with the declared schema (no inference pass over the files).

    With ``corrupt``, text that does not fit the schema (a value of another
    type, a line too short or too long, broken JSON) is kept whole in
    ``_corrupt_record``; Parquet has no such rows.
    """
    feed = FEEDS[source]
    wanted = spark.createDataFrame([], feed.tables[table]).schema
    keep = corrupt and feed.format in ("csv", "json")
    reader = spark.read.schema(wanted.add(CORRUPT, "string") if keep else wanted)
    if keep:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    if feed.format == "csv":
        reader = reader.option("header", True)
    return reader.format(feed.format).load(landing_path(root, source, table, business_date))


def with_audit(df: DataFrame, business_date: str, run_id: str, source_file: str | None = None) -> DataFrame:
    """Stamp load time, origin, business date and run. Default origin: the actual file read."""
    origin = F.lit(source_file) if source_file else F.col("_metadata.file_path")
    return df.select(
        "*",
        F.current_timestamp().alias("_ingest_ts"),
        origin.alias("_source_file"),
        F.lit(run_id).alias("_ingestion_run_id"),
        F.lit(business_date).cast("date").alias("_business_date"),
    )


def ingest_source(
    spark: SparkSession, source: str, business_date: str, run_id: str, root: str,
    tables: Sequence[str] | None = None, database: str | None = None,
) -> dict[str, int]:
    """Load every table of a source for one day; returns rows per table.

    The day's partition is replaced, so a repeated run cannot duplicate it. Rows
    are counted from the footers of the files just written. Records that do not
    fit the declared schema are not loaded: they go whole to the table
    ``ingest_rejects`` of the same database, one partition per day and table.
    """
    feed = FEEDS[source]
    counted = {}
    for table in tables or feed.tables:
        raw = with_audit(read_landing(spark, source, table, business_date, root, corrupt=True), business_date, run_id)
        database_name = database or feed.schema
        name = f"{database_name}.{table}"
        if CORRUPT in raw.columns:  # parse once, cut by outcome
            raw = written(raw.withColumn("_bad", F.col(CORRUPT).isNotNull()), "landed", ["_bad"])
            bad = raw.filter("_bad").select(
                F.col(CORRUPT).alias("raw_record"), "_source_file", "_ingestion_run_id", "_ingest_ts", "_business_date", F.lit(table).alias("source_table"))
            overwrite_partitions(bad, f"{database_name}.ingest_rejects", ["_business_date", "source_table"],
                                 clear=[{"_business_date": business_date, "source_table": table}])
            raw = raw.filter("NOT _bad").drop(CORRUPT, "_bad")
        overwrite_partitions(raw, name, ["_business_date"], clear=[{"_business_date": business_date}])
        day = F.col("_business_date") == F.lit(business_date).cast("date")
        counted[table] = spark.table(name).filter(day).count()
    return counted


def _documents(raw: DataFrame, payload: str) -> DataFrame:
    return raw.select(
        "order_id", F.col(payload).alias("_payload"), F.from_json(F.col(payload), ORDER_PAYLOAD).alias("doc"),
        *[c for c in ("stg_batch_id", "stg_load_dt") if c in raw.columns])


def payload_rejects(raw: DataFrame, payload: str = "raw_json_payload") -> DataFrame:
    """Documents from which no item can be taken, with the reason and the whole payload."""
    docs = _documents(raw, payload)
    none = F.coalesce(F.size("doc.productOrderItem"), F.lit(-1)) <= 0
    empty = F.col("_payload").isNull() | (F.trim("_payload") == "")
    broken = F.col("doc.id").isNull() & F.col("doc.productOrderItem").isNull()
    reason = F.when(empty, "no document").when(broken, "not readable").otherwise("no items")
    return docs.filter(none).select(*[c for c in docs.columns if c not in ("doc", "_payload")], reason.alias("reason"), F.col("_payload").alias("raw_record"))


#: Members of an order document and of its items that the warehouse reads.
KNOWN_MEMBERS = {"order": ("id", "productOrderItem"), "item": ("id", "quantity", "state", "action", "productOffering", "product", "itemPrice")}


def unknown_members(raw: DataFrame, payload: str = "raw_json_payload") -> DataFrame:
    """What order documents hold beyond the declared schema: one row per member, with its value as JSON text.

    ``level`` says whether the document or one of its items has it, ``position``
    which item (-1 for the document). Documents are read as VARIANT, so nothing
    has to be declared; one that is no JSON gives no row here (see
    :func:`payload_rejects`).
    """
    tvf = raw.sparkSession.tvf
    docs = raw.select("order_id", F.try_parse_json(payload).alias("doc")).filter("doc IS NOT NULL AND schema_of_variant(doc) LIKE 'OBJECT%'")
    members = docs.lateralJoin(tvf.variant_explode(F.col("doc").outer())).select("order_id", F.lit("order").alias("level"), F.lit(-1).alias("position"), "key", "value")
    items = docs.select("order_id", F.try_variant_get("doc", "$.productOrderItem", "variant").alias("list"))
    items = items.lateralJoin(tvf.variant_explode(F.col("list").outer())).select("order_id", F.col("pos").alias("position"), F.col("value").alias("item"))
    inner = items.lateralJoin(tvf.variant_explode(F.col("item").outer())).select("order_id", F.lit("item").alias("level"), "position", "key", "value")
    known = F.when(F.col("level") == "order", F.col("key").isin(*KNOWN_MEMBERS["order"])).otherwise(F.col("key").isin(*KNOWN_MEMBERS["item"]))
    return members.unionByName(inner).filter(~known).select("order_id", "level", "position", F.col("key").alias("member"), F.to_json("value").alias("value"))


def explode_order_items(raw: DataFrame, payload: str = "raw_json_payload") -> DataFrame:
    """One row per item and price of the order document kept in the raw payload column.

    An item without a price gives one row. Documents without items give none
    here: see :func:`payload_rejects`.
    """
    items = _documents(raw, payload).select("*", F.explode("doc.productOrderItem").alias("item"))
    priced = items.select("*", F.explode_outer("item.itemPrice").alias("price"))
    return priced.select(
        F.col("order_id"),
        F.col("item.id").alias("order_item_id"),
        F.col("item.quantity").alias("item_quantity"),
        F.col("item.state").alias("item_state"),
        F.col("item.action").alias("action"),
        F.col("item.productOffering.id").alias("product_offering_id"),
        F.col("item.product.productSpecification.id").alias("product_spec_id"),
        F.col("price.priceType").alias("price_type"),
        F.col("price.price.taxIncludedAmount.value").alias("price_amount"),
        *[c for c in ("stg_batch_id", "stg_load_dt") if c in raw.columns],
    )
