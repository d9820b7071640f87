"""Order facts cut alike by order, so that they meet without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.plans.order_warehouse import OrderWarehouse
from starloom.sources.tables import table_exists

#: Facts with an order key.
FACTS = ("fact_order", "fact_item", "fact_transition")


class BucketedStar:
    """A star whose order facts are catalog tables in the same number of buckets by ``order_sk``.

    A join, semi join or distinct on the order then needs no exchange of either
    fact. Rows of a bucket are sorted by month, so a month filter still skips
    row groups. All else comes from the warehouse.
    """

    def __init__(self, warehouse: OrderWarehouse, database: str, buckets: int | None = None) -> None:
        self.warehouse, self.database, self.spark = warehouse, database, warehouse.spark
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in FACTS:
            return self.warehouse[name]
        table = f"{self.database}.{name}"
        if not table_exists(self.spark, table):
            # one file per bucket: rows go to their bucket before they are written
            rows = self.warehouse[name].repartition(self.buckets, "order_sk")
            rows.write.bucketBy(self.buckets, "order_sk").sortBy("month_sk").saveAsTable(table)
        return self.spark.table(table)
