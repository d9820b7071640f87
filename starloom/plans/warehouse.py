"""A warehouse over one set of feeds: every table is built once, then read.

Tables are written as parquet below the shared folder, so later queries start
from stored columns with statistics and month partitions instead of replaying
the load, and a lost executor re-reads files instead of recomputing the chain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import prepare, shared_dir
from starloom.sources.contracts import contract


class Warehouse:
    """Lazily built, stored tables. Subclasses name the builder of each table."""

    builders: dict[str, Callable[["Warehouse"], DataFrame]] = {}
    partitions: dict[str, Sequence[str]] = {}
    #: Tables whose builder lays them out itself and returns the stored rows.
    laid_out: frozenset[str] = frozenset()

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        feed = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
        # one folder per application: tables of an earlier run are never mistaken for this one's
        self.root = root or f"{shared_dir(spark)}/warehouse/{spark.sparkContext.applicationId}/{feed}"
        self._ready: dict[str, DataFrame] = {}
        self._feeds: dict[str, DataFrame] = {}

    def feed(self, name: str) -> DataFrame:
        """A raw feed, analysed once; it is a plan, not data."""
        if name not in self._feeds:
            self._feeds[name] = contract(self.spark, self.sf_dir, name)
        return self._feeds[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._ready:
            self._ready[name] = self._store(name, self.builders[name](self))
        return self._ready[name]

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        if name in self.laid_out:
            return df
        path = f"{self.root}/{name}"
        by = list(self.partitions.get(name, ()))
        if by:
            df = df.hint("rebalance", *by)  # splits large months, merges small ones
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(*by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def build(self, names: Sequence[str] | None = None) -> None:
        for name in names or self.builders:
            self[name]


_open: dict[tuple[type, str, str], Warehouse] = {}


def open_warehouse(kind: type[Warehouse], spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        _open[key] = kind(spark, sf_dir)
    return _open[key]


def month_of(date_sk: str) -> Column:
    return (F.col(date_sk) / 100).cast("int")
