"""A Type-2 dimension kept in buckets: a batch rewrites the buckets it touches and no other file.

``slice = 'current'`` holds the open version of every key, cut into buckets by
key; ``slice = 'closed <date>'`` holds the versions that the load of that date
closed. History is therefore written once and never read by a load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.scd import ORDER_HISTORY, History, _open_versions, _usable, in_layout
from starloom.operators.ordered import assign_surrogate_keys
from starloom.session import prepare, written
from starloom.sources.tables import overwrite_partitions, table_exists

SLICE, BUCKET, CURRENT = "slice", "bucket", "current"


class VersionStore:
    """``table`` with the versions of a dimension; ``table_loads`` with one row per load."""

    def __init__(self, spark: SparkSession, table: str, bk: Sequence[str], sk_col: str, names: History = ORDER_HISTORY, buckets: int = 64) -> None:
        self.spark, self.table, self.loads = prepare(spark), table, f"{table}_loads"
        self.bk, self.sk_col, self.names, self.buckets = list(bk), sk_col, names, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.bk), F.lit(self.buckets)).cast("int")

    def history(self) -> DataFrame:
        """All versions."""
        return self.spark.table(self.table).drop(SLICE, BUCKET)

    def current(self) -> DataFrame:
        """Open versions; no closed one is read."""
        return self.spark.table(self.table).filter(F.col(SLICE) == CURRENT).drop(SLICE, BUCKET)

    def _touched(self, rows: DataFrame) -> list[int]:
        """Buckets that occur in ``rows``: as many as there are buckets at most."""
        return [r[0] for r in rows.select(BUCKET).distinct().collect()]

    def _in(self, buckets: Sequence[int]) -> DataFrame:
        return self.spark.table(self.table).filter((F.col(SLICE) == CURRENT) & F.col(BUCKET).isin(*buckets))

    def _highest(self, mine: DataFrame | None) -> DataFrame:
        """Highest key in use: of finished loads, and of the touched buckets, where a load that was cut off may have left some."""
        keys = self.spark.table(self.loads).select(F.col("highest_sk").alias("k"))
        return (keys if mine is None else keys.union(mine.select(F.col(self.sk_col).alias("k")))).agg(F.max("k").alias("k"))

    def load(self, source: DataFrame, tracked: Sequence[str], as_of: str, type1: Sequence[str] = (), unique: bool = False) -> list[int]:
        """Apply a batch and return the buckets it rewrote.

        A changed key closes its version the day before ``as_of`` and opens
        another, a new key opens its first one, ``type1`` columns change in
        place; whatever else lies in a touched bucket is copied. Only the open
        versions in the buckets of incoming keys are read, and only buckets with
        a change are written. Closed versions are written before open ones: a
        load that is cut off finds the same changes again in the buckets it has
        not reached, and leaves the others alone.
        """
        n = self.names
        incoming = _open_versions(_usable(source, self.bk, unique), tracked, as_of, n).withColumn(BUCKET, self._bucket())
        if not table_exists(self.spark, self.table):
            first = assign_surrogate_keys(incoming, self.bk, self.sk_col).withColumn(SLICE, F.lit(CURRENT))
            overwrite_partitions(first, self.table, [SLICE, BUCKET])
            self._log(as_of, self.spark.table(self.table))
            return list(range(self.buckets))
        incoming = written(incoming, "incoming")
        here = self._in(self._touched(incoming))
        new = lambda c: f"_new_{c}"
        probe = incoming.select(BUCKET, *self.bk, F.lit(True).alias("_met"), F.col(n.digest).alias(new(n.digest)), *(F.col(c).alias(new(c)) for c in type1))
        met = here.join(probe, [BUCKET, *self.bk], "full_outer")
        same = F.col(n.digest).eqNullSafe(F.col(new(n.digest)))
        moved = F.lit(False)
        for c in type1:
            moved = moved | ~F.col(c).eqNullSafe(F.col(new(c)))
        kind = (F.when(F.col("_met").isNull(), "kept").when(F.col(SLICE).isNull(), "new").when(~same, "changed")
                .when(moved, "moved").otherwise("kept"))
        told = written(met.withColumn("_kind", kind), "changes", ["_kind"])
        touched = self._touched(told.filter(F.col("_kind") != "kept"))
        if not touched:
            return []
        layout = self.spark.table(self.table).schema
        mine = told.filter(F.col(BUCKET).isin(*touched))
        changed = mine.filter("_kind = 'changed'")
        closed = changed.withColumns({
            n.exp: F.date_sub(F.lit(as_of).cast("date"), 1), n.flag: F.lit("N"), SLICE: F.lit(f"closed {as_of}")})
        overwrite_partitions(in_layout(closed, layout), self.table)
        opened = incoming.join(mine.filter("_kind IN ('changed', 'new')").select(BUCKET, *self.bk), [BUCKET, *self.bk], "left_semi")
        opened = assign_surrogate_keys(opened, self.bk, self.sk_col, self._highest(self._in(touched))).withColumn(SLICE, F.lit(CURRENT))
        stay = mine.filter("_kind IN ('kept', 'moved')").withColumns(
            {c: F.when(F.col("_kind") == "moved", F.col(new(c))).otherwise(F.col(c)) for c in type1})
        overwrite_partitions(in_layout(stay, layout).unionByName(in_layout(opened, layout)), self.table)
        self._log(as_of, self._in(touched))
        return touched

    def _log(self, as_of: str, rows: DataFrame) -> None:
        row = rows.agg(F.coalesce(F.max(self.sk_col), F.lit(0)).cast("long").alias("highest_sk"), F.count_distinct(BUCKET).cast("int").alias("buckets"))
        overwrite_partitions(row.withColumn("load_date", F.lit(as_of)), self.loads, ["load_date"])
