"""Marts kept month by month: sums of days are stored, and a month is folded from them.

A late day replaces its own partition of sums; the months it belongs to are
folded again and replaced. No fact row of any other day is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.ops_marts import MONTH, Partials
from starloom.session import prepare
from starloom.sources.tables import overwrite_partitions

_DAY = ["month_key", "date_key"]


def month_name(month: int) -> str:
    return f"{month // 100:04d}-{month % 100:02d}"


class MonthState:
    """Stored sums of days of one set of measures, in a table cut by month and day."""

    def __init__(self, spark: SparkSession, table: str, partials: Partials) -> None:
        self.spark, self.table, self.partials = prepare(spark), table, partials

    def put(self, fact: DataFrame, days: Sequence[int] = ()) -> None:
        """Replace the sums of the days in ``fact``; of ``days``, those without a row are emptied."""
        rows = fact.filter(F.col("date_key").isin(*days)) if days else fact
        clear = [{"month_key": d // 100, "date_key": d} for d in days]
        overwrite_partitions(self.partials.of_days(rows), self.table, _DAY, clear=clear)

    def months(self, months: Sequence[int], last_day: int | None = None) -> DataFrame:
        """Sums of months, up to ``last_day``; only their partitions are read."""
        days = self.spark.table(self.table).filter(F.col("month_key").isin(*months))
        return self.partials.folded(days if last_day is None else days.filter(F.col("date_key") <= last_day))


def refresh_months(rows: Callable[[Sequence[int]], DataFrame], table: str, months: Sequence[int]) -> None:
    """Replace some months of a mart; a month that has no row any more is emptied."""
    overwrite_partitions(rows(months), table, [MONTH], clear=[{MONTH: month_name(m)} for m in months])
