"""Increments: a consumer reads the raw partitions it has not read yet, and those that were delivered again."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.dq import FACT_GATES, Rule, evaluate_rules, gate_by, passed_only
from starloom.session import written
from starloom.sources.landing import with_audit
from starloom.sources.tables import overwrite_partitions, table_exists

DAY = "_business_date"


def back_fill(rows: DataFrame, table: str, run_id: str) -> None:
    """Raw rows of many business dates at once, each with its own ``_business_date``; their partitions are replaced."""
    day = F.col(DAY)
    stamped = with_audit(rows.withColumnRenamed(DAY, "_day"), "1970-01-01", run_id, f"back fill {run_id}").withColumn(DAY, F.col("_day")).drop("_day")
    overwrite_partitions(stamped.filter(day.isNotNull()), table, [DAY])


def versions(spark: SparkSession, table: str) -> dict[str, str]:
    """Digest of the file names of every business date: one entry per partition, no data."""
    if not table_exists(spark, table):
        return {}
    files: dict[str, list[str]] = {}
    for name in spark.table(table).inputFiles():
        day = re.search(rf"/{DAY}=([0-9-]+)/", name)
        if day:
            files.setdefault(day[1], []).append(name)
    return {day: hashlib.sha256("\n".join(sorted(own)).encode()).hexdigest()[:32] for day, own in files.items()}


class HighWater:
    """What each consumer has read of which raw partition: one partition of its own per consumer, table and business date."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table

    def pending(self, consumer: str, raw: Sequence[str]) -> list[str]:
        """Business dates of which any raw table holds something that the consumer has not read, in order."""
        seen = {}
        if table_exists(self.spark, self.table):
            mine = self.spark.table(self.table).filter(F.col("consumer") == consumer).select("raw_table", "business_day", "version")
            seen = {(r["raw_table"], r["business_day"]): r["version"] for r in mine.collect()}  # a row per partition
        self._found = {(t, day): v for t in raw for day, v in versions(self.spark, t).items()}
        return sorted({day for (t, day), v in self._found.items() if seen.get((t, day)) != v})

    def advance(self, consumer: str, days: Sequence[str]) -> None:
        """Note what ``pending`` has found for these days."""
        rows = [(t, day, v) for (t, day), v in self._found.items() if day in set(days)]
        marks = self.spark.createDataFrame(rows, "raw_table string, business_day string, version string").withColumn("consumer", F.lit(consumer))
        overwrite_partitions(marks, self.table, ["consumer", "business_day"])


@dataclass(frozen=True)
class SilverFact:
    """How one fact follows from raw tables: ``build`` gets the valid rows of the first table and the plain rows of the others."""

    name: str
    raw: tuple[str, ...]
    rules: Callable[[], list[Rule]]
    build: Callable[..., DataFrame]


@dataclass(frozen=True)
class Increment:
    """What one run has read and loaded."""

    days: list[str]
    read: Mapping[str, DataFrame]
    verdicts: DataFrame | None


def load_increment(spark: SparkSession, database: str, fact: SilverFact, marks: str, gates=FACT_GATES) -> Increment:
    """Bring a fact up to its raw tables: only partitions above the consumer's mark are read.

    All pending days are one set-based run: rules are evaluated once, each day
    gets its own verdict, and a day below the gate is not loaded (what an earlier
    delivery loaded of it stays); its verdict goes to ``fact_verdicts``. The
    mark moves last, so a run that is cut off reads the same days again and
    replaces the same partitions.
    """
    water = HighWater(spark, f"{database}.{marks}")
    raw = [f"{database}.{t}" for t in fact.raw]
    days = water.pending(fact.name, raw)
    if not days:
        return Increment([], {}, None)
    read = {t: spark.table(name).filter(F.col(DAY).isin(*(F.lit(d).cast("date") for d in days))) for t, name in zip(fact.raw, raw) if table_exists(spark, name)}
    main, *rest = (read[t] for t in fact.raw)
    tagged = evaluate_rules(main, fact.rules())
    tagged.tagged = written(tagged.tagged, "tagged")
    verdicts = written(gate_by(tagged, gates.of(fact.name), DAY), "verdicts")
    overwrite_partitions(verdicts.withColumn("target_table", F.lit(fact.name)), f"{database}.{fact.name}_verdicts", ["target_table", DAY])
    rows = fact.build(passed_only(tagged, verdicts, DAY), *rest)
    overwrite_partitions(rows, f"{database}.{fact.name}", ["date_key"])
    water.advance(fact.name, days)
    return Increment(days, read, verdicts)
