"""Per-key selection and key resolution that survive hot and missing keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import written

#: What absent keys may take in the driver's memory if they are broadcast, and what a row takes there beside its key.
FLAG_BYTES, FLAG_ROW = 128 << 20, 96


def salts() -> int:
    """Over how many values missing keys spread: several for every shuffle partition."""
    return 8 * int(SparkSession.active().conf.get("spark.sql.shuffle.partitions"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key (last one wins).

    An aggregate instead of ``row_number``: every map task first reduces each key
    to one row, so repeated copies of one key never meet in a single task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order_by)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def spread_missing(key: Column, row_id: Sequence[Column | str]) -> Column:
    """Join key in which missing values are spread out instead of meeting in one task.

    The replacement starts with a NUL byte and therefore equals no real key.
    """
    salt = F.pmod(F.xxhash64(*row_id), F.lit(salts())).cast("string")
    return F.coalesce(key.cast("string"), F.concat(F.lit("\u0000"), salt))


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Column | str,
    dim_key: str,
    take: dict[str, str],
    row_id: Sequence[str],
) -> DataFrame:
    """Left-join attributes of ``dim`` (unique on ``dim_key``) onto ``facts``.

    ``take`` maps a column of the dimension to the name it gets in the result.
    Whether the dimension is broadcast is left to the size check of the planner;
    skewed keys of the fact side are split at run time.
    """
    key = F.col(on) if isinstance(on, str) else on
    right = dim.filter(F.col(dim_key).isNotNull()).select(
        F.col(dim_key).cast("string").alias("_k"), *[F.col(c).alias(n) for c, n in take.items()]
    )
    return facts.withColumn("_k", spread_missing(key, row_id)).join(right, "_k", "left").drop("_k")


def with_flag(facts: DataFrame, other: DataFrame, on: str, other_key: str, name: str,
              row_id: Sequence[str], asked: DataFrame | None = None) -> DataFrame:
    """Mark rows whose key occurs in ``other``.

    Keys that do not occur are found first, from distinct keys alone, and stored.
    They are few as a rule, so that whole rows need not travel to their key:
    up to ``FLAG_BYTES``, counted, they are broadcast. Should they be more, the
    planner decides. ``asked`` may name plainer rows with the same keys, where
    ``facts`` is costly to evaluate.
    """
    key = F.col(on).cast("string")
    known = other.select(F.col(other_key).cast("string").alias("_flag_key")).filter("_flag_key IS NOT NULL").distinct()
    asked = (facts if asked is None else asked).select(key.alias("_flag_key")).filter("_flag_key IS NOT NULL").distinct()
    stored = written(asked.join(known, "_flag_key", "left_anti"), "absent_keys")
    takes = stored.agg(F.count(F.lit(1)) * FLAG_ROW + F.coalesce(F.sum(F.octet_length("_flag_key")), F.lit(0))).first()[0]  # one number
    # stored rows are not known to be distinct: said again, a join whose flag nobody reads is dropped
    absent = stored.distinct().withColumn("_absent", F.lit(True))
    absent = F.broadcast(absent) if takes <= FLAG_BYTES else absent
    out = lookup(facts, absent, on, "_flag_key", {"_absent": "_absent"}, row_id)
    return out.withColumn(name, key.isNotNull() & F.col("_absent").isNull()).drop("_absent")
