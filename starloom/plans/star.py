"""Joins every mart and report over the order star shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.keyed import salts

UNKNOWN = -1
Star = Mapping[str, DataFrame]


def on_days(fact: DataFrame, date_sk: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Limit a fact to a span of yyyymmdd keys; the month partition prunes folders."""
    month = F.col("month_sk")
    if first is not None:
        fact = fact.filter((F.col(date_sk) >= first) & (month >= first // 100))
    if last is not None:
        fact = fact.filter((F.col(date_sk) <= last) & (month <= last // 100))
    return fact


def in_year(fact: DataFrame, date_sk: str, year: int, month: int | None = None) -> DataFrame:
    lo, hi = (month, month) if month else (1, 12)
    return on_days(fact, date_sk, year * 10000 + lo * 100 + 1, year * 10000 + hi * 100 + 31)


def with_date(star: Star, fact: DataFrame, date_sk: str, *cols: str) -> DataFrame:
    """Calendar attributes; whether the calendar is broadcast follows from its measured size.

    The calendar spans all days of the facts. Rows without a date have no day:
    see :func:`without_day`.
    """
    cal = star["dim_date"].select(F.col("date_sk").alias("_d"), *cols)
    return fact.join(cal, F.col(date_sk) == F.col("_d")).drop("_d")


def without_day(star: Star, fact: DataFrame, date_sk: str) -> DataFrame:
    """Fact rows that no calendar day takes, for the error log."""
    return fact.join(star["dim_date"].select(F.col("date_sk").alias(date_sk)), date_sk, "left_anti")


def with_state(star: Star, fact: DataFrame, sk: str, how: str, prefix: str = "", **take: str) -> DataFrame:
    take = take or {"order_state_cd": "order_state_cd"}
    side = star["dim_state"].select(F.col("order_state_sk").alias("_s"), *[F.col(c).alias(n) for c, n in take.items()])
    return fact.join(F.broadcast(side), F.col(sk) == F.col("_s"), how).drop("_s")


def with_channel(star: Star, fact: DataFrame, how: str, *cols: str) -> DataFrame:
    side = star["dim_channel"].select(F.col("channel_sk").alias("_c"), *cols)
    return fact.join(F.broadcast(side), F.col("channel_sk") == F.col("_c"), how).drop("_c")


def _current(star: Star, dim: str, sk: str, cols: tuple[str, ...], cond: Column | None = None) -> DataFrame:
    side = star[dim].filter("current_row_flag = 'Y'")
    if cond is not None:
        side = side.filter(cond)
    return side.select(sk, *cols)


def _known(fact: DataFrame, side: DataFrame, key: str, how: str) -> DataFrame:
    """Join on a key whose unknown member (-1) can own a large share of the facts.

    Rows of the unknown member spread over salted copies of nothing: their join
    key is a negative number of its own, and the one dimension row of the
    unknown member, if there is one, is repeated for each of these numbers.
    """
    n = salts()
    spread = F.when(F.col(key) == UNKNOWN, -1 - F.pmod(F.xxhash64(F.struct(*fact.columns)), F.lit(n))).otherwise(F.col(key)).cast("long")
    copies = F.when(F.col(key) == UNKNOWN, F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: (-i).cast("long"))).otherwise(F.array(F.col(key).cast("long")))
    right = side.select(F.explode(copies).alias("_k"), *[c for c in side.columns if c != key])
    return fact.withColumn("_k", spread).join(right, "_k", how).drop("_k")


def with_order(star: Star, fact: DataFrame, *cols: str, how: str = "left") -> DataFrame:
    """Header attributes; those that the fact carries itself cost no join."""
    missing = tuple(c for c in cols if c not in fact.columns)
    return fact.join(_current(star, "dim_order", "order_sk", missing), "order_sk", how) if missing else fact


def with_offering(star: Star, fact: DataFrame, *cols: str, how: str = "left", cond: Column | None = None) -> DataFrame:
    return _known(fact, _current(star, "dim_offering", "product_offering_sk", cols, cond), "product_offering_sk", how)


def with_customer(star: Star, fact: DataFrame, *cols: str, how: str = "left", cond: Column | None = None) -> DataFrame:
    return _known(fact, _current(star, "dim_customer", "customer_sk", cols, cond), "customer_sk", how)


def with_geography(star: Star, fact: DataFrame, *cols: str) -> DataFrame:
    return _known(fact, star["dim_geography"].select("geography_sk", *cols), "geography_sk", "left")


def segment() -> Column:
    return F.coalesce("segment_cd", F.lit("CONSUMER"))
