"""Type-1 and Type-2 dimension maintenance as pure frame functions.

Parquet tables know no row-level MERGE, so each function returns the complete
next state of the dimension; :mod:`starloom.sources.tables` publishes it as a
new table version. Applying the same batch twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom import constants as K
from starloom.functions.columns import change_hash
from starloom.operators.keyed import latest_per_key
from starloom.operators.ordered import assign_surrogate_keys, highest_key
from starloom.sources.tables import publish_version, table_exists


@dataclass(frozen=True)
class History:
    """Names of the versioning columns and the digest that detects a change."""

    eff: str = "row_eff_date"
    exp: str = "row_exp_date"
    flag: str = "current_row_flag"
    digest: str = "change_hash"
    algo: str = "sha256"
    sep: str = "||"

    def hash_of(self, cols: Sequence[str]) -> Column:
        return change_hash(cols, self.algo, self.sep)


PIPELINE_HISTORY = History()
ORDER_HISTORY = History(eff="row_eff_dt", exp="row_exp_dt", algo="md5", sep="")


def _usable(source: DataFrame, bk: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows with a complete business key, one per key.

    Callers that have already reduced the source to one row per key say so and
    save the aggregation. Otherwise the winner among copies is fixed by a row hash.
    """
    for c in bk:
        source = source.filter(F.col(c).isNotNull())
    rest = [c for c in source.columns if c not in bk]
    if unique:
        return source
    if not rest:
        return source.distinct()
    return latest_per_key(source.withColumn("_h", F.xxhash64(*rest)), bk, ["_h"]).drop("_h")


def seed_scd2(source: DataFrame, bk: Sequence[str], tracked: Sequence[str], as_of: str, sk_col: str,
              names: History = PIPELINE_HISTORY, unique: bool = False) -> DataFrame:
    """First load: every key is version one."""
    rows = _open_versions(_usable(source, bk, unique), tracked, as_of, names)
    return assign_surrogate_keys(rows, bk, sk_col)


def _open_versions(rows: DataFrame, tracked: Sequence[str], as_of: str, names: History) -> DataFrame:
    """Stamp digest and validity; without ``tracked`` the source brings its own digest."""
    hashed = rows.withColumn(names.digest, names.hash_of(tracked)) if tracked else rows
    return (
        hashed.withColumn(names.eff, F.lit(as_of).cast("date"))
        .withColumn(names.exp, F.lit(K.OPEN_END).cast("date"))
        .withColumn(names.flag, F.lit("Y"))
    )


def scd2_apply(
    target: DataFrame | None,
    source: DataFrame,
    bk: Sequence[str],
    tracked: Sequence[str],
    as_of: str,
    sk_col: str,
    names: History = PIPELINE_HISTORY,
    type1: Sequence[str] = (),
    expire_missing: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Next state of a Type-2 dimension.

    A changed key closes its current version the day before ``as_of`` and opens a
    new one; a new key opens its first version; an unchanged key stays, except
    that ``type1`` columns take the incoming value in place. Keys absent from the
    source stay open unless ``expire_missing``. ``unique`` promises one source row per key.
    """
    if target is None:
        return seed_scd2(source, bk, tracked, as_of, sk_col, names, unique)
    incoming = _open_versions(_usable(source, bk, unique), tracked, as_of, names)
    current = target.filter(F.col(names.flag) == "Y")
    closed = target.filter(F.col(names.flag) != "Y")

    # expire or keep: only the key, the digest and the Type-1 columns travel
    probe = incoming.select(
        *bk, F.col(names.digest).alias("_new_hash"), *[F.col(c).alias(f"_new_{c}") for c in type1]
    )
    met = current.join(probe, list(bk), "left")
    differs = F.col("_new_hash").isNotNull() & ~F.col(names.digest).eqNullSafe(F.col("_new_hash"))
    ends = differs | F.col("_new_hash").isNull() if expire_missing else differs
    day_before = F.date_sub(F.lit(as_of).cast("date"), 1)
    kept = (
        met.withColumn("_ends", ends)
        .withColumn(names.exp, F.when(F.col("_ends"), day_before).otherwise(F.col(names.exp)))
        .withColumn(names.flag, F.when(F.col("_ends"), "N").otherwise(F.col(names.flag)))
    )
    for c in type1:
        same = F.col("_new_hash").isNotNull() & ~F.col("_ends")
        kept = kept.withColumn(c, F.when(same, F.col(f"_new_{c}")).otherwise(F.col(c)))

    # open: new keys and changed keys
    known = current.select(*bk, F.col(names.digest).alias("_old_hash"), F.lit(True).alias("_known"))
    opened = (
        incoming.join(known, list(bk), "left")
        .filter(F.col("_known").isNull() | ~F.col(names.digest).eqNullSafe(F.col("_old_hash")))
        .drop("_old_hash", "_known")
    )
    opened = assign_surrogate_keys(opened, bk, sk_col, highest_key(target, sk_col))

    layout = target.schema
    return closed.unionByName(in_layout(kept, layout)).unionByName(in_layout(opened, layout))


def in_layout(rows: DataFrame, layout: StructType) -> DataFrame:
    """``rows`` with exactly the columns of ``layout``; what they lack is NULL."""
    have = set(rows.columns)
    return rows.select(*(
        (F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in layout))


def classify_changes(
    target: DataFrame, source: DataFrame, bk: Sequence[str], type2: Sequence[str], type1: Sequence[str],
    names: History = ORDER_HISTORY,
) -> DataFrame:
    """Source rows with ``change_type``: NEW, SCD2_CHANGE, SCD1_CHANGE or UNCHANGED."""
    current = target.filter(F.col(names.flag) == "Y").select(
        *bk,
        names.hash_of(type2).alias("_t2"),
        names.hash_of(type1).alias("_t1"),
        F.lit(True).alias("_known"),
    )
    return (
        _usable(source, bk)
        .withColumn(names.digest, names.hash_of(type2))
        .join(current, list(bk), "left")
        .withColumn(
            "change_type",
            F.when(F.col("_known").isNull(), "NEW")
            .when(F.col(names.digest) != F.col("_t2"), "SCD2_CHANGE")
            .when(names.hash_of(type1) != F.col("_t1"), "SCD1_CHANGE")
            .otherwise("UNCHANGED"),
        )
        .drop("_t2", "_t1", "_known")
    )


def scd1_upsert(
    target: DataFrame | None, source: DataFrame, bk: Sequence[str], update_cols: Sequence[str], sk_col: str
) -> DataFrame:
    """Next state of a Type-1 dimension: overwrite in place, append unseen keys."""
    rows = _usable(source, bk)
    if target is None:
        return assign_surrogate_keys(rows, bk, sk_col)
    probe = rows.select(*bk, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in update_cols])
    merged = target.join(probe, list(bk), "left")
    for c in update_cols:  # an explicit match flag: an incoming NULL overwrites too
        merged = merged.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)))
    fresh = rows.join(target.select(*bk), list(bk), "left_anti")
    fresh = assign_surrogate_keys(fresh, bk, sk_col, highest_key(target, sk_col))
    return in_layout(merged, target.schema).unionByName(in_layout(fresh, target.schema))


def merge_scd2(source: DataFrame, table: str, bk: Sequence[str], tracked: Sequence[str], as_of: str, sk_col: str,
               **options: object) -> None:
    """Apply a batch to a stored Type-2 dimension and publish its next version."""
    publish_version(scd2_apply(_stored(source, table), source, bk, tracked, as_of, sk_col, **options), table)


def merge_scd1(source: DataFrame, table: str, bk: Sequence[str], update_cols: Sequence[str], sk_col: str) -> None:
    """Apply a batch to a stored Type-1 dimension and publish its next version."""
    publish_version(scd1_upsert(_stored(source, table), source, bk, update_cols, sk_col), table)


def _stored(source: DataFrame, table: str) -> DataFrame | None:
    spark = source.sparkSession
    return spark.table(table) if table_exists(spark, table) else None


def lookup_as_of(
    facts: DataFrame, dim: DataFrame, bk: Sequence[str], date_col: str, names: History = ORDER_HISTORY, prefix: str = "",
) -> DataFrame:
    """Attach the dimension version that was valid on ``date_col`` (point-in-time join).

    Dimension columns take ``prefix``; a name that the facts have already is
    refused rather than dropped. Facts without a key or a date pass by the join.
    """
    taken = [c for c in dim.columns if c not in bk]
    clash = sorted({f"{prefix}{c}" for c in taken} & set(facts.columns))
    if clash:
        raise ValueError(f"columns {clash} exist on both sides; give a prefix")
    side = dim.select(*(F.col(c).alias(f"_d_{c}") for c in bk), *(F.col(c).alias(f"{prefix}{c}") for c in taken))
    complete = F.col(date_col).isNotNull()
    cond = F.col(date_col).cast("date").between(F.col(prefix + names.eff), F.col(prefix + names.exp))
    for c in bk:
        complete = complete & F.col(c).isNotNull()
        cond = (F.col(c) == F.col(f"_d_{c}")) & cond
    met = facts.filter(complete).join(side, cond, "left").drop(*(f"_d_{c}" for c in bk))
    return met.unionByName(in_layout(facts.filter(~complete), met.schema))
