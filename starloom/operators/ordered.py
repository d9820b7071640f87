"""Global order without a single-task window.

A frame is range-partitioned on the ordering columns, sorted inside each
partition and written to the shared folder together with its partition number
and position, so nothing can be renumbered by a retry. On that stored layout
dense numbering, "previous row of the same key" and running totals need only
small per-partition carries. Because the range is cut on key *and* order
columns, a key holding a third of all rows is spread over many partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import prepare, shared_dir

PID, RN = "_pid", "_rn"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def number_rows(
    df: DataFrame, order_by: Sequence[str], partitions: int | None = None, cut_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``_pid`` (range partition) and ``_rn`` (dense 1..n in ``order_by`` order).

    ``order_by`` has to identify rows, otherwise ties are numbered arbitrarily.
    ``cut_by`` are columns that the stored layout gets folders by; the result
    then is a table to read from, and need not be written again.
    """
    spark = prepare(df.sparkSession)
    cols = [F.col(c) for c in order_by]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    position = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    placed = ranged.sortWithinPartitions(*cols).withColumn(PID, F.spark_partition_id()).withColumn("_pos", position)
    folder = f"{shared_dir(spark)}/ordered/{uuid.uuid4().hex}"
    writer = placed.write.option("compression", "zstd")
    (writer.partitionBy(*cut_by) if cut_by else writer).parquet(folder)
    stored = spark.read.schema(placed.schema).parquet(folder)
    # one number per partition: bounded by the partition count, so the driver may hold them
    # positions are the low bits of a running id: if they ever wrapped, count and position part
    sizes = {r[PID]: r for r in stored.groupBy(PID).agg(F.count(F.lit(1)).alias("n"), F.max("_pos").alias("last")).collect()}
    if any(r["last"] + 1 != r["n"] for r in sizes.values()):
        raise RuntimeError("a partition holds more rows than can be numbered")
    counts = (sizes[p]["n"] if p in sizes else 0 for p in range(max(sizes, default=0)))
    offsets = F.lit([0, *accumulate(counts)]).cast("array<bigint>")
    return stored.withColumn(RN, F.get(offsets, F.col(PID)) + F.col("_pos") + 1).drop("_pos")


def assign_surrogate_keys(
    df: DataFrame, bk_cols: Sequence[str], sk_col: str, start: int | DataFrame = 0, cut_by: Sequence[str] = (),
) -> DataFrame:
    """Dense keys in business-key order, continuing after ``start``.

    ``start`` is a number, or a one-row frame whose only column is the highest
    key in use (a scalar subquery, so it is read when the keys are).
    """
    numbered = number_rows(df, bk_cols, cut_by=cut_by)
    key = F.col(RN) + first_free(start)
    return numbered.withColumn(sk_col, key.cast("long")).select(sk_col, *df.columns)


def first_free(start: int | DataFrame) -> Column:
    """Offset for new keys; the unknown member's -1 and an empty table both mean zero."""
    if isinstance(start, DataFrame):
        return F.greatest(F.coalesce(start.scalar(), F.lit(0)), F.lit(0)).cast("long")
    return F.lit(start).cast("long")


def highest_key(df: DataFrame, sk_col: str) -> DataFrame:
    return df.agg(F.max(sk_col).alias(sk_col))


def with_previous(numbered: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``value`` of the preceding row of the same ``key``, NULL for the first row.

    ``numbered`` comes from :func:`number_rows` ordered by ``key`` first. The
    window is cut by range partition, never by key; the first row of a
    partition takes its predecessor from a one-row-per-partition table.
    """
    inside = Window.partitionBy(PID).orderBy(RN)
    last = numbered.groupBy(PID).agg(
        F.max_by(F.struct(F.col(key).alias("k"), F.col(value).alias("v")), RN).alias("_tail")
    )
    carry = last.select(F.lead(PID).over(Window.orderBy(PID)).alias(PID), "_tail")
    prev_key, prev_val = F.lag(key).over(inside), F.lag(value).over(inside)
    first = F.row_number().over(inside) == 1
    return (
        numbered.withColumn("_pk", prev_key)
        .withColumn("_pv", prev_val)
        .withColumn("_first", first)
        .join(F.broadcast(carry), PID, "left")
        .withColumn(
            out,
            F.when(F.col("_first") & (F.col("_tail.k") == F.col(key)), F.col("_tail.v"))
            .when(~F.col("_first") & (F.col("_pk") == F.col(key)), F.col("_pv")),
        )
        .drop("_pk", "_pv", "_first", "_tail")
    )


def with_running(numbered: DataFrame, key: str, sums: dict[str, Column | str]) -> DataFrame:
    """Running total per ``key`` of each expression, in the numbered order.

    Totals of keys that continue from earlier partitions are carried over. Only
    the first and the last key of a partition can do so, hence the carry table
    has at most two rows per partition.
    """
    inside = (
        Window.partitionBy(PID, key).orderBy(RN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    exprs = {out: (F.col(v) if isinstance(v, str) else v) for out, v in sums.items()}
    part = numbered.groupBy(PID, key).agg(*[F.sum(e).alias(out) for out, e in exprs.items()])
    ends = numbered.groupBy(PID).agg(
        F.min_by(key, RN).alias("_head"), F.max_by(key, RN).alias("_tail")
    )
    edges = ends.select(PID, F.explode(F.array_distinct(F.array("_head", "_tail"))).alias(key))
    earlier = Window.partitionBy(key).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = part.join(F.broadcast(edges), [PID, key], "left_semi").select(
        PID, key, *[F.sum(out).over(earlier).alias(f"_c_{out}") for out in exprs]
    )
    out_df = numbered.join(F.broadcast(carry), [PID, key], "left")
    for out, e in exprs.items():
        out_df = out_df.withColumn(out, F.sum(e).over(inside) + F.coalesce(f"_c_{out}", F.lit(0)))
    return out_df.drop(*[f"_c_{out}" for out in exprs])
