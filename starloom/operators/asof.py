"""Point-in-time lookup by one global order instead of a range test per key.

Facts and versions are put in one order of key and date. A fact then takes the
last version before it; what it needs from an earlier partition is that
partition's last version, one row each. A key holding a third of all facts is
cut over partitions like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.ordered import PID, RN, number_rows
from starloom.operators.scd import ORDER_HISTORY, History, in_layout


def merge_as_of(facts: DataFrame, dim: DataFrame, bk: Sequence[str], date_col: str, names: History = ORDER_HISTORY, prefix: str = "") -> DataFrame:
    """``facts`` with the version of ``dim`` that was valid on ``date_col``; same result as ``lookup_as_of``.

    Versions of a key may not overlap. Dimension columns take ``prefix``; a name
    that the facts have already is refused. Facts without a key or a date, or
    before the first version, get NULLs.
    """
    taken = [c for c in dim.columns if c not in bk]
    clash = sorted({f"{prefix}{c}" for c in taken} & set(facts.columns))
    if clash:
        raise ValueError(f"columns {clash} exist on both sides; give a prefix")
    complete = F.col(date_col).isNotNull()
    for c in bk:
        complete = complete & F.col(c).isNotNull()
    key = [F.col(c).alias(f"_k{i}") for i, c in enumerate(bk)]
    keys = [f"_k{i}" for i in range(len(bk))]
    versions = dim.select(*key, F.col(names.eff).cast("date").alias("_at"), F.lit(0).alias("_side"), F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(bk)), *taken).alias("_version"))
    rows = facts.filter(complete).select(*key, F.col(date_col).cast("date").alias("_at"), F.lit(1).alias("_side"), F.struct(*facts.columns).alias("_row"))
    ranked = number_rows(versions.unionByName(rows, allowMissingColumns=True), [*keys, "_at", "_side"])

    before = Window.partitionBy(PID).orderBy(RN).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tails = ranked.groupBy(PID).agg(F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col(RN))).alias("_tail"))
    earlier = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    carry = tails.select(PID, F.last("_tail", True).over(earlier).alias("_carried"))
    met = ranked.withColumn("_last", F.last("_version", True).over(before)).filter("_side = 1").join(F.broadcast(carry), PID, "left")
    last = F.coalesce("_last", "_carried")
    fits = F.col("_at") <= last[names.exp]
    for i, k in enumerate(keys):
        fits = fits & (F.col(k) == last[f"k{i}"])
    found = met.select("_row.*", *(F.when(fits, last[c]).alias(f"{prefix}{c}") for c in taken))
    return found.unionByName(in_layout(facts.filter(~complete), found.schema))
