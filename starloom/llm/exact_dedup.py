"""Exact dedup: sorted digest runs merged along a tree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import doc_columns, lower_ascii, mapped, shuffle_partitions, stage

RUN = "slice int, source int, digest long, sha binary, keep_id long, n long"


def merge_runs(batches: Iterator[pa.RecordBatch], largest: bool) -> Iterator[pa.RecordBatch]:
    """One pass over rows sorted by (slice, source, digest, sha): equal digests become one row.

    Equal 64-bit digests stay apart unless the 256-bit ones agree as well. Holds
    one batch and the last open row.
    """
    best = np.maximum if largest else np.minimum
    worst = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max
    schema = pa.schema([("slice", pa.int32()), ("source", pa.int32()), ("digest", pa.int64()), ("sha", pa.binary()), ("keep_id", pa.int64()), ("n", pa.int64())])
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).cast(schema)
        table = pa.concat_tables([held, table]) if held is not None else table
        sha = np.array(table["sha"].to_pylist(), dtype="S64")
        keys = [table[c].to_numpy() for c in ("slice", "source", "digest")]
        new = np.ones(table.num_rows, bool)
        new[1:] = (sha[1:] != sha[:-1]) | np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        first = np.flatnonzero(new)
        keep = table["keep_id"].fill_null(worst).to_numpy()
        kept = best.reduceat(keep, first)
        out = table.take(pa.array(first)).select(["slice", "source", "digest", "sha"])
        out = out.append_column("keep_id", pa.array(kept, mask=kept == worst)).append_column("n", pa.array(np.add.reduceat(table["n"].to_numpy(), first)))
        held = out.slice(out.num_rows - 1)
        yield from out.slice(0, out.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def exact_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: str = "largest", fan_in: int = 8) -> DataFrame:
    """Group equal texts (A-Z folded) and name the row of each group that stays.

    Every text becomes a 64-bit digest, by which runs are sorted, and a SHA-256,
    which verifies that digests mean the same text. Rows are dealt to as many
    sources as there are shuffle partitions, by id, and each source makes one
    sorted run. Runs meet in rounds, ``fan_in`` sources at a time and one digest
    slice per task, until one run is left per slice; each merge keeps the
    largest (or smallest) id. A digest held by a third of all rows is one row
    per source from the first run on, and answers return by source as well, so
    no task ever sees all rows of a group.

    Returns a row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``. NULL text counts as empty. Rows without an id count in the
    group and stay only if no row of the group has an id. Repeated rows count
    one by one and share the decision of their id. Other columns are ignored;
    an empty table gives no rows.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rounds = max(1, math.ceil(math.log(parts, fan_in) - 1e-9))
    bits = max(1, math.ceil(math.log2(parts * 16)))
    normal = doc_columns(docs, text_col, id_col).select("doc_id", lower_ascii(F.col("text")).alias("text"))
    digests = stage(normal.select(
        "doc_id", F.pmod(F.hash("doc_id", F.xxhash64("text")), F.lit(parts)).alias("source"),
        F.xxhash64("text").alias("digest"), F.unhex(F.sha2("text", 256)).alias("sha")), "digests")
    best = F.max if keep == "largest" else F.min
    first = digests.groupBy("source", "digest", "sha").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    runs = first.withColumn("slice", F.shiftrightunsigned("digest", 64 - bits).cast("int"))
    for _ in range(rounds):
        dealt = runs.withColumn("source", F.floor(F.col("source") / fan_in).cast("int")).select("slice", "source", "digest", "sha", "keep_id", "n")
        met = dealt.repartition(parts, "slice", "source").sortWithinPartitions("slice", "source", "digest", "sha")
        runs = mapped(met, lambda it: merge_runs(it, keep == "largest"), RUN)
    groups = stage(runs.filter("n > 1").select("digest", "sha", "keep_id", "n"), "groups")
    answers = digests.select("source", "digest", "sha").distinct().join(groups, ["digest", "sha"])
    found = digests.join(answers, ["source", "digest", "sha"], "left")
    size = F.coalesce("n", F.lit(1).cast("long"))
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep_id.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
