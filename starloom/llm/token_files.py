"""Token files: Parquet list columns that can be read by token or by metadata alone."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.bpe import encoder
from starloom.llm.shared import BATCH_BYTES, doc_columns, mapped, shuffle_partitions, slices
from starloom.session import shared_dir

ROW = "doc_id long, part int, start_in_part long, n_tokens int, ids array<int>"
#: Writer settings: dictionary pages for ids (a vocabulary repeats within a row group), row
#: groups of 32 MB, and pages of at most 64 KB and 2,000 rows, each with its place and its
#: least and greatest values in the page indexes.
LAYOUT = {
    "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20), "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10), "parquet.page.row.count.limit": "2000", "parquet.page.write-checksum.enabled": "true",
    "parquet.column.index.access": "true", "compression": "zstd",
}
#: The same with the second page version, which delta-codes ids that fall back from a dictionary.
DELTA = {**LAYOUT, "parquet.writer.version": "v2", "parquet.enable.dictionary": "false"}


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, spaces: bool, end_id: int | None,
                      text_col: str = "text", id_col: str = "doc_id", encoding: str = "dictionary") -> None:
    """Write the ids of every text below ``path``, in ascending ``doc_id`` order.

    Rows are range-partitioned by id, so file after file (column ``part``) and
    row after row the ids ascend; equal ids are ordered by their text, a missing
    id comes first. NULL text counts as empty. A row holds ``doc_id, part,
    start_in_part, n_tokens, ids``. An empty table writes no rows.
    """
    n = shuffle_partitions(docs.sparkSession)
    rows = doc_columns(docs, text_col, id_col).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, code = TaskContext.get().partitionId(), 0, encoder(tokenizer_file, spaces, end_id)
        for batch in slices(batches, "text", BATCH_BYTES // 2):
            ids, lengths = code(batch.column("text"))
            bound = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.full(len(lengths), part, np.int32)), pa.array(at + bound[:-1]),
                pa.array(lengths.astype(np.int32)), pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(ids))],
                names=["doc_id", "part", "start_in_part", "n_tokens", "ids"])
            at += int(bound[-1])

    writer = mapped(rows, encode, ROW).write.mode("overwrite").options(**(DELTA if encoding == "delta" else LAYOUT))
    writer.parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` of every document; no token page is read.

    ``start`` counts the ids of all documents before. Parts are summed into one
    row per file, and the running total over those few rows is joined back.
    """
    rows = spark.read.schema(ROW).parquet(path)
    return _with_start(rows.select("doc_id", "part", "start_in_part", "n_tokens")).select("doc_id", "start", "n_tokens")


def _with_start(rows: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(F.col("part").alias("p"), F.coalesce(
        F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("before"))
    # one row per written part: as many as shuffle partitions, whatever the documents
    return rows.join(F.broadcast(before), rows["part"] == before["p"], "left").withColumn("start", F.col("before") + F.col("start_in_part"))


def read_tokens(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """Documents with their ids; an id range is pruned by row group and page."""
    rows = spark.read.schema(ROW).parquet(path)
    if first_id is not None:
        rows = rows.filter(F.col("doc_id") >= first_id)
    return rows if last_id is None else rows.filter(F.col("doc_id") <= last_id)


def crc_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row the unsigned crc32 of its ids as little-endian 32-bit integers."""
    for batch in batches:
        ids = batch.column("ids")
        at = ids.offsets.to_numpy()
        data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))).cast("B")
        crc = [zlib.crc32(data[4 * a: 4 * b]) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens").cast(pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_file_digest(docs: DataFrame, tokenizer_file: str, spaces: bool, end_id: int | None) -> DataFrame:
    """Write the files into the shared folder, read them back, and return a row per document with its digest."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, path, tokenizer_file, spaces, end_id)
    rows = _with_start(spark.read.schema(ROW).parquet(path)).select("doc_id", "start", "n_tokens", "ids")
    return mapped(rows, crc_of_ids, "doc_id long, start long, n_tokens long, ids_crc32 long")
