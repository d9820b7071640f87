"""What several operators need: staged tables, text columns in Arrow, words of a batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 2 << 20  # text handled at once inside a task
BATCH_BYTES = 8 << 20  # what Spark hands to a Python worker at once


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder, cut by a column if asked, and read it back.

    Cuts lineage: a lost executor costs a re-read, never a recomputation, and
    what was drawn once (split points, numbering) stays as it is.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_at = path
    return back


def drop_staged(*stages: DataFrame) -> None:
    """Remove the folders of ``stage`` results that nothing reads any more."""
    for df in stages:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def doc_columns(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The two columns an operator works on; whatever else a table holds cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. A text without other letters takes the short way through ``lower``."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a missing id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def smallest_hashes(known: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows whose ids have the smallest hashes, written.

    A threshold on the hash that about twice as many pass comes first, so that
    no task sorts more than its share of those.
    """
    total = known.count()
    key = F.xxhash64("doc_id")
    few = known
    if total > 4 * rows:
        few = known.filter(key < int(-(1 << 63) + (1 << 64) * (2 * rows / total)))
        few = few if few.count() >= rows else known
    return stage(few.orderBy(key, "doc_id").limit(rows), "labels")


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            base = total[at] - size[at]
            upto = max(int(np.searchsorted(total, base + limit, side="right")), at + 1)
            yield batch.slice(at, upto - at)
            at = upto
        pa.default_memory_pool().release_unused()


def raw(texts: pa.Array) -> tuple[np.ndarray, bytes]:
    """Offsets and bytes of a string column."""
    texts = texts.cast(pa.string()).fill_null("")
    if not len(texts):
        return np.zeros(1, np.int32), b""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset: texts.offset + len(texts) + 1]
    return at - at[0], bytes(memoryview(data)[at[0]: at[-1]]) if data is not None else b""


def strings(offsets: np.ndarray, data: bytes) -> pa.Array:
    """The string column of these offsets and bytes."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(data))


#: Bytes to bytes: A-Z to a-z, and the rest as it is.
LOWER_TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: As above, with every byte that is no digit, letter or part of a longer character turned into a space.
WORD_TABLE = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in LOWER_TABLE)


def words(texts: pa.Array, table: bytes | None = LOWER_TABLE) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many each text has.

    Words are what white space (0x20, 0x09-0x0D) parts, after ``table`` has
    replaced single bytes.
    """
    offsets, data = raw(texts)
    parts = pc.ascii_split_whitespace(strings(offsets, data.translate(table) if table else data))
    flat = parts.flatten()
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0)
    if pc.all(real).as_py() is not False:
        return flat, counts
    row = np.repeat(np.arange(len(counts)), counts)
    return flat.filter(real), np.bincount(row[real.to_numpy(zero_copy_only=False)], minlength=len(counts)).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every piece, one after another."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - before, lengths)


def _small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once by bytes, as rows can be of any length."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "64m").rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def mapped(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` through ``work``, batch by batch inside its partitions."""
    _small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def column_of(df: DataFrame, each: Callable[[pa.Array], np.ndarray], kind: str, text_col: str, limit: int = SLICE_BYTES) -> Column:
    """A column computed from whole texts (NULL: empty), some megabytes of text at a time."""
    _small_batches(df.sparkSession)

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = pa.RecordBatch.from_arrays([texts.cast(pa.string()).fill_null("")], names=["text"])
            found = [each(b.column("text")) for b in slices([rows], "text", limit)]
            yield pa.array(np.concatenate(found)) if found else pa.array([], empty)

    empty = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind]
    return F.arrow_udf(work, kind)(F.col(text_col))
