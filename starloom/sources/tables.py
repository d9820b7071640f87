"""Sinks on catalog tables: append, partition overwrite, batch reload, versioned publish."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _sized(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Even, reasonably large files per partition value: big values are split, small ones merged."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """``insertInto`` resolves by position, so put columns in table order."""
    return df.select(*df.sparkSession.table(table).columns)


def _ensure_table(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """Create the table from the schema alone, so every load is an insert (and can be observed)."""
    spark = df.sparkSession
    if table_exists(spark, table):
        return
    writer = spark.createDataFrame([], df.schema).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def write_append(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    _ensure_table(df, table, partition_by)
    _aligned(_sized(df, partition_by), table).write.mode("append").insertInto(table)


def write_overwrite(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh. ``df`` must not read ``table``; use :func:`publish_version` for that."""
    writer = _sized(df, partition_by).write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


#: ``insertInto`` takes the overwrite mode and the number of open files from the session only.
_DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
#: A task that writes a handful of partition values keeps a file open for each, instead of sorting its rows by them.
_OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


@contextmanager
def _set(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _spec(values: Mapping[str, object]) -> str:
    return ", ".join(f"{k}='{v}'" for k, v in values.items())


def overwrite_partitions(
    df: DataFrame, table: str, partition_by: Sequence[str] = (),
    clear: Sequence[Mapping[str, object]] = (), few: bool = False,
) -> None:
    """Replace exactly the partitions that occur in ``df``.

    ``few`` says that ``df`` holds a handful of partition values at most, such as
    one batch. Its tasks then write their rows where they are and as they come: a
    rebalance would send every row over the network, and small loads to a single task.

    ``clear`` names partitions the run is responsible for: those that received no
    row are emptied too, so an empty result cannot leave stale rows behind. They
    are emptied after the write: a load that fails leaves every old row in
    place, and ``df`` may read the very partitions it replaces.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        if not partition_by:
            raise ValueError(f"{table} does not exist: partition_by is needed to create it")
        _ensure_table(df, table, partition_by)
        rows = df if few else _sized(df, partition_by)
        with _set(spark, _OPEN_FILES if few else {}):
            _aligned(rows, table).write.mode("append").insertInto(table)
        return
    parts = partition_columns(spark, table)
    before = [_files_of(spark, table, values) for values in clear]
    with _set(spark, _DYNAMIC | (_OPEN_FILES if few else {})):
        _aligned(df if few else _sized(df, parts), table).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    for values, old in zip(clear, before):
        # the write has succeeded; a partition that still has its old files got no row from it
        if old and _files_of(spark, table, values) == old:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(values)})")


def _files_of(spark: SparkSession, table: str, values: Mapping[str, object]) -> set[str]:
    """Names of the files of one partition; nothing is read."""
    rows = spark.table(table)
    for name, value in values.items():
        rows = rows.filter(F.col(name) == F.lit(value).cast(rows.schema[name].dataType))
    return set(rows.inputFiles())


def has_partition(spark: SparkSession, table: str, values: Mapping[str, object]) -> bool:
    """Whether a partition of the table holds any file."""
    return bool(_files_of(spark, table, values))


def advance_partition(spark: SparkSession, table: str, old: Mapping[str, object], new: Mapping[str, object]) -> None:
    """Move all rows of one partition to another, such as a status on to the next one.

    The partition is renamed, and no row is read. What the new one held before is
    replaced. A run that is cut off in between finds the old files or the new ones,
    and goes on from there; a finished one finds no old partition and changes nothing.
    """
    if has_partition(spark, table, old):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(new)})")
        spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(old)}) RENAME TO PARTITION ({_spec(new)})")
    elif not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_spec(old)})").isEmpty():
        # cut off between the files and the catalog: the files lie under the new name already
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(new)})")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(old)})")
    else:
        return
    spark.catalog.refreshTable(table)


def replace_batch(df: DataFrame, table: str, batch_id: str, batch_col: str = "etl_batch_id") -> None:
    """Reload one batch: its old rows go, the new ones come, other batches stay."""
    wrong = F.col(batch_col).isNull() | (F.col(batch_col) != batch_id)
    guarded = df.withColumn(
        batch_col,
        F.when(wrong, F.raise_error(F.lit(f"row outside batch {batch_id}"))).otherwise(F.col(batch_col)),
    )
    overwrite_partitions(guarded, table, [batch_col], clear=[{batch_col: batch_id}], few=True)


def publish_version(df: DataFrame, table: str, keep: int = 2) -> None:
    """Write ``df`` as the next version of an unpartitioned table and switch over.

    ``df`` may read the current version: the new files go to a new folder and the
    catalog entry is re-pointed only after the write has succeeded. The last
    ``keep`` versions stay for readers that have begun; older folders go.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        db, name = table.split(".") if "." in table else (spark.catalog.currentDatabase(), table)
        base = spark.catalog.getDatabase(db).locationUri.rstrip("/") + f"/{name}_versions"
        first = f"{base}/v1"
        df.write.mode("overwrite").parquet(first)
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{first}'")
        return
    location = (
        spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    )
    base, number = re.fullmatch(r"(.*)/v(\d+)", location).groups()
    following = f"{base}/v{int(number) + 1}"
    df.write.mode("overwrite").parquet(following)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{following}'")
    spark.catalog.refreshTable(table)
    _drop_folder(spark, f"{base}/v{int(number) + 1 - keep}")


def _drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def purge_older_than(df: DataFrame, ts_col: str, as_of: str, days: int = 90) -> DataFrame:
    """Rows still within retention; rows without a load time are kept, as SQL DELETE would."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.filter(F.col(ts_col).isNull() | (F.col(ts_col).cast("date") >= cutoff))


def purge_partitions(spark: SparkSession, tables: Sequence[str], date_col: str, as_of: str,
                     days: int = 90) -> None:
    """Retention on tables partitioned by load date: drops whole partitions, rewrites nothing."""
    cutoff = dt.date.fromisoformat(as_of) - dt.timedelta(days=days)
    for table in tables:
        # partition names only: one per day of retention, never data
        names = spark.sql(f"SHOW PARTITIONS {table}").select(
            F.regexp_extract("partition", rf"(?:^|/){date_col}=([0-9-]+)", 1).alias("day")
        ).distinct()
        for row in names.filter(f"day <> '' AND day < '{cutoff}'").collect():
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec({date_col: row.day})})")


def mark_processed(df: DataFrame, batch_id: str) -> DataFrame:
    """Advance validated rows of the batch from V to P."""
    done = (F.col("stg_batch_id") == batch_id) & (F.col("stg_record_status") == "V")
    return df.withColumn("stg_record_status", F.when(done, "P").otherwise(F.col("stg_record_status")))
