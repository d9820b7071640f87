"""Session preparation: time zone and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


#: The JVM never compiles a method of more bytes than this, so a longer one would be interpreted, row by row.
COMPILED_BYTES = "8000"
#: A side that the planner takes for larger is not broadcast. Sizes are estimated from compressed files by
#: width of columns, so that dense keys of ten estimated megabytes were hundreds in the driver's memory.
BROADCAST_BYTES = 4 << 20
_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def bytes_of(size: str) -> int:
    """A size of the configuration in bytes; a bare number is bytes."""
    found = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower())
    if not found:
        raise ValueError(f"{size!r} is not a size")
    return int(found[1]) * _UNITS[found[2]]


def prepare(spark: SparkSession) -> SparkSession:
    """Fix the session to UTC, keep generated code compilable and broadcasts small, and make sure checkpoints have a place to go."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > int(COMPILED_BYTES):
        # wide rules and cleansing exceed it as one method; cut by expression they are compiled again
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_BYTES)
    if bytes_of(spark.conf.get(_BROADCAST)) > BROADCAST_BYTES:
        spark.conf.set(_BROADCAST, str(BROADCAST_BYTES))  # the check at run time takes the same limit, of rows as they are
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A private temporary folder is used only for a local master, where driver
    and executors are one process; a cluster has to name a shared folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="starloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def written(df: DataFrame, label: str, by: Sequence[str] = (), observed: Observation | None = None, metrics: Sequence[Column] = ()) -> DataFrame:
    """``df`` written once below the shared folder and read back, cut by ``by``.

    ``metrics`` are aggregates that the write itself counts into ``observed``.
    """
    spark = prepare(df.sparkSession)
    path = f"{shared_dir(spark).rstrip('/')}/written/{label}-{uuid.uuid4().hex}"
    out = df.observe(observed, *metrics) if observed else df
    writer = out.write.partitionBy(*by) if by else out.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
