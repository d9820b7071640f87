"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; all but
the last return the columns of ``documents``. ``run`` writes each stage as
Parquet into the shared folder and reads it back for the next, so a lost
executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.decontaminate import drop_contaminated
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.packing import pack
from starloom.llm.quality import keep_good
from starloom.llm.queries import table, tokenizer
from starloom.llm.shared import stage
from starloom.llm.similar import keep_dissimilar

#: The stages need trained models, fingerprints and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go; ``n_chars`` follows the text."""
    clean = dedup_lines(docs).select(*docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose five-word shingles are similar by 0.8 or more."""
    return keep_dissimilar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences of 2048 tokens, a row per piece."""
    return pack(docs, tokenizer("byte_bpe_50k.json"), spaces=True, end_id=1)


STAGES = [
    ("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("decontamination", decontaminate), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
