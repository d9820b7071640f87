"""Registered queries of the corpus operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.collocations import collocations
from starloom.llm.decontaminate import find_benchmark
from starloom.llm.exact_dedup import exact_groups
from starloom.llm.fim import fill_in_middle, restored
from starloom.llm.html_text import main_text
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.lm_score import score_documents
from starloom.llm.packing import pack
from starloom.llm.quality import score_quality
from starloom.llm.secrets import BASE, find_secrets, joined_spans, of_kinds
from starloom.llm.simhash import near_groups
from starloom.llm.token_files import token_file_digest
from starloom.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), spaces=True, end_id=1)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), spaces=False, end_id=1)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    number = [F.size(of_kinds(F.col("secrets"), (k,))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *number, F.sha2(joined_spans(F.col("secrets"), BASE), 256).alias("base_sha256"), joined_spans(F.col("secrets")).alias("spans"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_lm_score": op4_lm_score,
    "op5_html_text": op5_html_text,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_token_files": op9_token_files,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_secrets": op11_secrets,
    "op12_fim": op12_fim,
    "op13_collocations": op13_collocations,
}
