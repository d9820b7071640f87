"""The pipeline's stages one by one, and all of them."""

import corpus_pipeline
from helpers import ROWS, docs

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_clean_rows(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in df.collect()}
    for name, work in corpus_pipeline.STAGES[:-1]:
        out = work(spark, df, SF)
        assert out.columns == df.columns, name
        kept = [r.doc_id for r in out.collect()]
        assert set(kept) <= ids and len(kept) > 0.5 * df.count(), name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_whole_pipeline(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    docs_out = {r.doc_id for r in out}
    df, want = spark.read.parquet(f"{SF}/documents.parquet"), None
    for _, work in corpus_pipeline.STAGES[:-1]:
        df = spark.createDataFrame(work(spark, df, SF).collect(), df.schema)
        want = {r.doc_id for r in df.collect()}
    assert docs_out == want
    assert sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())


def test_odd_rows(spark):
    df = docs(spark, ROWS)
    for _, work in corpus_pipeline.STAGES[1:]:
        assert work(spark, df, SF).count() > 0
        assert work(spark, df.limit(0), SF).count() == 0
