"""What reaches the driver is bounded in rows, also where labelled ids repeat."""

from helpers import docs

from starloom.llm import quality, toxicity

ROWS = [(1, f"text number {i} of one id", "en", "a", 1) for i in range(200)] + [(i, f"some words of {i}", "en", "a", 1) for i in range(2, 30)]


def test_repeated_ids_give_one_training_row_each(spark, monkeypatch):
    df, seen = docs(spark, ROWS), []
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 30)], "doc_id long, quality int, toxic int")
    fit, chain = quality.fit, toxicity.fit_chain
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(y)) or fit(x, y))
    monkeypatch.setattr(toxicity, "fit_chain", lambda row, feature, y, n: seen.append(len(y)) or chain(row, feature, y, n))
    for score in (quality.score_quality, toxicity.score_toxicity):
        assert score(df, labels, parts=1).count() == len(ROWS)
    assert seen == [29, 29]
