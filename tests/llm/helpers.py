"""Small tables with everything that goes wrong in real ones, and plain Python versions of what operators do."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: NULLs in every column, empty and blank texts, a text of 40,000 words, ties, repeated rows, other scripts.
ROWS = [
    (1, "The quick brown fox\njumps over\nthe lazy dog", "en", "a", 10),
    (2, "the QUICK brown fox\njumps over\nthe lazy dog", None, "a", 10),
    (3, None, "en", None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n ", "en", "b", 3),
    (6, "word " * 40_000, "en", "b", 1),
    (7, "ÄÖÜ ñandú éa b\n\nçedilla — it's 12345 don't", "de", "c", 5),
    (8, "one", "en", "c", 5),
    (9, "The quick brown fox\njumps over\nthe lazy dog", "en", "a", 10),
    (9, "The quick brown fox\njumps over\nthe lazy dog", "en", "a", 10),
    (None, "The quick brown fox\njumps over\nthe lazy dog", "en", "a", 10),
    (None, None, None, None, None),
    (-3, "İstanbul ẞ <|endoftext|> \x1c odd", "tr", "d", 7),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same table with columns named like those that operators make themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(
        "fp source2 digest sha slice keep_id n component _id _row pos score chunk part start curve_key train y window item".split())))


def low(text):
    return (text or "").translate(LOWER)


def plain_words(text):
    return re.findall("[^\x20\x09-\x0D]+", low(text))


def sample(sf="sf0.001"):
    import duckdb

    return duckdb.sql(f"select doc_id, text, lang, source, n_chars from '/root/testdata/{sf}/documents.parquet'").fetchall()
