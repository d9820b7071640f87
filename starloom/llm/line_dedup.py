"""Line dedup with DataFrame functions only: repeated windows of three lines lose their later copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import shuffle_partitions, stage

LINES, LONG_WORDS = 3, 50
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_id"), F.xxhash64(text, F.lit("row")).alias("_row"), text.alias("_text")]


def line_windows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lines: int = LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """A row per window: where it starts, how many lines it takes, and a 128-bit key of its lines.

    A window is ``lines`` consecutive lines, or fewer where these already hold
    more than ``long_words`` words (counted by spaces). Windows overlap: one
    starts at every line from which enough lines follow.
    """
    split = docs.select(*_keyed(docs, text_col, id_col)).select("_id", "_row", F.split("_text", "\n", -1).alias("l"))
    coded = split.select(
        "_id", "_row", F.transform("l", lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"),
            (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("w"))).alias("l"), F.size("l").alias("n"))

    def window(i: Column) -> Column:
        # an index past the end gives NULL: its words count as none, and the window falls away below
        at = [F.get("l", i + j) for j in range(lines)]
        words, take = F.lit(0), F.lit(lines)
        for j in range(lines - 1, 0, -1):
            words = sum((F.coalesce(at[k]["w"], F.lit(0)) for k in range(j)), F.lit(0))
            take = F.when(words > long_words, F.lit(j)).otherwise(take)
        # the hash skips NULLs, so a line that is not taken leaves no mark; the number taken does
        parts = lambda side: [F.when(take > j, at[j][side]) for j in range(lines)]
        return F.struct(i.alias("pos"), take.alias("take"), F.xxhash64(take, *parts("a")).alias("k1"), F.xxhash64(*parts("b"), take).alias("k2"))

    made = coded.select("_id", "_row", "n", F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), window)).alias("x"))
    return made.filter(F.col("x.pos") + F.col("x.take") <= F.col("n")).select("_id", "_row", "x.pos", "x.take", "x.k1", "x.k2")


def covered_lines(windows: DataFrame) -> DataFrame:
    """Per text the positions covered by a window that occurred before: ``_id, _row, drop``.

    Windows are first counted per key and source (a source is a share of the
    ids), so a passage in a third of all texts is one row per source before any
    of its occurrences meet; the answer goes back by key and source.
    """
    parts = shuffle_partitions(windows.sparkSession)
    rows = windows.withColumn("source", F.pmod(F.hash("_id", "_row"), F.lit(parts)))
    place = F.struct("_id", "_row", "pos")
    local = rows.groupBy("k1", "k2", "source").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = local.groupBy("k1", "k2").agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1").select("k1", "k2", "first")
    answers = local.select("k1", "k2", "source").join(repeated, ["k1", "k2"])
    later = rows.join(answers, ["k1", "k2", "source"]).filter(place != F.col("first"))
    spans = F.sequence(F.col("pos"), F.col("pos") + F.col("take") - 1)
    return later.groupBy("_id", "_row").agg(F.array_distinct(F.flatten(F.collect_list(spans))).alias("drop"))


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lines: int = LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with every later occurrence of a repeated window cut out of its text.

    Windows (see ``line_windows``) are compared over all texts. In the order of
    ids, and of positions within a text, the first occurrence of a window stays
    and the lines of every later one go; overlapping windows are merged by the
    positions they cover. Lines are compared as they are, character by
    character. What stays is joined by one newline each.

    All rows and columns come back in the same order of columns, with ``text``
    replaced and ``_lines`` and ``_removed`` added (columns of these names are
    replaced). NULL text is no line and stays NULL; an empty text is one empty
    line and stays. Texts too short for a window stay whole. Rows with equal id
    and text are one text, which every such row holds alike; a missing id comes
    before all others.
    """
    found = covered_lines(stage(line_windows(docs, text_col, id_col, lines, long_words), "windows"))
    kept = [c for c in docs.columns if c not in ("_lines", "_removed")]
    whole = docs.select(F.struct(*kept).alias("_doc"), *_keyed(docs, text_col, id_col)[:2])
    joined = whole.join(found, ["_id", "_row"], "left")
    text = F.col("_doc")[text_col]
    split = F.split(text, "\n", -1)
    rest = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("drop"))
    clean = F.when(F.col("drop").isNull(), text).otherwise(F.array_join(F.transform(rest, lambda i: F.get(split, i)), "\n"))
    return joined.select(
        *(clean.alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in kept),
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(split)).cast("long").alias("_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("_removed"))
