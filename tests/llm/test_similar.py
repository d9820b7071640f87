"""The pipeline's near-dedup stage against a plain comparison of all pairs."""

import random

import corpus_pipeline
from helpers import ROWS, clashing, docs, plain_words, sample

from starloom.llm.similar import _linked


def plain_set(text):
    w = plain_words(text)
    return frozenset(tuple(w[j: j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def plain_groups(texts):
    sets = [plain_set(t) for t in texts]
    at = list(range(len(sets)))

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or (a and b and len(a & b) / len(a | b) >= 0.8):
                at[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


def edited(r, words, changes):
    words = list(words)
    for k in range(changes):
        words[r.randrange(len(words))] = f"new{r.randrange(10**9)}"
    return " ".join(words)


def kept_by_group(spark, rows):
    df = clashing(docs(spark, rows))
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    return [(r.doc_id, r.text) for r in out.collect()]


def test_stage_keeps_one_of_each_similar_group(spark):
    """Near copies of 0.80 to 0.95 differ in more than three of 64 bits."""
    r = random.Random(3)
    rows = [(1000 + x[0], *x[1:]) for x in sample()[:120]]
    for k in range(40):
        base = [f"b{k}w{i}" for i in range(300)]
        rows += [(5000 + 10 * k + n, edited(r, base, n), "en", "s", 1) for n in (0, 3, 5, 7, 9)]
    rows += [(9000 + n, edited(r, [f"hot{i}" for i in range(200)], 2), "en", "s", 1) for n in range(60)]  # one large bucket
    groups = plain_groups([x[1] for x in rows])
    want = {}
    for x, g in zip(rows, groups):
        want[g] = min(want.get(g, x[0]), x[0])
    assert len(want) < len(rows) - 150
    assert sorted(i for i, _ in kept_by_group(spark, rows)) == sorted(want.values())


def test_stage_keeps_one_of_a_group_without_ids_and_every_group_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(None, a, "en", "s", 1), (None, a, "en", "s", 1), (5, a, "en", "s", 1), (None, b, "en", "s", 1), (None, b, "en", "s", 1), (5, c, "en", "s", 1), (5, c, "en", "s", 1)]
    assert sorted(kept_by_group(spark, rows), key=str) == sorted([(5, a), (None, b), (5, c)], key=str)


def test_texts_of_near_fingerprints_meet_without_a_common_band(spark):
    """SimHash alone finds these pairs; the whole sets decide."""
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join([*words[:-1], "end"]), " ".join(f"v{i}" for i in range(300)), " ".join([*words, "more"])]
    prints = [1 << 40, 1 << 40 | 7, 1 << 40 | 3, 1 << 40]  # the third text differs, however near its fingerprint
    rows = [(n, fp, [100 + n], bytes(125)) for n, fp in enumerate(prints)]
    heads = spark.createDataFrame(rows, "node long, fp long, keys array<long>, minima binary")
    linked = _linked(heads, spark.createDataFrame(list(enumerate(texts)), "node long, text string"), 0.8)
    assert {r.node: r.component for r in linked.collect()} == {0: 0, 1: 0, 3: 0}
