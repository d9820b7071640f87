"""Phrase collocations against plain counts of all phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
from helpers import ROWS, clashing, docs, low, sample

from starloom.llm.collocations import collocations, frequent_phrases, tokens


def pieces(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", low(text))]


def counts(rows):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i: i + k])) for i in range(len(w) - k + 1))
    return f, n


def plain(rows, least=30, top=2000):
    f, n = counts(rows)
    many = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = []
    for (lang, w), a in many.items():
        cuts = [(2_000_000 * a // (f[lang, w[:j]] + f[lang, w[j:]]), j) for j in range(1, len(w))]
        score, j = min(cuts)
        inside = (b for (other, v), b in many.items() if other == lang and len(v) > len(w) and any(v[i: i + len(w)] == w for i in range(len(v))))
        if not any(100 * b >= 80 * a for b in inside):
            out.append((lang, " ".join(w), a, f[lang, w[:j]], f[lang, w[j:]], n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(x[0], i, *x[1:]) for i, x in enumerate(own, 1)]
    return sorted(ranked)


def found(df, **more):
    return sorted(tuple(r) for r in collocations(df, slots=more.pop("slots", 1 << 16), **more).collect())


def made(seed=4):
    """Texts of a small vocabulary in three languages, fixed phrases, repeats and overlaps."""
    r, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(9)] + ["É", "日本", "a-b", "it's", "\x0045"]
    for i in range(260):
        w = [r.choice(vocabulary[:4] if r.random() < 0.9 else vocabulary) for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(0, 3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(["New York City hall", "new york", "ha ha ha ha ha", "of the , people", "x.y z"]).split(" ")
        rows.append((i, r.choice([" ", "  ", "\t"]).join(w) + r.choice(["", ".", "\n"]), r.choice(["en", "de", None, "und"]), "s", 1))
    return rows


def test_tokens_and_pieces():
    texts = ["", "a", " A b", "a.b c", "a,", ",a b", "É x\ny", "a\x0bb", "x\x1cy z", "..", "a  b\t c"]
    flat, number, new = tokens(pa.array(texts))
    want = [[w for w in pieces(t)] for t in texts]
    assert flat.to_pylist() == [w for t in want for p in t for w in p]
    assert number.tolist() == [sum(map(len, t)) for t in want]
    assert new.tolist() == [i == 0 for t in want for p in t for i in range(len(p))]


def test_equals_plain_counts_for_any_shards_and_tables(spark):
    rows = made() + ROWS
    df, want = clashing(docs(spark, rows)), plain(rows)
    assert len(want) > 30 and {len(x[2].split(" ")) for x in want} == {2, 3, 4}
    assert found(df, cycle=1) == want
    assert found(df.repartition(5), chunk=300, cycle=3, top=5) == [x for x in want if x[1] <= 5]
    assert found(df, chunk=500, cycle=2, slots=64) == want  # slots are shared: activated too early, counted all the same


def test_given_documents(spark):
    rows = sample("sf0.001")
    assert found(docs(spark, rows), chunk=5_000, cycle=2, least=10) == plain(rows, 10)


def test_every_frequent_phrase_is_counted_whole(spark):
    rows = made(9)
    f, n = counts(rows)
    phrases, totals = frequent_phrases(docs(spark, rows), least=5, chunk=200, cycle=3, slots=1 << 12)
    assert {(r.lang, r.phrase): r.a for r in phrases.collect()} == {(lang, " ".join(w)): a for (lang, w), a in f.items() if a >= 5}
    assert {r.lang: r.n for r in totals.collect()} == dict(n)


def test_ties_empty_tables_and_long_texts(spark):
    assert found(docs(spark, []), cycle=1) == []
    assert found(docs(spark, [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b", "en", "s", 1)]), cycle=1) == []
    rows = [(i, "b a. c a", "en", "s", 1) for i in range(30)] + [(99, "x y " * 50_000, None, "s", 1)]
    assert found(docs(spark, rows), chunk=64, cycle=2) == plain(rows)
