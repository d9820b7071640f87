"""Exact, near and line dedup against plain versions."""

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import ROWS, clashing, docs, low, plain_words, sample

from starloom.llm.components import components
from starloom.llm.exact_dedup import exact_groups
from starloom.llm.line_dedup import dedup_lines
from starloom.llm.simhash import _near, covering_masks, fingerprints, near_groups, near_links


def test_exact_groups(spark):
    rows = ROWS + [(100 + i, "A hot text" if i % 2 else "a HOT text", "en", "h", 1) for i in range(300)]
    for df in (docs(spark, rows), clashing(docs(spark, rows))):
        got = exact_groups(df).collect()
        groups = defaultdict(list)
        for r in rows:
            groups[low(r[1])].append(r[0])
        want = []
        for text, ids in groups.items():
            named = [i for i in ids if i is not None]
            best = max(named) if named else None
            want += [(i, best, len(ids), i == best, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    least = {r.doc_id: r.keep_id for r in exact_groups(docs(spark, rows), keep="smallest").collect()}
    assert least[399] == 100 and least[9] == 1
    assert exact_groups(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        exact_groups(docs(spark), keep="any")


def simhash(text):
    w = plain_words(text)
    parts = [" ".join(w[j: j + 3]) for j in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(parts))


def plain_components(prints, ids):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, x in enumerate(ids):
        least[root(i)] += [x] if x is not None else []
    return [min(least[root(i)], default=None) for i in range(len(prints))]


def test_near_groups(spark):
    rows = ROWS + [(1000 + r[0], *r[1:]) for r in sample()[:150]]
    prints = [simhash(r[1]) for r in rows]
    want = list(zip([r[0] for r in rows], (f"{p:016x}" for p in prints), plain_components(prints, [r[0] for r in rows])))
    got = near_groups(clashing(docs(spark, rows))).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert near_groups(docs(spark, [])).count() == 0


def test_long_text_counts_every_shingle():
    text = " ".join(f"w{i % 977}" for i in range(130_000))
    assert int(fingerprints(pa.array([text, None, "a b"]))[0]) == simhash(text)


def test_masks_cover_every_near_pair():
    for within in ((1 << 64) - 1, 0x0FF0F0F00FF00F0F, 0b1011):
        masks = covering_masks(3, within)
        places = [i for i in range(64) if within >> i & 1]
        rng = np.random.default_rng(1)
        for _ in range(500):
            flips = sum(1 << int(p) for p in rng.choice(places, min(3, len(places)), replace=False))
            assert any(m & flips == 0 for m in masks)
        assert all(m & ~within == 0 for m in masks)


def closure(pairs, values):
    at = {v: v for v in values}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in pairs:
        at[root(a)] = root(b)
    return {frozenset(x for x in values if root(x) == root(y)) for y in values}


@pytest.mark.parametrize("bucket", [8, 16_384])
def test_split_buckets_lose_no_link(spark, bucket):
    rng = np.random.default_rng(4)
    base = int(rng.integers(1 << 62))
    values = sorted({base ^ sum(1 << int(i) for i in rng.choice(63, rng.integers(0, 5), replace=False)) for _ in range(150)} | set(map(int, rng.integers(0, 1 << 62, 50))))
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    got = closure([(r.a, r.b) for r in near_links(df, bucket=bucket).collect()], values)
    assert got == closure([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3], values)


def test_large_bucket_gives_a_forest():
    values = np.arange(3000, dtype=np.uint64)
    pairs = _near(values, np.zeros(3000, np.int64), 3)
    assert len(pairs) == 2999


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_lines(rows):
    """Every later window of three lines, or of fewer with over fifty words, loses its lines."""
    order = sorted({(r[0] if r[0] is not None else -(1 << 63), r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0],))
    seen, out = set(), {}
    for i, text in order:
        lines, drop = text.split("\n"), set()
        for at in range(len(lines)):
            take = next((k for k in (1, 2) if sum(x.count(" ") + 1 for x in lines[at: at + k]) > 50), 3)
            if at + take > len(lines):
                continue
            key = tuple(lines[at: at + take])
            if key in seen:
                drop |= set(range(at, at + take))
            seen.add(key)
        out[i, text] = ("\n".join(x for k, x in enumerate(lines) if k not in drop), len(lines), len(drop))
    return out


def test_dedup_lines(spark):
    long = " ".join(f"w{i}" for i in range(60))
    extra = [(20, "a\nb\nc\nd", "", "", 1), (21, "x\na\nb\nc\ny", "", "", 1), (22, "b\nc\nd\nb\nc\nd", "", "", 1), (23, "s\ns\ns\ns\ns", "", "", 1),
             (24, f"head\n{long}\ntail", "", "", 1), (25, f"other\n{long}", "", "", 1), (26, "a\nb", "", "", 1), (27, "a\nb", "", "", 1), (28, "\n\n\n", "", "", 1),
             (29, f"one\n{long}\n{long} x\n{long}", "", "", 1), (30, f"two\n{long}\n{long} x\n{long}\nend", "", "", 1)]
    extra += [(31, "r1\nr2\nr3\na\nb\nc", "", "", 1)] * 2 + [(31, "r1\nr2\nr3\nother", "", "", 1)]  # one text held by two rows, and another text of its id
    rows = ROWS + extra
    want = plain_lines(rows)
    for df in (docs(spark, rows), clashing(docs(spark, rows))):
        out = dedup_lines(df)
        got = out.collect()
        assert out.columns == [*df.columns, "_lines", "_removed"] and len(got) == len(rows)
    by_id = {r.doc_id: (r.text, r._lines, r._removed) for r in got}
    for (i, text), result in want.items():
        if i > -(1 << 62) and i != 31:
            assert by_id[i] == result, i
    # a line of over fifty words is a window of its own
    assert by_id[24][2] == 0 and by_id[25] == ("other", 2, 1) and by_id[30] == ("two\nend", 5, 3)
    # of the two texts of id 31 one comes first and keeps the lines that they share; both hold lines of id 20 besides
    twice = sorted((r.text, r._removed) for r in got if r.doc_id == 31)
    assert twice in ([("other", 3), ("r1\nr2\nr3", 3), ("r1\nr2\nr3", 3)], [("", 6), ("", 6), ("r1\nr2\nr3\nother", 0)])
    assert by_id[3] == (None, 0, 0) and by_id[4] == ("", 1, 0)
    assert dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_runs_no_python(spark):
    plan = dedup_lines(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
