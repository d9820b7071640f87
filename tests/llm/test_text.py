"""Token files, packing, decontamination, extraction and scoring against plain versions."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import ROWS, clashing, docs, low, plain_words, sample

from starloom.llm import html_text, page_blocks, toxicity
from starloom.llm.bpe import Encoder
from starloom.llm.decontaminate import drop_contaminated, find_benchmark
from starloom.llm.lm_score import DISCOUNT, score_documents
from starloom.llm.packing import hilbert_key, pack
from starloom.llm.page_samples import Maker
from starloom.llm.quality import keep_good, score_quality
from starloom.llm.queries import tokenizer
from starloom.llm.token_files import read_metadata, read_tokens, token_file_digest, write_token_files
from starloom.llm.toxicity import score_toxicity
from starloom.llm.trie import Level, Trie, quantise, value

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]


def encoded(name, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer(name))
    return [e.ids + [1] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name,spaces", FILES)
def test_encoder_equals_whole_texts(name, spaces):
    texts = [r[1] for r in ROWS] + ["a  b", " x", "x ", "\t\t", "é x́", "don't  'll\r\nwe've", "a b c", "日本 語", "x" * 5000] + [r[1] for r in sample()[:40]]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "a<|EndOfText|>b c", "<|startoftext|> x", "<|endoftext|", "a < b > c", " <|endoftext|>\n<|endoftext|> ", "é<|endoftext|>é"]
    code = Encoder(tokenizer(name), spaces, 1, room=500)
    for _ in range(2):
        ids, sizes = code(pa.array(texts, pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == encoded(name, texts)


def test_token_files(spark, tmp_path):
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids, start, want = encoded("word_bpe_49k.json", [r[1] for r in rows]), 0, []
    for r, own in zip(rows, ids):
        want.append((r[0], start, len(own), crc(own)))
        start += len(own)
    got = token_file_digest(clashing(docs(spark)), tokenizer("word_bpe_49k.json"), False, 1).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    path = str(tmp_path / "tokens")
    write_token_files(docs(spark), path, tokenizer("word_bpe_49k.json"), False, 1, encoding="delta")
    assert sorted((r.start, r.n_tokens) for r in read_metadata(spark, path).collect()) == sorted((w[1], w[2]) for w in want)
    assert {r.doc_id: r.ids for r in read_tokens(spark, path, 7, 8).collect()} == {r[0]: i for r, i in zip(rows, ids) if r[0] in (7, 8)}
    assert token_file_digest(docs(spark, []), tokenizer("word_bpe_49k.json"), False, 1).count() == 0


def test_hilbert_neighbours_touch():
    side, dims = 8, 3
    points = np.array([(a, b, c) for a in range(side) for b in range(side) for c in range(side)])
    key = hilbert_key(points, 3)
    walk = points[np.argsort(key)]
    assert sorted(key) == list(range(side**dims)) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("length", [64, 2048])
def test_pack(spark, length):
    rows = [r for r in ROWS if r[0] is not None and r[0] != 9] + [(1000 + r[0], *r[1:]) for r in sample()[:60]]
    out = pack(clashing(docs(spark, rows)), tokenizer("byte_bpe_50k.json"), length=length).collect()
    ids = dict(zip([r[0] for r in rows], encoded("byte_bpe_50k.json", [r[1] for r in rows])))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for i, own in ids.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(own) and r.length > 0 and r.ids_crc32 == crc(own[at: at + r.length])
            at += r.length
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length and at & (at - 1) == 0
    repeated = pack(docs(spark), tokenizer("byte_bpe_50k.json")).groupBy("doc_id").count().collect()
    assert {r.doc_id for r in repeated} == {r[0] for r in ROWS}
    assert pack(docs(spark, []), tokenizer("byte_bpe_50k.json")).count() == 0


def plain_hits(text, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        own = words(t)
        n = min(window, len(own))
        for win in {tuple(own[k: k + n]) for k in range(len(own) - n + 1)} if own else ():
            for k in range(len(w) - n + 1):
                if tuple(w[k: k + n]) == win:
                    hit |= set(range(k, k + n))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination(spark, monkeypatch):
    long = " ".join(f"term{i % 37}" for i in range(60))
    items = [(1, long), (2, "Just three words"), (3, None), (4, ""), (5, "..."), (None, "alone"), (12, "just THREE words"), (7, " ".join(["same"] * 30))]
    rows = ROWS + [(50, "x " + long[40:260] + " y, JUST-three words", "", "", 1), (51, "same " * 25, "", "", 1), (52, "alone", "", "", 1), (53, "just three", "", "", 1),
                   (54, "alone " * 3000 + long, "", "", 1)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id")
    want = sorted(str((r[0], *plain_hits(r[1], items))) for r in rows)
    for block in (400_000, 7):  # one block of windows, and many
        monkeypatch.setattr("starloom.llm.decontaminate.BLOCK_ROWS", block)
        got = find_benchmark(clashing(docs(spark, rows)), bench).collect()
        assert sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got) == want
        assert all(sum(s.length for s in r.spans) == r.n_hit for r in got)
    kept = drop_contaminated(clashing(docs(spark, rows)), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if not plain_hits(r[1], items)[1])
    assert find_benchmark(docs(spark), bench.limit(0)).filter("n_hit > 0").count() == 0
    assert find_benchmark(docs(spark, []), bench).count() == 0


def test_levels_and_trie():
    rng = np.random.default_rng(0)
    for n, universe in ((1, 10), (50, 1 << 40), (3000, 1 << 20), (3000, 4000)):
        values = np.sort(rng.integers(0, universe, n))
        level = Level(values, universe)
        ask = np.concatenate([values, rng.integers(0, universe, 500)])
        found = level.find(ask)
        assert all((values[f] == a and (f == 0 or values[f - 1] != a)) if f >= 0 else a not in set(values.tolist()) for f, a in zip(found, ask))
        assert (level.get(np.arange(n)) == values).all()
    pairs = np.unique(np.stack([rng.integers(0, 1 << 44, 40)[rng.integers(0, 40, 500)], rng.integers(0, 1 << 32, 500)], 1), axis=0)
    u, w = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].T
    contexts, kinds = np.unique(u, return_counts=True)
    p, back = rng.random(len(u)), rng.random(len(contexts))
    trie = Trie(contexts, kinds, w, p, back, 44)
    code, b = trie.query(contexts, kinds, w.astype(np.uint32))
    assert (code == quantise(p)).all() and (b == np.repeat(quantise(back), kinds)).all()
    assert np.abs(np.log10(value(code)) - np.log10(np.maximum(p, 1e-9))).max() < 0.02
    # contexts in any order and again, successors that are absent, contexts that are unknown
    ask = [(int(c), int(x)) for c in rng.permutation(contexts) for x in [*w[u == c][:3], 5, (1 << 32) - 1]] + [(3, 7)] + [(int(contexts[0]), int(w[0]))]
    known = dict(zip(zip(u.tolist(), w.tolist()), quantise(p).tolist()))
    code, _ = trie.query(np.array([a for a, _ in ask]), np.ones(len(ask), np.int64), np.array([x for _, x in ask], np.uint32))
    assert code.tolist() == [known.get(a, 0) for a in ask]
    empty = Trie(contexts[:0], kinds[:0], w[:0], p[:0], back[:0], 44)
    assert not empty.query(contexts, kinds, w.astype(np.uint32))[0].any()


def test_language_model(spark):
    rows = [r for r in ROWS if r[0] is not None] + [(1000 + r[0], *r[1:]) for r in sample()[:80]]
    ways = [score_documents(clashing(docs(spark, rows)), chunk=chunk, hot_from=hot_from).collect() for chunk, hot_from in ((3000, 1e9), (10**6, 20.0))]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        ways.append(score_documents(docs(spark, rows)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    # contexts whole, in parts, and in parts by another number of shards: the same scores to the last sum of floats
    told = [sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in way) for way in ways]
    assert told[0] == told[1] == told[2]
    got = ways[1]
    tokens = [(r[0], [*plain_words(r[1]), None]) for r in rows]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count, pair = Counter(), Counter()
    for i, t in tokens:
        if not held(i):
            count.update(t)
            pair.update(zip([0, *t], t))
    n, v, once = sum(count.values()), len(count), sum(c == 1 for c in count.values())
    d = once / (once + 2 * sum(c == 2 for c in count.values()))
    after, kinds = Counter(), Counter()
    for (u, _), c in pair.items():
        after[u] += c
        kinds[u] += 1
    own = defaultdict(list)
    for r in got:
        own[r.doc_id].append(r)
    for i, t in tokens:
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t)
        single = lambda x: (count[x] - d) / n if count[x] else d * v / n
        score = sum(math.log10(max(pair[u, x] - DISCOUNT, 0) / after[u] + DISCOUNT * kinds[u] / after[u] * single(x) if after[u] else single(x)) for u, x in zip([0, *t], t))
        r = own[i].pop()
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(t), sum(count[x] > 0 for x in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert abs(r.score - score) / len(t) < 0.02
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_language_model_without_rows(spark):
    assert score_documents(docs(spark, [])).count() == 0
    odd = score_documents(docs(spark, [(None, None, "", "", 1), (None, "a b a", "", "", 1)])).collect()
    assert sorted(r.n_tokens for r in odd) == [1, 4] and all(math.isfinite(r.score) for r in odd)


@pytest.fixture(scope="module")
def weights():
    return html_text.train(pages=700, epochs=6)


def test_blocks_of_broken_pages():
    texts = lambda h: [b.text for b in page_blocks.blocks(h)]
    assert texts("<p>a &amp; b<p>c<br>d <b>e</b>f</p><!-- x --><script>if (a < b) '</p>'</script><ul><li>1<li>2</ul>tail &lt;&eacute;") == ["a & b", "c d ef", "1", "2", "tail <é"]
    assert texts("") == [] and texts("plain  text\n here") == ["plain text here"] and texts("<div><style>x") == [] and texts("a < b > c") == ["a < b > c"]


def test_extraction(spark, weights):
    maker = Maker(77)
    pages = [maker.page() for _ in range(150)]
    rows = [(i, f"http://x/{i}", html) for i, (html, _) in enumerate(pages)] + [(900, "u", None), (901, None, ""), (None, None, "<nav><a href=x>home</a></nav>"), (0, "again", pages[0][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "2 as n_chars")
    got = html_text.main_text(df, weights).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_url = {r.url: r.text for r in got}
    assert by_url["u"] == "" and by_url["again"] == by_url["http://x/0"]
    assert np.mean([by_url[f"http://x/{i}"] == text for i, (_, text) in enumerate(pages)]) > 0.8
    assert html_text.main_text(df.limit(0), weights).count() == 0


def labelled(spark, column):
    import duckdb

    rows = duckdb.sql(f"select doc_id, {column} from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    rows += [(None, 1), (3, None), (10**9, 0), rows[0], rows[0]]
    return spark.createDataFrame(rows, f"doc_id long, {column} int")


def test_quality(spark):
    texts = sample("sf0.01")
    df = clashing(docs(spark, texts + [(None, None, None, None, None), (-1, "", "", "", 0)]))
    labels = labelled(spark, "quality")
    got = score_quality(df, labels).collect()
    assert len(got) == len(texts) + 2 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = {r.doc_id: r.quality for r in labels.dropna().collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert np.mean([a == b for a, b in held]) > 0.93
    empty = {r.score for r in got if r.doc_id in (None, -1)}
    assert len(empty) == 1
    kept = keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got)
    assert score_quality(docs(spark, []), labels).count() == 0
    assert {r.predicted for r in score_quality(docs(spark), labels.limit(0)).collect()} == {0}
    assert keep_good(docs(spark), labels.limit(0)).count() == len(ROWS)


def test_kinds_are_groups_of_words_that_occur_together():
    rng = np.random.default_rng(3)
    words = {0: range(0, 12), 1: range(12, 24), 2: range(24, 36)}
    truth = rng.permutation([0] * 60 + [1] * 40 + [2] * 25 + [-1] * 5)
    pairs = [(i, f) for i, k in enumerate(truth) if k >= 0 for f in {*rng.choice(words[k], 5, replace=False).tolist(), int(rng.integers(36, 60))}]
    row, feature = np.array(pairs).T
    got = toxicity.kinds_of(row, feature, len(truth), 60)
    assert np.mean(got == truth) > 0.95 and (got[truth < 0] == -1).all()
    assert (toxicity.kinds_of(row[:0], feature[:0], 10, 60) == -1).all() and len(toxicity.kinds_of(row[:0], feature[:0], 0, 0)) == 0


def test_toxicity(spark):
    texts = sample("sf0.01")
    df = clashing(docs(spark, texts + [(None, None, None, None, None), (-1, "", "", "", 0)]))
    labels = labelled(spark, "toxic")
    got = score_toxicity(df, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.dropna().collect()}
    both = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    yes, no = [s for s, t in both if t], [s for s, t in both if not t]
    assert len(got) == len(texts) + 2 and np.mean([a > b for a in yes for b in no]) > 0.8
    assert np.mean([r.toxic for r in got if r.doc_id in truth and not truth[r.doc_id]]) < 0.03
    # the categories are groups of the toxic rows: most toxic texts lean to one of them, clean ones to none
    kinds = [(max(r.kind_1, r.kind_2, r.kind_3), truth[r.doc_id]) for r in got if r.doc_id in truth]
    assert np.mean([k for k, t in kinds if t]) > 10 * np.mean([k for k, t in kinds if not t])
    assert score_toxicity(docs(spark, []), labels).count() == 0
    assert {r.toxic for r in score_toxicity(docs(spark), labels.limit(0)).collect()} == {0}
