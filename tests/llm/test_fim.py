"""Fill-in-middle against a plain cut of unit lists."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from helpers import ROWS, clashing, docs, sample

from starloom.llm import fim
from starloom.llm.fim import BlockTree, fill_in_middle, restored


def plain(doc_id, text):
    text = text or ""
    unit = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    assert "".join(unit) == text
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i: 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(unit) + 1), h[1] % (len(unit) + 1)))
    p, m, s = "".join(unit[:a]), "".join(unit[a:b]), "".join(unit[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(unit), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, len(unit), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_tree_finds_every_unit_at_any_block_size():
    r = random.Random(2)
    texts = ["", "a", "é", "ab", "a b", "日本語 text", "x" * 100, "1234567890" * 9, "aé" * 40]
    texts += ["".join(r.choice("abcXYZ 0é日\n𝄞") for _ in range(r.randrange(1, 300))) for _ in range(40)]
    for block in (1, 2, 3, 7, 16, 64, 4096):
        tree = BlockTree(pa.array(texts), block)
        units = [re.findall("[A-Za-z]+|[^A-Za-z]", t) for t in texts]
        assert tree.count().tolist() == [len(u) for u in units]
        for _ in range(5):
            k = np.array([r.randrange(len(u) + 1) for u in units])
            place, points = tree.cut(k)
            lead = ["".join(u[:n]) for u, n in zip(units, k.tolist())]
            assert place.tolist() == [len(x.encode()) for x in lead] and points.tolist() == [len(x) for x in lead]


def test_all_rows_and_texts(spark):
    long = [(77, "word é, " * 60_000, "en", "s", 1), (78, "x" * 100_000, "en", "s", 1), (79, "𝄞" * 9_000 + "ab", "en", "s", 1)]
    marked = [(90 + i, t, "en", "s", 1) for i, t in enumerate(["a <P> b", "<S>", "c<M>", "< P>", "<P", "P>", "ab<", ">", "<<P", "<M<S"] * 3)]
    rows = ROWS + long + marked + [(1000 + x[0], *x[1:]) for x in sample()]
    got = fill_in_middle(clashing(docs(spark, rows)))
    got = got.withColumn("back", restored(got["output"], got["form"])).collect()
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(str(plain(r[0], r[1])) for r in rows)
    assert sorted((str(r.doc_id), r.back) for r in got) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert {r.form for r in got} == {"psm", "spm", "plain"}
    assert fill_in_middle(docs(spark, [])).count() == 0


def test_blocks_do_not_change_the_cut(spark, monkeypatch):
    texts = pa.array([r[1] or "" for r in sample()[:50]])
    want = BlockTree(texts).cut(np.full(50, 20))
    monkeypatch.setattr(fim, "BLOCK", 64)
    got = BlockTree(texts, 64).cut(np.full(50, 20))
    assert all((a == b).all() for a, b in zip(want, got))
