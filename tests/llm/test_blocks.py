"""Blocks of pages that leave out end tags."""

import time
import zlib

import numpy as np

from starloom.llm import html_text
from starloom.llm.page_blocks import blocks
from starloom.llm.page_samples import Maker


def texts(html):
    return [b.text for b in blocks(html)]


def test_head_without_its_end_tag():
    page = "<html><head><meta charset=utf-8><title>x</title><style>p</style><script>1</script>{}<article><p>whole article</p><p>more</p></article></body></html>"
    for between in ("<body>", "", "</head><body>", "</head>", "<noscript><img src=a></noscript><link href=b>", "<noscript><style>a</style><body>"):
        assert texts(page.format(between)) == ["whole article", "more"], between
    assert texts("<head><title>a <b> c</title><body>d") == ["d"] and texts("<head><title>a</title> words <p>d") == ["words", "d"]
    assert texts("<head>") == [] and texts("<head><title>a</title></head>") == [] and texts("<header>a</header>") == ["a"]


def test_hidden_parts_end_with_their_parent():
    for name in ("object", "noscript", "svg"):
        assert texts(f"<div><div>a<{name}>x</div><p>b</p></div>") == ["a", "b"], name
        assert texts(f"<p>a <{name}><g>x</g></{name}> b</p>c") == ["a b", "c"], name
        assert texts(f"<p>a <{name}/> b</p>") == ["a b"], name
    assert texts("<p>a <noscript><p>x</p><ul><li>y<li>z</ul></noscript> b</p>") == ["a b"]
    assert texts("<article><svg><path d='m'><p>whole</p><p>article</p></article>") == ["whole", "article"]
    assert [b.path for b in blocks("<p>a <svg><g>x</g></p>")] == [("p",)]
    assert [b.linked for b in blocks("<p><a>k<svg><a>x</a></svg></a> b</p>")] == [1]


def test_every_word_of_a_class_marks_the_block():
    names = [chr(97 + i) * 3 for i in range(20)] + ["sidebar"]
    assert blocks(f'<div class="{" ".join(names)}">x</div>')[0].path == ("div", *(f".{n}" for n in names))


def test_many_open_elements_cost_no_more_each():
    """50,000 elements that are never closed, with text in each, and a page of 20 MB."""
    html = "".join(f'<div class="level{i % 7}">t{i}' for i in range(50_000))
    at = time.perf_counter()
    found = blocks(html)
    took = time.perf_counter() - at
    assert len(found) == 50_000 and found[3].path == ("div", ".level") * 4 and len(found[-1].path) == 100_000
    assert found[-1].last_marks(3) == [".level", "div", ".level"] and took < 20
    nested = html_text.describe(found, html_text.Buckets())[0]
    assert nested.number()[-1] == 100_003
    long = "<article>" + "<p>some words of a long page</p>" * 650_000
    assert len(long) > 20_000_000 and len(blocks(long)) == 650_000


def test_pooled_paths_equal_plain_means():
    maker, rng = Maker(5), np.random.default_rng(0)
    table, pages = rng.normal(size=(html_text.MARKS, 4)), [blocks(maker.page()[0]) for _ in range(5)] + [blocks("bare <p>x"), blocks("<div>" * 30 + "deep")]
    own = [html_text.describe(p, html_text.Buckets())[0] for p in pages]
    code = lambda m: zlib.crc32(m.encode()) % html_text.MARKS
    marks = [[*map(code, b.path), *(code(f"^{m}") for m in b.path[-3:])] or [0] for p in pages for b in p]
    paths = html_text.Paths.joined(own)
    assert np.allclose(paths.means(table), [table[m].mean(0) for m in marks])
    d, want = rng.normal(size=(len(marks), 4)), np.zeros_like(table)
    for m, x in zip(marks, d):
        np.add.at(want, m, x / len(m))
    assert np.allclose(paths.gradient(table, d), want)


def test_end_of_a_body_that_never_began():
    assert texts("<head></body>x") == ["x"] and texts("<head><title>a</html><p>b") == ["b"] and texts("</body></p></li>x") == ["x"]


def test_tables_against_a_plain_reader():
    """The given pages: no block holds markup, and all words outside hidden elements are there."""
    import duckdb
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.words, self.hidden = [], 0

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style", "head", "template", "noscript", "svg", "iframe", "textarea")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style", "head", "template", "noscript", "svg", "iframe", "textarea")

        def handle_data(self, data):
            if not self.hidden:
                self.words += data.split()

    for (html,) in duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall():
        reader = Reader()
        reader.feed(html or "")
        assert "".join(w for b in blocks(html or "") for w in b.text.split()) == "".join(reader.words)
