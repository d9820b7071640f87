"""HTML extraction: a recurrent network labels every block of a page with the whole page in view."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.page_blocks import Block, blocks
from starloom.llm.page_samples import Maker
from starloom.llm.shared import mapped, slices

MARKS, WORDS, WIDTH, HIDDEN, PLAIN = 1024, 1024, 12, 20, 10
TRAIN_PAGES, EPOCHS, RATE = 2400, 8, 0.01
ROOM = 65_536  # steps times pages that one run of the network holds

Weights = dict[str, np.ndarray]


def _hash(token: str, size: int) -> int:
    return zlib.crc32(token.encode()) % size


class Buckets(dict):
    """Buckets of words seen before; emptied when it gets large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = found = _hash(word, WORDS)
        return found


@dataclass
class Paths:
    """Tag paths of one or more pages as trees: every element's marks are held once, whatever lies below it."""

    parent: np.ndarray  # of each element; a page's first one is its own
    depth: np.ndarray
    marks: np.ndarray  # buckets, element after element
    owner: np.ndarray  # element of each mark
    element: np.ndarray  # of each block
    tail: np.ndarray  # buckets of the last marks of each block's path, block after block
    block: np.ndarray  # block of each of those

    @staticmethod
    def joined(pages: list[Paths]) -> Paths:
        elements, blocks_ = np.cumsum([0, *(len(p.parent) for p in pages)]), np.cumsum([0, *(len(p.element) for p in pages)])
        put = lambda name, by=None: np.concatenate([getattr(p, name) + (by[i] if by is not None else 0) for i, p in enumerate(pages)])
        return Paths(put("parent", elements), put("depth"), put("marks"), put("owner", elements), put("element", elements), put("tail"), put("block", blocks_))

    def levels(self) -> list[np.ndarray]:
        """Elements below the page, by depth."""
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(1, int(self.depth.max(initial=0)) + 2))
        return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def number(self) -> np.ndarray:
        """Marks that are pooled for each block."""
        total = np.bincount(self.owner, minlength=len(self.parent))
        for own in self.levels():
            total[own] += total[self.parent[own]]
        return total[self.element] + np.bincount(self.block, minlength=len(self.element))

    def means(self, table: np.ndarray) -> np.ndarray:
        """Mean vector of the marks of each block's path and of its last marks: sums go down the trees level by level."""
        total = np.zeros((len(self.parent), table.shape[1]), table.dtype)
        np.add.at(total, self.owner, table[self.marks])
        for own in self.levels():
            total[own] += total[self.parent[own]]
        out = total[self.element]
        np.add.at(out, self.block, table[self.tail])
        return out / self.number()[:, None].astype(table.dtype)

    def gradient(self, table: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Gradient of ``means`` with respect to the table: sums go up the trees."""
        out, each = np.zeros_like(table), d / self.number()[:, None]
        up = np.zeros((len(self.parent), table.shape[1]))
        np.add.at(up, self.element, each)
        for own in reversed(self.levels()):
            np.add.at(up, self.parent[own], up[own])
        np.add.at(out, self.marks, up[self.owner])
        np.add.at(out, self.tail, each[self.block])
        return out


def describe(found: list[Block], bucket: Buckets) -> tuple[Paths, list[np.ndarray], np.ndarray]:
    """The blocks' tag paths, and per block the buckets of its distinct words and plain numbers."""
    page, bags, plain = found[0].page, [], np.zeros((len(found), PLAIN))
    hashed: dict[str, int] = {}

    def coded(mark: str) -> int:
        if mark not in hashed:
            hashed[mark] = _hash(mark, MARKS)
        return hashed[mark]

    # a block outside every element has one mark of its own
    tails = [[coded(f"^{m}") for m in b.last_marks(3)] or [0] for b in found]
    number = np.array([len(m) for m in page.marks])
    paths = Paths(
        np.array(page.parent, np.int64), np.array(page.depth, np.int64), np.array([coded(m) for marks in page.marks for m in marks], np.int64),
        np.repeat(np.arange(len(number)), number), np.array([b.element for b in found], np.int64), np.array([m for t in tails for m in t], np.int64),
        np.repeat(np.arange(len(tails)), [len(t) for t in tails]))
    for i, b in enumerate(found):
        word, data = b.text.lower().split(), b.text.encode()
        bags.append(np.array([bucket[w] for w in set(word)], np.int64))
        n, size = len(b.text), len(data)
        tag = page.marks[b.element][0] if b.element else ""
        share = [1 - len(data.translate(None, kind)) / size for kind in (b".,;:!?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")]
        plain[i] = (
            np.log1p(n) / 5, np.log1p(len(word)) / 4, min(1, b.linked / n), share[0] * 10, share[1], share[2], i / len(found), page.depth[b.element] / 10,
            float(tag[:1] == "h" and tag[1:].isdigit()), b.text[-1] in ".!?")
    return paths, bags, plain


def start_weights(seed: int = 3) -> Weights:
    rng = np.random.default_rng(seed)
    n_in = 2 * WIDTH + PLAIN
    w = {"marks": rng.normal(0, 0.3, (MARKS, WIDTH)), "words": rng.normal(0, 0.3, (WORDS, WIDTH)), "out": rng.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)}
    for side in "fb":
        w["x" + side] = rng.normal(0, n_in**-0.5, (n_in, 4 * HIDDEN))
        w["h" + side] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        w["b" + side] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])  # an open forget gate to begin with
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _mean(table: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    at = np.cumsum([0, *map(len, sets)])
    return np.add.reduceat(table[np.concatenate(sets)], at[:-1], axis=0) / np.diff(at)[:, None]


def _run(x: np.ndarray, live: np.ndarray, w: Weights, side: str, keep: list | None) -> np.ndarray:
    """One direction of the LSTM over (time, pages, inputs); pages that have ended hold their state."""
    steps, pages, _ = x.shape
    h, c, out = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)), np.zeros((steps, pages, HIDDEN))
    from_x = x @ w["x" + side] + w["b" + side]
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = from_x[t] + h @ w["h" + side]
        f, i, o = (_sigmoid(z[:, k * HIDDEN: (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        on = live[t][:, None]
        c_new = np.where(on, f * c + i * g, c)
        h_new = np.where(on, o * np.tanh(c_new), h)
        if keep is not None:
            keep.append((t, f, i, o, g, c, c_new, h))
        h, c = h_new, c_new
        out[t] = h
    return out


def _back(x: np.ndarray, live: np.ndarray, w: Weights, side: str, keep: list, d_out: np.ndarray, grad: Weights) -> np.ndarray:
    """Gradients of one direction by going back through its steps."""
    dh, dc, dx = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:]), np.zeros_like(x)
    for t, f, i, o, g, c, c_new, h in reversed(keep):
        on = live[t][:, None]
        total = (dh + d_out[t]) * on
        tanh_c = np.tanh(c_new)
        d_cell = (dc + total * o * (1 - tanh_c**2)) * on
        dz = np.concatenate([d_cell * c * f * (1 - f), d_cell * g * i * (1 - i), total * tanh_c * o * (1 - o), d_cell * i * (1 - g**2)], 1)
        grad["x" + side] += x[t].T @ dz
        grad["h" + side] += h.T @ dz
        grad["b" + side] += dz.sum(0)
        dx[t] = dz @ w["x" + side].T
        dh = np.where(on, dz @ w["h" + side].T, dh + d_out[t])
        dc = np.where(on, d_cell * f, dc)
    return dx


def _inputs(pages: list[tuple], w: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p[2]) for p in pages])
    flat = np.concatenate([Paths.joined([p[0] for p in pages]).means(w["marks"]), _mean(w["words"], [b for p in pages for b in p[1]]), np.concatenate([p[2] for p in pages])], 1)
    page = np.repeat(np.arange(len(pages)), lengths)
    step = np.arange(len(page)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    x = np.zeros((lengths.max(), len(pages), flat.shape[1]))
    x[step, page] = flat
    return x, np.arange(lengths.max())[:, None] < lengths[None, :], step, page


def predict(pages: list[tuple], w: Weights) -> np.ndarray:
    """Probability of being main text for all blocks of the pages, page after page."""
    x, live, step, page = _inputs(pages, w)
    h = np.concatenate([_run(x, live, w, "f", None), _run(x, live, w, "b", None)], 2)
    return _sigmoid(h[step, page] @ w["out"] + w["bias"])


@lru_cache(maxsize=4)
def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 1) -> Weights:
    """Fit the network to made-up pages; their number is a parameter, and no table's size changes it. A process trains once."""
    maker, samples, bucket = Maker(seed), [], Buckets()
    for _ in range(pages):
        html, text = maker.page()
        found = blocks(html)
        main = set(text.split("\n"))
        if found:
            samples.append((*describe(found, bucket), np.array([float(b.text in main) for b in found])))
    samples.sort(key=lambda s: len(s[3]))
    w = start_weights()
    m, v, rng, step_no = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, np.random.default_rng(2), 0
    parts = [samples[i: i + 32] for i in range(0, len(samples), 32)]
    for epoch in range(epochs):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for k in rng.permutation(len(parts)):
            part = parts[k]
            x, live, step, page = _inputs(part, w)
            kept: dict[str, list] = {"f": [], "b": []}
            h = np.concatenate([_run(x, live, w, s, kept[s]) for s in "fb"], 2)
            y = np.concatenate([s[3] for s in part])
            top = h[step, page]
            e = (_sigmoid(top @ w["out"] + w["bias"]) - y) / len(part)
            grad = {key: np.zeros_like(a) for key, a in w.items()}
            grad["out"], grad["bias"] = top.T @ e, np.array([e.sum()])
            dh = np.zeros_like(h)
            dh[step, page] = np.outer(e, w["out"])
            dx = _back(x, live, w, "f", kept["f"], dh[:, :, :HIDDEN], grad) + _back(x, live, w, "b", kept["b"], dh[:, :, HIDDEN:], grad)
            flat = dx[step, page]
            grad["marks"] = Paths.joined([p[0] for p in part]).gradient(w["marks"], flat[:, :WIDTH])
            sets = [s for p in part for s in p[1]]
            size = np.array([len(s) for s in sets])
            np.add.at(grad["words"], np.concatenate(sets), np.repeat(flat[:, WIDTH: 2 * WIDTH] / size[:, None], size, axis=0))
            norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
            step_no += 1
            for key, g in grad.items():
                g = g * min(1, 5 / (norm + 1e-9))
                m[key] = 0.9 * m[key] + 0.1 * g
                v[key] = 0.999 * v[key] + 0.001 * g * g
                w[key] = w[key] - rate * (m[key] / (1 - 0.9**step_no)) / (np.sqrt(v[key] / (1 - 0.999**step_no)) + 1e-8)
    return w


def extract(pages: list[str], w: Weights, bucket: Buckets, together: int = 64) -> list[str]:
    """Main text of each page: its main blocks in order, one per line."""
    found = [blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, f in enumerate(found) if f), key=lambda i: len(found[i]))
    while order:
        # pages of one run are as long as its longest; a page of very many blocks runs alone
        size = len(found[order[0]])
        upto = next((k for k, i in enumerate(order[1:together], 1) if len(found[i]) * (k + 1) > max(ROOM, size)), min(together, len(order)))
        part, order = order[:upto], order[upto:]
        chance, k = predict([describe(found[i], bucket) for i in part], w), 0
        for i in part:
            out[i] = "\n".join(b.text for b, p in zip(found[i], chance[k: k + len(found[i])]) if p >= 0.5)
            k += len(found[i])
    return out


def main_text(pages: DataFrame, weights: Weights | None = None, html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page; the network is trained unless ``weights`` are given.

    Blocks are runs of text between block-level tags, with character references
    decoded and white space turned into single spaces; scripts, styles and the
    head hold none. NULL html counts as empty and gives an empty text, as does a
    page without main blocks. Rows are independent: repeated pages and missing
    ids each get their row. Other columns are ignored. Time and memory grow with
    the length of a page, however deep its elements are nested; a long page runs
    through the network alone.
    """
    w = {k: a.astype(np.float32) for k, a in (weights or train()).items()}
    model = pages.sparkSession.sparkContext.broadcast(w)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets()
        for batch in slices(batches, "html", 2 << 20):
            text = extract(batch.column("html").to_pylist(), model.value, bucket)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return mapped(rows, work, "page_id long, url string, text string, n_chars long")
