"""Fill-in-middle: texts are cut at drawn units, which a Fenwick tree over blocks finds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import doc_columns, mapped, raw, slices

BLOCK = 4096  # bytes of text per leaf of a tree
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100 draws: plain from here on; of 100 others: suffix first below this
#: 1 for A-Z and a-z.
_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() for b in range(256)], bool)


class BlockTree:
    """Fenwick trees over blocks of ``BLOCK`` bytes, one per text of a column, for units and for code points.

    A unit is a run of ASCII letters or any other single code point. Node i of
    a text's tree sums the blocks after ``i - lowbit(i)`` up to ``i``; all trees
    lie end to end, ``base`` says where each begins.
    """

    def __init__(self, texts: pa.Array, block: int = BLOCK):
        self.block = block
        self.offsets, self.data = raw(texts)
        chars, at = np.frombuffer(self.data, np.uint8), self.offsets.astype(np.int64)
        self.length = np.diff(at)
        self.point = (chars & 0xC0) != 0x80
        letter = _LETTER[chars]
        self.unit = self.point.copy()
        self.unit[1:] &= ~(letter[1:] & letter[:-1])
        heads = at[:-1][self.length > 0]
        self.unit[heads] = self.point[heads]  # a text's first letter does not go on from the text before
        self.blocks = -(-self.length // block)
        self.base = np.cumsum(self.blocks) - self.blocks
        row = np.repeat(np.arange(len(self.length)), self.blocks)
        node = np.arange(len(row)) - self.base[row] + 1
        begin = at[row] + (node - 1) * block
        low = node & -node
        self.units, self.points = (self._tree(mask, begin, low) for mask in (self.unit, self.point))

    @staticmethod
    def _tree(mask: np.ndarray, begin: np.ndarray, low: np.ndarray) -> np.ndarray:
        each = np.add.reduceat(mask, begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(each)])
        at = np.arange(1, len(each) + 1)
        return total[at] - total[at - low]

    def count(self) -> np.ndarray:
        """Units of each text: the nodes on the way from its last block to the root."""
        total, node = np.zeros(len(self.blocks), np.int64), self.blocks.copy()
        while (open_ := node > 0).any():
            total[open_] += self.units[(self.base + node - 1)[open_]]
            node = np.where(open_, node & (node - 1), 0)
        return total

    def cut(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte in the text after its first ``k`` units, and the code points before it.

        The descent takes a node's blocks whenever they hold no more units than
        are left, from the largest power of two down; what is left then lies in
        one block, which is searched as it is.
        """
        at, left, points = np.zeros(len(k), np.int64), k.astype(np.int64).copy(), np.zeros(len(k), np.int64)
        step = 1 << max(0, int(self.blocks.max(initial=0)).bit_length() - 1)
        while step:
            node = self.base + at + step - 1
            inside = at + step <= self.blocks
            node[~inside] = 0
            take = inside & (self.units[node] <= left) if len(self.units) else inside
            left[take] -= self.units[node[take]]
            points[take] += self.points[node[take]]
            at[take] += step
            step >>= 1
        place = np.minimum(at * self.block, self.length)
        for i in np.flatnonzero(at < self.blocks).tolist():
            a = int(self.offsets[i] + place[i])
            inner = int(np.flatnonzero(self.unit[a: min(a + self.block, int(self.offsets[i + 1]))])[left[i]])
            points[i] += np.count_nonzero(self.point[a: a + inner])
            place[i] += inner
        return place, points


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit draws of an id: the first hex groups of the sha256 of ``seed:id``; a missing id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """Every whole text as prefix, suffix and middle, in one of two orders, or plain.

    A text of n units (runs of A-Z and a-z, or any other single code point) is
    cut after two drawn numbers of units from 0 to n. ``form`` is ``psm``
    (``<P>`` prefix ``<S>`` suffix ``<M>`` middle), ``spm`` (suffix before
    prefix) or ``plain`` (the text as it is: one draw in ten, empty texts, and
    texts that hold a mark already).

    Returns a row per input row: ``doc_id, n, form, prefix_chars, middle_chars``
    (code points, NULL if plain) and ``output``. NULL text counts as empty, a
    missing id draws like an empty one, repeated rows each get a row, an empty
    table gives none. No text is shortened, and one of any length takes its own
    bytes and a small multiple of them in memory.
    """
    rows = doc_columns(docs, text_col, id_col)
    rows = rows.select("doc_id", "text", *(h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed), 1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tree = BlockTree(batch.column("text"))
            h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in range(1, 5))
            n = tree.count()
            (first, prefix), (second, both) = (tree.cut(k) for k in np.sort([h1 % (n + 1), h2 % (n + 1)], axis=0))
            at, out, form = tree.offsets.tolist(), [], []
            for i, (a, b, plain, spm) in enumerate(zip(first.tolist(), second.tolist(), (h3 % 100 >= PLAIN_FROM).tolist(), (h4 % 100 < SPM_BELOW).tolist())):
                text = tree.data[at[i]: at[i + 1]]
                if plain or not text or any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                    out.append(text)
                    form.append("plain")
                    continue
                p, s, m = PREFIX.encode() + text[:a], SUFFIX.encode() + text[b:], MIDDLE.encode() + text[a:b]
                out.append(s + p + m if spm else p + s + m)
                form.append("spm" if spm else "psm")
            bare = np.array([f == "plain" for f in form])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(form, pa.string()), pa.array(prefix, mask=bare), pa.array(both - prefix, mask=bare),
                 pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return mapped(rows, work, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. No part holds a mark, and marks cannot overlap, so the three are found by splitting."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
