"""Benchmark decontamination: multi-pattern search with block shifts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import WORD_TABLE, column_of, doc_columns, drop_staged, mapped, slices, stage, words

WINDOW = 10
BLOCK_ROWS = 400_000  # windows searched for at once: about 40 MB of tables in a task
SEGMENT = 1024  # words of a text walked by one cursor
_R = np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Patterns:
    """Windows of one length as rows of word numbers, with their tables."""

    rows: np.ndarray  # distinct windows
    shift: np.ndarray  # by block: how far a cursor may move
    keys: np.ndarray  # block and window hash, ascending, one per window
    items: list[list[str]]  # of each window

    @property
    def length(self) -> int:
        return self.rows.shape[1]

    def block(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a.astype(np.uint64) * _R + b.astype(np.uint64) * _S) >> np.uint64(64 - _bits(self.shift))).astype(np.int64)

    def hashes(self, columns: list[np.ndarray], block: np.ndarray) -> np.ndarray:
        total = np.zeros(len(block), np.uint64)
        for c in columns:
            total = (total + c.astype(np.uint64)) * _R
            total ^= total >> np.uint64(29)
        bits = np.uint64(_bits(self.shift))
        return (block.astype(np.uint64) << (np.uint64(64) - bits)) | (total >> bits)


def _bits(shift: np.ndarray) -> int:
    return len(shift).bit_length() - 1


def patterns(windows: list[tuple[np.ndarray, list[str]]]) -> Patterns:
    """Shift and hash tables of windows of one length.

    A block is the last two words of a place (one word if windows have only
    one). Its shift is the least distance from an occurrence of the block in any
    window to that window's end; blocks in no window let a cursor pass them
    entirely.
    """
    rows = np.array([w for w, _ in windows], np.int64)
    n = rows.shape[1]
    bits = min(22, max(12, (rows.size * 4).bit_length()))
    p = Patterns(rows, np.full(1 << bits, max(1, n - 1), np.uint16), np.zeros(0, np.uint64), [i for _, i in windows])
    for end in range(1 if n > 1 else 0, n):
        block = p.block(rows[:, end - 1] if n > 1 else rows[:, end], rows[:, end])
        np.minimum.at(p.shift, block, n - 1 - end)
    keys = p.hashes(list(rows.T), block)
    order = np.argsort(keys, kind="stable")
    return Patterns(rows[order], p.shift, keys[order], [p.items[i] for i in order])


def search(ids: np.ndarray, lengths: np.ndarray, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all occurrences in texts laid end to end, and which window occurs there.

    A cursor per segment of a text reads the block below it and jumps by its
    shift; all cursors move together. Where the shift is zero the suffix bucket
    is searched by window hash, and what it yields is compared word by word.
    """
    n = p.length
    offset = np.cumsum(lengths) - lengths
    ends = np.maximum(lengths - n + 1, 0)
    count = -(-ends // SEGMENT)
    row = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = offset[row] + n - 1 + nth * SEGMENT
    stop = np.minimum(at + SEGMENT, (offset + lengths)[row])
    places, blocks = [], []
    while len(at):
        block = p.block(ids[at - 1] if n > 1 else ids[at], ids[at])
        step = p.shift[block].astype(np.int64)
        zero = step == 0
        if zero.any():
            places.append(at[zero])
            blocks.append(block[zero])
        at = at + np.maximum(step, 1)
        on = at < stop
        at, stop = at[on], stop[on]
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, block = np.concatenate(places), np.concatenate(blocks)
    key = p.hashes([ids[place - n + 1 + j] for j in range(n)], block)
    low, high = np.searchsorted(p.keys, key, "left"), np.searchsorted(p.keys, key, "right")
    found, which = [], []
    while (more := low < high).any():
        place, low, high = place[more], low[more], high[more]
        same = np.ones(len(place), bool)
        for j in range(n):
            same &= ids[place - n + 1 + j] == p.rows[low, j]
        found.append(place[same])
        which.append(low[same])
        low = low + 1
    return np.concatenate(found) if found else place[:0], np.concatenate(which) if which else place[:0]


def item_windows(benchmark: DataFrame, text_col: str, item_col: str, window: int) -> DataFrame:
    """Each item's windows of words, joined by spaces; a shorter item is one window, one without words none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, counts = words(batch.column("text"), WORD_TABLE)
            flat, at = flat.to_pylist(), 0
            for item, n in zip(batch.column("item").to_pylist(), counts.tolist()):
                own, at = flat[at: at + n], at + n
                made = {" ".join(own[i: i + window]) for i in range(max(1, n - window + 1))} if n else set()
                yield pa.RecordBatch.from_arrays([pa.array(sorted(made), pa.string()), pa.array([item] * len(made), pa.string())], names=["window", "item"])

    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return mapped(rows, cut, "window string, item string").distinct()


def _blocks(benchmark: DataFrame, text_col: str, item_col: str, window: int) -> tuple[DataFrame, int]:
    """The windows, written once, and the number of blocks of ``BLOCK_ROWS`` rows or so that they make."""
    rows = stage(item_windows(benchmark, text_col, item_col, window), "benchmark")
    return rows, max(1, -(-rows.count() // BLOCK_ROWS))


def _block(rows: DataFrame, k: int, n: int) -> list[tuple[str, str]]:
    """One block: all items of a window lie in one. It is the most that the driver and a worker hold at once."""
    part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == k)
    return [tuple(r) for r in part.collect()]


def _tables(rows: list[tuple[str, str]]) -> tuple[pa.Array, list[Patterns]]:
    items: dict[str, list[str]] = {}
    for window, item in rows:
        items.setdefault(window, []).append(item)
    vocabulary = sorted({w for text in items for w in text.split(" ")})
    number = {w: i for i, w in enumerate(vocabulary)}
    by_length: dict[int, list] = {}
    for text, of in sorted(items.items()):
        coded = np.array([number[w] for w in text.split(" ")], np.int64)
        by_length.setdefault(len(coded), []).append((coded, of))
    return pa.array(vocabulary, pa.string()), [patterns(w) for w in by_length.values()]


FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<first:long,length:long>>"


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id",
                   item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Where benchmark windows occur in documents.

    Words are runs of 0-9, letters and whatever is outside ASCII, with A-Z
    lower-cased; a window is ``window`` consecutive words of an item, or all of
    a shorter one. Windows are searched for in blocks of bounded size, all
    documents against each block; neither the driver nor a worker ever holds
    more than one block.

    Returns per row ``doc_id, n_words, n_hit`` (words inside any occurrence),
    ``items`` (ids of occurring items, ascending as strings) and ``spans``
    (merged hit words: first and length). NULL text has no words; an item
    without id counts under the empty id; items with equal ids count once;
    repeated documents each get a row. An empty benchmark hits nothing.
    """
    rows, n = _blocks(benchmark, item_text_col, item_col, window)
    texts = doc_columns(docs, text_col, id_col)
    if n == 1:
        return _scanned(texts, _block(rows, 0, 1)).drop("row")
    # one block after another, each over all texts; what is found is few rows
    numbered = stage(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    parts = [stage(_scanned(numbered, _block(rows, k, n)).filter("n_hit > 0" if k else "true"), "hits") for k in range(n)]
    both = parts[0]
    for part in parts[1:]:
        both = both.union(part)
    joined = both.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("n_hit").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    found = stage(mapped(joined.select("doc_id", "n_words", "n_hit", "items", "spans"), _merged, FOUND), "found")
    drop_staged(rows, numbered, *parts)
    return found


def _scanned(texts: DataFrame, windows: list[tuple[str, str]]) -> DataFrame:
    """One block over all texts; the tables are built once in a task."""
    block = texts.sparkSession.sparkContext.broadcast(windows)
    numbered = "row" in texts.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(block.value)
        for batch in slices(batches, "text"):
            own = _found(batch.column("doc_id"), *_hits(batch.column("text"), tables))
            yield pa.RecordBatch.from_arrays([*own.columns, batch.column("row") if numbered else pa.nulls(batch.num_rows, pa.int64())], names=[*own.schema.names, "row"])

    return mapped(texts, scan, FOUND + ", row long")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of several blocks as one set of merged spans, and the words they hold."""
    for batch in batches:
        hit, spans = [], []
        for own in batch.column("spans").to_pylist():
            merged: list[list[int]] = []
            for first, end in sorted((s["first"], s["first"] + s["length"]) for s in own):
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([first, end])
            hit.append(sum(b - a for a, b in merged))
            spans.append([{"first": a, "length": b - a} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()), batch.column("items"), pa.array(spans, batch.schema.field("spans").type)],
            names=batch.schema.names)


def _hits(texts: pa.Array, tables: tuple[pa.Array, list[Patterns]]) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Words per text, which of all words are hit, and the items found in each text."""
    flat, lengths = words(texts, WORD_TABLE)
    row = np.repeat(np.arange(len(lengths)), lengths)
    cover = np.zeros(len(flat) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(len(lengths))]
    vocabulary, classes = tables
    ids = pc.fill_null(pc.index_in(flat, vocabulary), len(vocabulary)).to_numpy(zero_copy_only=False).astype(np.int64)
    for p in classes:
        end, which = search(ids, lengths, p)
        np.add.at(cover, end - p.length + 1, 1)
        np.add.at(cover, end + 1, -1)
        for r, w in set(zip(row[end].tolist(), which.tolist())):
            items[r].update(p.items[w])
    return lengths, np.cumsum(cover)[:-1] > 0, items


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs; columns stay as they are, and no row moves."""
    rows, n = _blocks(benchmark, item_text_col, item_col, window)
    kept = docs
    for k in range(n):
        clean = _clean(kept, _block(rows, k, n), text_col)
        kept = clean if k == n - 1 else stage(clean, "clean")  # the next block reads what this one has left
    return kept


def _clean(docs: DataFrame, windows: list[tuple[str, str]], text_col: str) -> DataFrame:
    block = docs.sparkSession.sparkContext.broadcast(windows)
    held: list[tuple] = []

    def clean(texts: pa.Array) -> np.ndarray:
        if not held:
            held.append(_tables(block.value))
        return np.array([not i for i in _hits(texts, held[0])[2]], bool)

    return docs.filter(column_of(docs, clean, "boolean", text_col))


def _found(doc_ids: pa.Array, lengths: np.ndarray, hit: np.ndarray, items: list[set[str]]) -> pa.RecordBatch:
    bound = np.concatenate([[0], np.cumsum(lengths)])
    total = np.concatenate([[0], np.cumsum(hit)])
    first = hit.copy()
    first[1:] &= ~hit[:-1]
    first[bound[:-1][lengths > 0]] = hit[bound[:-1][lengths > 0]]  # a span ends with its text
    last = hit.copy()
    last[:-1] &= ~hit[1:]
    last[bound[1:][lengths > 0] - 1] = hit[bound[1:][lengths > 0] - 1]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    row = np.searchsorted(bound, a, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(a - bound[row]), pa.array(b - a + 1)], names=["first", "length"])
    at = pa.array(np.searchsorted(row, np.arange(len(lengths) + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(lengths, pa.int64()), pa.array(total[bound[1:]] - total[bound[:-1]], pa.int64()),
         pa.array([sorted(i) for i in items], pa.list_(pa.string())), pa.ListArray.from_arrays(at, spans)],
        names=["doc_id", "n_words", "n_hit", "items", "spans"])
