"""SimHash near-dedup: covering masks let every near pair of fingerprints meet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.shared import doc_columns, mapped, raw, shuffle_partitions, slices, stage, words

RADIUS, SHINGLE, SEED = 3, 3, 42
BUCKET = 16_384  # fingerprints compared inside one task; larger buckets are split by further masks
#: Of a four-bit value, its bits in four counters of 16 bits each.
_LANES = np.array([sum((v >> i & 1) << 16 * i for i in range(4)) for v in range(16)], np.uint64)


def covering_masks(radius: int = RADIUS, within: int = (1 << 64) - 1) -> list[int]:
    """Masks over the bits of ``within``, two to the power of ``radius + 1`` less one of them.

    Every bit gets a non-zero vector of ``radius + 1`` bits, and mask ``v``
    holds the bits whose vector has an odd product with ``v``. The vectors of
    any ``radius`` bits leave some ``v`` orthogonal to all of them, so two
    values that differ in no more bits agree under that mask.
    """
    top = 1 << (radius + 1)
    places = [i for i in range(64) if within >> i & 1]
    return [sum(1 << p for k, p in enumerate(places) if bin((k % (top - 1) + 1) & v).count("1") % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingles(texts: pa.Array, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, and the start and end in them of every shingle; how many each text has."""
    flat, counts = words(texts)
    at, data = raw(pc.binary_join_element_wise(flat, "", " ")) if len(flat) else (np.zeros(1, np.int32), b"")
    begin, length = at[:-1].astype(np.int64), np.diff(at).astype(np.int64) - 1
    number = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    bound = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), number)
    first = bound[row] + np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    last = np.minimum(first + size, (bound + counts)[row]) - 1
    return data, begin[first], begin[last] + length[last], number


def fingerprints(texts: pa.Array, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if it is set in over half the shingles' hashes."""
    from xxhash import xxh64_intdigest as digest

    data, begin, end, number = shingles(texts, size)
    hashes = np.fromiter((digest(data[a:b], seed) for a, b in zip(begin.tolist(), end.tolist())), np.uint64, len(begin))
    return majorities(hashes, number)


def majorities(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """SimHash of each text from its shingles' hashes, text after text, and how many each text has."""
    out = np.zeros(len(number), np.uint64)
    if not len(hashes):
        return out
    # segments of one text each, short enough for 16-bit counters
    parts = -(-number // 60_000)
    row = np.repeat(np.arange(len(number)), parts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = (np.cumsum(number) - number)[row] + nth * 60_000
    total = np.zeros((len(number), 64), np.int64)
    for q in range(16):
        sums = np.add.reduceat(_LANES[((hashes >> np.uint64(4 * q)) & np.uint64(15)).astype(np.int64)], at)
        for i in range(4):
            np.add.at(total[:, 4 * q + i], row, ((sums >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64))
    for i in range(64):
        out |= (2 * total[:, i] > number).astype(np.uint64) << np.uint64(i)
    return out


def with_fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, fp`` per row; ``fp`` holds the 64 bits in a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprints(batch.column("text")).view(np.int64))], names=["doc_id", "fp"])

    return mapped(doc_columns(docs, text_col, id_col), work, "doc_id long, fp long")


def _near(fp: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """Pairs of places that connect all near fingerprints of each bucket; buckets are runs of equal numbers."""
    found = [np.zeros((0, 2), np.int64)]
    size = np.bincount(bucket)
    small = size[bucket] <= 32
    at = np.flatnonzero(small)
    for step in range(1, 32):
        at = at[at + step < len(fp)]
        at = at[bucket[at] == bucket[np.minimum(at + step, len(fp) - 1)]]
        if not len(at):
            break
        near = np.bitwise_count(fp[at] ^ fp[at + step]) <= radius
        found.append(np.stack([at[near], at[near] + step], 1))
    # a larger bucket gives a spanning forest: whoever is reached takes his unreached neighbours along
    bound = np.concatenate([[0], np.cumsum(size)])
    for k in np.flatnonzero(size > 32):
        rest = np.arange(bound[k], bound[k + 1])
        while len(rest):
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                one = front.pop()
                near = np.bitwise_count(fp[rest] ^ fp[one]) <= radius
                reached = rest[near]
                if len(reached):
                    found.append(np.stack([np.full(len(reached), one), reached], 1))
                    front.extend(reached.tolist())
                    rest = rest[~near]
    return np.concatenate(found)


def bucket_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links inside the buckets of a partition sorted by (tab, key); an open bucket is carried over."""
    held: pa.Table | None = None

    def links(rows: pa.Table) -> pa.RecordBatch:
        tab, key, fp = (rows[c].to_numpy() for c in ("tab", "key", "fp"))
        new = np.ones(len(fp), bool)
        new[1:] = (tab[1:] != tab[:-1]) | (key[1:] != key[:-1])
        pairs = _near(fp.view(np.uint64), np.cumsum(new) - 1, radius)
        ends = np.unique(np.sort(fp[pairs], axis=1), axis=0) if len(pairs) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        tab, key = rows["tab"].to_numpy(), rows["key"].to_numpy()
        full = int(np.flatnonzero(np.concatenate([[True], (tab[1:] != tab[:-1]) | (key[1:] != key[:-1])]))[-1])
        if full:
            yield links(rows.slice(0, full))
        held = rows.slice(full)
    if held is not None:
        yield links(held)


def near_links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) within ``radius`` bits.

    Their transitive closure is exactly that of all such pairs. Each
    fingerprint enters one bucket per mask. A bucket of more than ``bucket``
    fingerprints is split by masks over the bits that its own mask leaves
    out, which again let every near pair meet, and so on; every level halves
    the free bits, so the third has 128 values at most.
    """
    parts = shuffle_partitions(distinct.sparkSession)
    masks = {0: (0, covering_masks(radius))}
    rows = distinct.select("fp", F.lit(0).alias("tab"))
    out = None
    while True:
        numbered = {tab * 16 + j + 1: used | m for tab, (used, ms) in masks.items() for j, m in enumerate(ms)}
        if len(masks) == 1:
            each = [F.struct(F.lit(t).alias("tab"), F.lit(_signed(m)).alias("mask")) for t, m in numbered.items()]
            opened = rows.select("fp", F.explode(F.array(*each)).alias("x"))
        else:
            book = F.create_map(*(x for tab, (_, ms) in masks.items() for x in (F.lit(tab), F.array(*(
                F.struct(F.lit(tab * 16 + j + 1).alias("tab"), F.lit(_signed(numbered[tab * 16 + j + 1])).alias("mask")) for j in range(len(ms)))))))
            opened = rows.select("fp", F.explode(F.element_at(book, F.col("tab"))).alias("x"))
        keyed = opened.select("fp", "x.tab", F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"))
        hot = stage(keyed.groupBy("tab", "key").count().filter(F.col("count") > bucket).select("tab", "key"), "hot")
        none = hot.isEmpty() or len(numbered) >= 3375
        small = keyed if none else keyed.join(hot, ["tab", "key"], "left_anti")
        dealt = small.select("tab", "key", "fp").repartition(parts, "tab", "key").sortWithinPartitions("tab", "key", "fp")
        links = mapped(dealt, lambda it: bucket_links(it, radius), "a long, b long")
        out = links if out is None else out.union(links)
        if none:
            return out
        rows = keyed.join(hot, ["tab", "key"], "left_semi").select("fp", "tab").distinct()
        masks = {tab: (m, covering_masks(radius, ((1 << 64) - 1) & ~m)) for tab, m in numbered.items()}


def near_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Group documents whose fingerprints are linked, directly or through others.

    Equal fingerprints collapse before any comparison, so copies never pair up;
    only distinct fingerprints enter the masks' tables, and each table entry is
    compared inside its bucket. Answers return to documents by fingerprint and
    source, so a fingerprint of a third of all rows spreads over tasks.

    Returns a row per input row: ``doc_id, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable. NULL text counts as empty;
    texts without words have fingerprint zero and link like any other. A row
    without an id joins its group, whose id comes from the others (NULL if
    there are none). Repeated rows each get a row. An empty table gives none.
    """
    parts = shuffle_partitions(docs.sparkSession)
    prints = stage(with_fingerprints(docs, text_col, id_col).withColumn("source", F.pmod(F.hash("doc_id"), F.lit(parts))), "prints")
    local = prints.groupBy("fp", "source").agg(F.min("doc_id").alias("least"))
    distinct = stage(local.groupBy("fp").agg(F.min("least").alias("least")), "distinct")
    linked = stage(components(near_links(distinct.select("fp"), radius, bucket)), "components")
    named = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = stage(named.join(ids, "component").select("fp", "component_id"), "answers")
    by_source = local.select("fp", "source").join(answers, "fp")
    return prints.join(by_source, ["fp", "source"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
