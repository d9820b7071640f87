"""Near-dedup by similarity: SimHash and MinHash bands find candidates, whole sets of shingles confirm them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.shared import drop_staged, mapped, ragged, shuffle_partitions, slices, stage
from starloom.llm.simhash import majorities, near_links, shingles

SHINGLE, LEAST, SEED = 5, 0.8, 42
BANDS, ROWS = 25, 5  # of 10,000 pairs with a similarity of 0.8 that many bands of so many minima lose one half
LOOSE = 0.6  # of all minima that two texts share to be looked at more closely; at a similarity of 0.8 one pair in fifty million shares less
GROUP = 4096  # texts of a bucket or cluster that one task compares; larger ones are cut into blocks, and each pair of blocks meets
SMALL = 1_000_000  # row numbers up to which a list of them is broadcast (16 MB); a longer one is joined by a shuffle
ROW = "_near_dedup_row"


def _multipliers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Ascending 64-bit hashes of each text's distinct shingles, text after text, and how many each text has."""
    from xxhash import xxh64_intdigest as digest

    data, begin, end, number = shingles(texts, size)
    hashes = np.fromiter((digest(data[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist())), np.uint64, len(begin))
    row = np.repeat(np.arange(len(number)), number)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.bincount(row[new], minlength=len(number)).astype(np.int64)


def band_keys(hashes: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text with shingles a 64-bit key of each band, which texts share with the band's minima, and 8 bits of every minimum."""
    at = (np.cumsum(number) - number)[number > 0]
    keys, least = np.zeros((len(at), BANDS), np.uint64), np.zeros((len(at), BANDS * ROWS), np.uint8)
    if len(at):
        for k, factor in enumerate(_multipliers()):
            band, most = keys[:, k // ROWS], np.minimum.reduceat(hashes * factor, at)
            least[:, k] = (most * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(56)
            band += most ^ np.uint64(k)
            band *= np.uint64(0x9E3779B97F4A7C15)
            band ^= band >> np.uint64(29)
    return keys, least


def _signatures(numbered: DataFrame) -> DataFrame:
    """Per row two halves of a hash of its set of shingles, a hash of its text, its SimHash, its keys, and its minima in short."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest, xxh3_128_digest

        for batch in slices(batches, "text"):
            texts = batch.column("text")
            hashes, number = shingle_sets(texts)
            bound = np.concatenate([[0], np.cumsum(number)])
            halves = np.frombuffer(b"".join(xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(bound[:-1], bound[1:])), "<i8").reshape(-1, 2)
            keys, least = band_keys(hashes, number)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.where(number > 0, BANDS, 0))]).astype(np.int32)), pa.array(keys.view(np.int64).ravel()))
            short = iter(least)
            own = np.fromiter((xxh3_64_intdigest(t) for t in texts.to_pylist()), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("doc_id"), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(own), pa.array(majorities(hashes, number).view(np.int64)), lists,
                 pa.array([next(short).tobytes() if n else b"" for n in number], pa.binary())],
                names=["node", "doc_id", "k1", "k2", "own", "fp", "keys", "minima"])

    return mapped(numbered, work, "node long, doc_id long, k1 long, k2 long, own long, fp long, keys array<long>, minima binary")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows of ``key, size, node`` and more, dealt to tasks so that any two rows of a key meet.

    A key of more than ``GROUP`` rows is cut into blocks by node, and each pair
    of blocks is a group of its own, so no task holds more than two blocks.
    """
    blocks = F.ceil(F.col("size") / F.lit(GROUP)).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    met = met.withColumn("meet", pair).drop("size", "blocks", "block", "other")
    return met.repartition(shuffle_partitions(rows.sparkSession), key, "meet").sortWithinPartitions(key, "meet", "node")


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of a partition sorted by ``key, meet``, one by one; an open group is carried over."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        one, two = rows[key].to_numpy(), rows["meet"].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1, [len(one)]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and last != (one[a], two[a]):
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(a, b - a))
            last = (one[a], two[a])
    if held:
        yield pa.concat_tables(held)


def _forest(number: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """Links that connect what ``near`` connects: whoever is reached takes his unreached neighbours along."""
    found, rest = [np.zeros((0, 2), np.int64)], np.arange(number)
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            one = front.pop()
            on = near(one, rest)
            reached = rest[on]
            if len(reached):
                found.append(np.stack([np.full(len(reached), one), reached], 1))
                front.extend(reached.tolist())
                rest = rest[~on]
    return np.concatenate(found)


def loosely_near(minima: list[bytes]) -> Callable[[int, np.ndarray], np.ndarray]:
    """Which of some texts share enough minima with a text to be similar."""
    table, need = np.frombuffer(b"".join(minima), np.uint8).reshape(-1, BANDS * ROWS), int(LOOSE * BANDS * ROWS)
    return lambda one, rest: (table[rest] == table[one]).sum(1) >= need


def surely_near(sets: list[np.ndarray], least: float) -> Callable[[int, np.ndarray], np.ndarray]:
    """Which of some sets share ``least`` of what either has with a set.

    A similar set holds at least one of any ``size - ceil(least * size) + 1``
    members, so only the sets that hold one of the rarest so many are counted.
    """
    size = np.array([len(x) for x in sets], np.int64)
    begin = np.cumsum(size) - size
    _, term, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holder = np.repeat(np.arange(len(sets)), size)[np.argsort(term, kind="stable")]
    after = np.cumsum(often)
    mark = np.zeros(len(often), bool)

    def near(one: int, rest: np.ndarray) -> np.ndarray:
        own = term[begin[one]: begin[one] + size[one]]
        lead = len(own) - int(np.ceil(least * len(own) - 1e-6)) + 1
        rare = own[np.argsort(often[own], kind="stable")[:lead]]
        meets = np.zeros(len(sets), bool)
        meets[holder[ragged(after[rare] - often[rare], often[rare])]] = True
        on = meets[rest] & (np.minimum(size[rest], len(own)) >= least * np.maximum(size[rest], len(own)) - 1e-6)
        those = rest[on]
        if len(those):
            mark[own] = True
            both = np.add.reduceat(mark[term[ragged(begin[those], size[those])]], np.cumsum(size[those]) - size[those], dtype=np.int64)
            mark[own] = False
            on[on] = both / (len(own) + size[those] - both) >= least
        return on

    return near


def _links(dealt: DataFrame, key: str, near: Callable[[pa.Table], Callable], label: str) -> DataFrame:
    """Links ``a, b`` that connect the near rows of every group, one less than its rows at most."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, key):
            if rows.num_rows > 1:
                pairs = rows["node"].to_numpy()[_forest(rows.num_rows, near(rows))]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return stage(mapped(dealt, work, "a long, b long"), label)


def _with_few(rows: DataFrame, few: DataFrame, on: str, how: str) -> DataFrame:
    """A join with a staged table of few columns, broadcast up to ``SMALL`` rows and shuffled beyond."""
    return rows.join(F.broadcast(few) if few.count() <= SMALL else few, on, how)


def fingerprint_links(heads: DataFrame) -> DataFrame:
    """Links ``a, b`` that connect all texts whose SimHash (``node, fp``) differs in few bits; covering masks let every such pair meet.

    Texts of one fingerprint hang on the first of them, so they make no pairs.
    """
    first = stage(heads.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
    same = heads.join(first, "fp").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    end = lambda side: first.select(F.col("fp").alias(side), F.col("first").alias(f"first_{side}"))
    near = near_links(first.select("fp")).join(end("a"), "a").join(end("b"), "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    links = stage(same.unionByName(near), "fingerprint-links")
    drop_staged(first)
    return links


def _linked(heads: DataFrame, texts: DataFrame, least: float) -> DataFrame | None:
    """``node, component`` of the sets that are linked; ``heads`` has ``node, fp, keys, minima``, and ``texts`` the text of each node."""
    alike = fingerprint_links(heads.filter(F.size("keys") > 0).select("node", "fp"))
    keyed = heads.select("node", F.explode("keys").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = stage(keyed.join(crowded, "key"), "buckets")
    wide = buckets.join(heads.select("node", "minima"), "node")
    loose = _links(_dealt(wide.select("key", "size", "node", "minima"), "key"), "key", lambda rows: loosely_near(rows["minima"].to_pylist()), "loose")
    drop_staged(buckets)
    clusters = components(alike.unionByName(loose))
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    clusters = stage(clusters.join(sizes, "component").select("node", F.col("component").alias("cluster"), "size"), "clusters")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, number = shingle_sets(batch.column("text"))
            own = [h.astype("<u8").tobytes() for h in np.split(hashes, np.cumsum(number)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("cluster", "size", "node")] + [pa.array(own, pa.binary())], names=["cluster", "size", "node", "hashes"])

    sets = mapped(_with_few(texts, clusters, "node", "inner").select("cluster", "size", "node", "text"), hashed, "cluster long, size long, node long, hashes binary")
    sure = _links(_dealt(sets, "cluster"), "cluster", lambda rows: surely_near([np.frombuffer(x, "<u8") for x in rows["hashes"].to_pylist()], least), "links")
    linked = stage(components(sure), "linked")
    drop_staged(alike, loose, clusters, sure)
    return linked


def keep_dissimilar(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least: float = LEAST) -> DataFrame:
    """``docs`` with one row of each group of similar texts; columns stay as they are.

    Two texts are similar if their sets of five-word shingles (A-Z in lower
    case; a shorter text is one shingle) have a Jaccard similarity of ``least``;
    a group is what such links connect. Equal sets collapse first. Candidates
    are the texts whose SimHash, of the same shingles, differs in three of 64
    bits at most, and, since that holds for few of the pairs at 0.8, those that
    share the minima of one band of five hash functions out of 25. Inside each
    bucket the texts that share 0.6 of all minima are chained, and inside each
    of the clusters so found the whole sets are compared: no pair below
    ``least`` is linked, and a pair at 0.8 is missed with a chance of 1 in
    20,000. Only links that connect a group leave a task, so copies of one text
    make no pairs, and a bucket or cluster of more than ``GROUP`` texts is cut
    into blocks that meet pair by pair.

    The row with the smallest id stays, one without an id only if the group has
    no other; rows of one id count by their own texts, of which the smaller
    hash goes first. NULL text counts as empty, and texts without words are one
    group.
    """
    numbered = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    texts = numbered.select(F.col(ROW).alias("node"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    prints = stage(_signatures(texts), "signatures")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "own", "node")).alias("best")
    heads = stage(prints.groupBy("k1", "k2").agg(best).select("best.*"), "heads")
    linked = _linked(prints.select("node", "fp", "keys", "minima").join(heads.select("node"), "node", "left_semi"), texts.select("node", "text"), least)
    named = heads.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = named.groupBy("component").agg(best).select(F.col("best.node").alias("node"))
    gone = stage(prints.select("node").join(kept, "node", "left_anti").select(F.col("node").alias(ROW)), "gone")
    drop_staged(prints, heads, linked)
    return _with_few(numbered, gone, ROW, "left_anti").select(*docs.columns)
