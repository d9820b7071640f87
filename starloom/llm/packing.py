"""Packing: documents ordered along a space-filling curve and laid end to end."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import encoder
from starloom.llm.shared import BATCH_BYTES, doc_columns, mapped, ragged, shuffle_partitions, slices, words

BUCKETS = 512  # hashed document vectors have this many entries
DIMS, BITS = 4, 12  # and are projected to so many coordinates of so many bits
SAMPLE = 100  # rows per partition from which the cuts of the curve are drawn
_NO_ID = -(1 << 63)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def projection(seed: int = 7) -> np.ndarray:
    """A fixed random direction per bucket and coordinate."""
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMS)).astype(np.float32)


def word_hashes(flat: pa.Array) -> np.ndarray:
    """64-bit hashes of words, each distinct word hashed once."""
    import xxhash

    coded = flat.dictionary_encode()
    each = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return each[coded.indices.to_numpy(zero_copy_only=False)]


def coordinates(texts: pa.Array, directions: np.ndarray) -> np.ndarray:
    """Each text's place in the unit cube, in steps of 2**-BITS.

    Words are hashed into signed buckets; the bucket counts, scaled to length
    one, are projected, and the normal distribution function spreads each
    coordinate. A text without words lies in the middle.
    """
    flat, counts = words(texts)
    hashed = word_hashes(flat)
    row = np.repeat(np.arange(len(counts)), counts)
    sign = np.where(hashed >> np.uint64(63), -1.0, 1.0)
    vector = np.bincount(row * BUCKETS + (hashed % np.uint64(BUCKETS)).astype(np.int64), sign, len(counts) * BUCKETS).reshape(-1, BUCKETS)
    norm = np.sqrt((vector * vector).sum(1, keepdims=True))
    place = (vector / np.maximum(norm, 1e-12)) @ directions
    spread = 1 / (1 + np.exp(-1.702 * place))  # close to the normal distribution function
    return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of integer points along the Hilbert curve through their cube.

    From the top bit down, the curve's frame is turned so that neighbouring
    cells get neighbouring positions: a coordinate whose bit is set reverses the
    lower bits of the first one, otherwise the two swap where they differ; the
    Gray code of the turned bits is then undone and interleaved.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(n):
            reverse = (x[d] >> level) & 1
            differ = np.where(reverse == 1, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(reverse == 1, low, differ)
            x[d] ^= differ
    for d in range(1, n):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | ((x[d] >> level) & 1)
    return key


def curve_keys(texts: pa.Array, directions: np.ndarray) -> np.ndarray:
    """Hilbert keys of texts."""
    return hilbert_key(coordinates(texts, directions))


def split_points(docs: DataFrame, parts: int, sample: int = SAMPLE) -> np.ndarray:
    """Where the curve is cut into ``parts``: rows of ``curve_key, doc_id``, ascending.

    About ``sample`` rows per part, drawn by a hash of their position, are
    weighed by the length of their texts, so parts hold about equal bytes. They
    decide the balance alone: every row is packed, wherever the cuts lie.
    """
    share = min(1.0, sample * parts / max(1, docs.count()))
    drawn = docs.filter(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    directions = projection()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            size = pc.binary_length(batch.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(curve_keys(batch.column("text"), directions)), size], names=["doc_id", "curve_key", "size"])

    # bounded: twice the wanted rows at the very most, of three numbers each
    rows = mapped(drawn, work, "doc_id long, curve_key long, size long").limit(2 * sample * parts + 100).collect()
    rows = sorted((r.curve_key, _NO_ID if r.doc_id is None else r.doc_id, r.size + 100) for r in rows)
    if not rows:
        return np.zeros((0, 2), np.int64)
    weight = np.cumsum([r[2] for r in rows])
    at = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
    return np.array([rows[i][:2] for i in np.unique(at)], np.int64).reshape(-1, 2)


def placed(docs: DataFrame, cuts: np.ndarray) -> DataFrame:
    """``docs`` with the Hilbert key of each text in ``curve_key`` and its part of the curve in ``part``."""
    directions = projection()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            key, own = curve_keys(batch.column("text"), directions), batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            low, high = (np.searchsorted(cuts[:, 0], key, side) for side in ("left", "right"))
            # cuts of one key lie inside one long run of it: there the id decides
            for i in np.flatnonzero(low < high):
                low[i] += np.searchsorted(cuts[low[i]: high[i], 1], own[i], "left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key), pa.array(low.astype(np.int32))], names=["doc_id", "text", "curve_key", "part"])

    return mapped(docs, work, "doc_id long, text string, curve_key long, part int")


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_file: str, spaces: bool = True, end_id: int | None = 1, length: int = 2048,
         text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Pack every document into sequences of ``length`` tokens, neighbours on the curve together.

    Documents are range-sorted by their Hilbert key, then id, then text: the
    curve is cut at points drawn from a sample of keys, each key is computed
    once in the pass that shuffles, and each partition lays its ids end to end and cuts them every ``length``
    tokens. What is left at a partition's end is cut into powers of two, which
    need no padding. Equal keys are told apart by id, so a text held by a third
    of all rows spreads over partitions.

    Returns a row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``. NULL text counts as empty (with an end id that is a
    document of one token; without, it has no piece). Repeated rows are packed
    each. Sequence ids are unique, and ascend along the curve.
    """
    if length & (length - 1):
        raise ValueError("length is a power of two")
    n = shuffle_partitions(docs.sparkSession)
    own = doc_columns(docs, text_col, id_col)
    rows = placed(own, split_points(own, n)).repartitionById(n, "part").drop("part").sortWithinPartitions("curve_key", "doc_id", "text")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code, base = encoder(tokenizer_file, spaces, end_id), TaskContext.get().partitionId() << 40
        at, open_pieces = 0, []  # tokens laid so far; pieces of the sequence not yet full
        for batch in slices(batches, "text", BATCH_BYTES // 2):
            ids, sizes = code(batch.column("text"))
            pieces = open_pieces + cut(batch.column("doc_id").to_pylist(), ids, sizes, at, length)
            at += len(ids)
            full = at // length * length
            yield batch_of([p for p in pieces if p[2] < full], range(0, full + 1, length), base)
            open_pieces = [p for p in pieces if p[2] >= full]
        bounds = tail_bounds(at, length)
        yield batch_of(split_at(open_pieces, bounds), bounds, base + at // length)

    return mapped(rows, lay, PIECE)


#: doc_id, start in the document, place in the partition's stream, document length, ids
Piece = tuple[int, int, int, int, np.ndarray]


def cut(doc_ids: list, ids: np.ndarray, sizes: np.ndarray, at: int, length: int) -> list[Piece]:
    """Pieces of documents that are laid end to end from place ``at`` and cut at multiples of ``length``."""
    first = np.cumsum(sizes) - sizes
    count = np.where(sizes > 0, (at + first + sizes - 1) // length - (at + first) // length + 1, 0)
    row = np.repeat(np.arange(len(sizes)), count)
    sequence = ragged((at + first) // length, count)
    begin = np.maximum(at + first[row], sequence * length) - at
    end = np.minimum(at + first[row] + sizes[row], (sequence + 1) * length) - at
    start = begin - first[row]
    return [(doc_ids[r], s, at + a, n, ids[a:b]) for r, s, a, b, n in
            zip(row.tolist(), start.tolist(), begin.tolist(), end.tolist(), sizes[row].tolist())]


def tail_bounds(at: int, length: int) -> list[int]:
    """Where the last, open sequence of a stream of ``at`` tokens is cut: at its binary parts."""
    bounds = [at // length * length]
    for bit in range(length.bit_length() - 2, -1, -1):
        if at % length >> bit & 1:
            bounds.append(bounds[-1] + (1 << bit))
    return bounds


def split_at(pieces: list[Piece], bounds: list[int]) -> list[Piece]:
    out = []
    for doc_id, start, place, total, ids in pieces:
        marks = [place, *(b for b in bounds if place < b < place + len(ids)), place + len(ids)]
        out += [(doc_id, start + a - place, a, total, ids[a - place: b - place]) for a, b in zip(marks[:-1], marks[1:])]
    return out


def batch_of(pieces: list[Piece], bounds: range | list[int], base: int) -> pa.RecordBatch:
    """Rows of pieces; sequence number k of ``base`` begins at place ``bounds[k]``."""
    place = np.array([p[2] for p in pieces], np.int64)
    if isinstance(bounds, range):
        sequence = place // max(bounds.step, 1)
        offset = place - sequence * bounds.step
    else:
        sequence = np.searchsorted(bounds, place, side="right") - 1
        offset = place - np.array(bounds, np.int64)[sequence]
    columns = [[p[0] for p in pieces], [p[1] for p in pieces], [len(p[4]) for p in pieces],
               [zlib.crc32(np.ascontiguousarray(p[4], "<u4")) for p in pieces], [p[3] for p in pieces]]
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns), pa.array(sequence + base, pa.int64()), pa.array(offset, pa.int64())],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
