"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import column_of, fold, mapped, slices, stage, words

BUCKETS, DIMS, ENTRIES, REACH = 8192, 32, 4, 2  # hashed vocabulary, vector length, non-zero entries, neighbours each way
TRAIN_ROWS = 20_000  # most labelled rows a network is fitted to
HIDDEN, EPOCHS, STEP, DECAY = 32, 60, 0.01, 1e-4
SLICE = 1 << 20


def items(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its letters' bucket and its shape's bucket, and how many words each text has.

    A word is parted into its letters and digits in lower case, and its shape:
    runs of capitals, small letters and digits become one sign each, the rest
    stays. Each distinct word of a batch is looked at once.
    """
    import xxhash

    flat, counts = words(texts, None)
    coded = flat.dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False)
    letters = pc.utf8_lower(pc.replace_substring_regex(coded.dictionary, r"[^\pL\pN]+", ""))
    shape = coded.dictionary
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lo}\p{Lt}\p{Lm}]+", "a"), (r"\pN+", "0")):
        shape = pc.replace_substring_regex(shape, pattern, sign)

    def bucket(column: pa.Array, seed: int) -> np.ndarray:
        return np.fromiter((xxhash.xxh32_intdigest(w, seed) % BUCKETS for w in column.to_pylist()), np.int64, len(column))

    shapes = shape.dictionary_encode()
    by_shape = bucket(shapes.dictionary, 2)[shapes.indices.to_numpy(zero_copy_only=False)] if len(shape) else np.zeros(0, np.int64)
    return bucket(letters, 1)[at], by_shape[at], counts


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Each bucket's sparse random vector: the places of its entries, and their signs."""
    rng = np.random.default_rng(11)
    place = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :ENTRIES]
    return place, rng.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Vectors of all buckets from the neighbours of every word of every text.

    A bucket's vector sums the index vectors of the items up to ``REACH`` places
    away, where a word counts as two items, letters and shape. Each task adds
    up its own texts and hands on one row per bucket; the table has a fixed
    size of 1 MB whatever the corpus.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors()
        table = np.zeros(BUCKETS * DIMS)
        for batch in slices(batches, "text", SLICE):
            letters, shape, counts = items(batch.column("text"))
            line = np.stack([letters, shape], 1).ravel()
            row = np.repeat(np.arange(len(counts)), 2 * counts)
            for reach in range(1, REACH + 1):
                same = row[reach:] == row[:-reach]
                a, b = line[:-reach][same], line[reach:][same]
                for here, there in ((a, b), (b, a)):
                    for k in range(ENTRIES):
                        table += np.bincount(here * DIMS + place[there, k], sign[there, k], len(table))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array([r.astype("<f4").tobytes() for r in table.reshape(BUCKETS, DIMS)], pa.binary())], names=["bucket", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.zeros((BUCKETS, DIMS)), np.zeros(BUCKETS, bool)
        for batch in batches:
            at = batch.column("bucket").to_numpy()
            for i, part in zip(at.tolist(), batch.column("part").to_pylist()):
                table[i] += np.frombuffer(part, "<f4")
            seen[at] = True
        own = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array([r.astype("<f8").tobytes() for r in table[own]], pa.binary())], names=["bucket", "part"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = mapped(texts, work, "bucket int, part binary")
    sums = mapped(parts.repartition(8, "bucket"), add, "bucket int, part binary")
    table = np.zeros((BUCKETS, DIMS))
    for bucket, part in sums.collect():  # BUCKETS rows, each of one task
        table[bucket] = np.frombuffer(part, "<f8")
    norm = np.sqrt((table * table).sum(1, keepdims=True))
    return (table / np.maximum(norm, 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Means of the vectors of letters and of shapes, and four shares: repeats of the word before, distinct words, length, word length."""
    letters, shape, counts = items(texts)
    n = np.maximum(counts, 1)[:, None]
    row = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros((len(counts), 2 * DIMS + 4), np.float64)
    full = np.flatnonzero(counts)
    if len(full):
        at = (np.cumsum(counts) - counts)[full]
        out[full, :DIMS] = np.add.reduceat(vectors[letters], at, axis=0)
        out[full, DIMS: 2 * DIMS] = np.add.reduceat(vectors[shape], at, axis=0)
    out[:, : 2 * DIMS] /= n
    again = (letters[1:] == letters[:-1]) & (row[1:] == row[:-1])
    out[:, -4] = np.bincount(row[1:][again], minlength=len(counts)) / n[:, 0]
    kinds = np.unique(row * BUCKETS + letters)
    out[:, -3] = np.bincount(kinds // BUCKETS, minlength=len(counts)) / np.sqrt(n[:, 0])
    out[:, -2] = np.log1p(counts)
    out[:, -1] = pc.binary_length(texts).to_numpy(zero_copy_only=False) / n[:, 0] / 10
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; the logit is divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    informed: bool = True

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        """Rounded, so that the order of additions in a batch leaves no trace."""
        return np.round(1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40))), 9)


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Train on four fifths of the rows by Adam, and set the temperature on the rest by the likelihood.

    With labels of one kind only (or none) every score is that label's smoothed share.
    """
    n = len(y)
    if not n or y.min() == y.max():
        share = (y.sum() + 1) / (n + 2)
        d = x.shape[1]
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), informed=n > 0)
    rng = np.random.default_rng(5)
    order = rng.permutation(n)
    held, used = order[: n // 5], order[n // 5:]
    if y[used].min() == y[used].max():
        used = order
    net = Network(x[used].mean(0), x[used].std(0) + 1e-6, rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    z = np.clip((x - net.mean) / net.scale, -8, 8)
    theta = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta], 0
    for epoch in range(EPOCHS):
        rate = STEP * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for part in np.array_split(rng.permutation(used), max(1, len(used) // 256)):
            h = np.tanh(z[part] @ theta[0] + theta[1])
            e = (1 / (1 + np.exp(-np.clip(h @ theta[2] + theta[3], -40, 40))) - y[part]) / len(part)
            back = np.outer(e, theta[2]) * (1 - h * h)
            grads = [z[part].T @ back + DECAY * theta[0], back.sum(0), h.T @ e + DECAY * theta[2], np.array([e.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                theta[k] = theta[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = theta[0], theta[1], theta[2], float(theta[3][0])
    if len(held):
        logit, sign = net.logit(x[held]), np.where(y[held] > 0, 1.0, -1.0)
        ladder = np.geomspace(0.25, 8, 81)
        net.temperature = float(ladder[np.argmin([np.logaddexp(0, -sign * logit / t).mean() for t in ladder])])
    return net


def train(docs: DataFrame, labels: DataFrame, vectors, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
          parts: int = 4, held_part: int = 2, rows: int = TRAIN_ROWS) -> Network:
    """Fit to at most ``rows`` labelled rows that are not held out, chosen by a hash of their id.

    ``labels`` may lack documents, name unknown ones, hold NULLs, or label an id
    more than once (the mean, rounded, counts). Of documents that share an id
    the text with the smallest hash counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).dropna()
    known = known.filter(fold(F.col("doc_id"), parts) != held_part).groupBy("doc_id").agg(F.round(F.avg("y")).alias("y"))
    chosen = stage(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows_in = texts.join(F.broadcast(chosen), "doc_id").withColumn("own", F.xxhash64("text"))  # broadcast: ``rows`` rows of two numbers at most
    table = docs.sparkSession.sparkContext.broadcast(vectors)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            x = pooled(batch.column("text"), table.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), batch.column("own"), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())], names=["doc_id", "y", "own", "x"])

    each = mapped(rows_in, work, "doc_id long, y double, own long, x binary").groupBy("doc_id").agg(F.min("y").alias("y"), F.min(F.struct("own", "x")).alias("best"))
    got = sorted(tuple(r) for r in each.select("doc_id", "y", "best.x").collect())  # ``rows`` rows at most
    x = np.array([np.frombuffer(g[2], "<f4") for g in got], np.float64).reshape(len(got), 2 * DIMS + 4)
    return fit(x, np.array([g[1] for g in got]))


def score_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: float = 0.7,
                  parts: int = 4, held_part: int = 2) -> DataFrame:
    """A calibrated quality score for every whole text.

    Word vectors come from all texts, the network from labelled rows outside
    the held-out part; only the text enters a score. Returns per row ``doc_id,
    held_out, score, predicted`` (1 from ``threshold`` on). NULL text counts as
    empty, and empty texts share one score; a missing id counts as an empty
    text when parts are dealt; repeated rows each get their score.
    """
    score, _ = _scorer(docs, labels, text_col, id_col, parts, held_part)
    doc_id = F.col(id_col).cast("long")
    scored = docs.select(doc_id.alias("doc_id"), (fold(doc_id, parts) == held_part).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _scorer(docs: DataFrame, labels: DataFrame, text_col: str, id_col: str, parts: int = 4, held_part: int = 2) -> tuple[Column, bool]:
    """The score of a text as a column, from a model trained now; and whether it has seen any label."""
    vectors = word_vectors(docs, text_col)
    network = train(docs, labels, vectors, text_col, id_col, parts=parts, held_part=held_part)
    table = docs.sparkSession.sparkContext.broadcast(vectors)

    return column_of(docs, lambda texts: network.score(pooled(texts, table.value)), "double", text_col, SLICE), network.informed


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; columns stay as they are. Without any label nothing is rejected."""
    score, informed = _scorer(docs, labels, text_col, id_col)
    return docs.filter(score >= threshold) if informed else docs
