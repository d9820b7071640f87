"""Toxicity: a chain of linear classifiers over words and word beginnings, through categories found in the data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.shared import fold, mapped, slices, smallest_hashes, stage, words

KINDS = 3  # categories before the last one, found in the data: groups of words that toxic texts hold together
SEEDS = 400  # features that those groups are made of at most
TRAIN_ROWS = 20_000  # most labelled rows the chain is fitted to
FEATURES, SUPPORT, FOLDS, ROUNDS = 4096, 3, 3, 300
PREFIXES = (4, 5, 6)


def feature_codes(distinct: pa.Array) -> list[list[int]]:
    """64-bit codes of each word's letters and of their beginnings."""
    from xxhash import xxh64_intdigest as digest

    letters = pc.utf8_lower(pc.replace_substring_regex(distinct, r"[^\pL\pN]+", "")).to_pylist()
    signed = lambda s, seed: digest(s, seed) - (1 << 63)
    return [[signed(w, 0), *(signed(w[:n], n) for n in PREFIXES if len(w) > n)] if w else [] for w in letters]


def presence(texts: pa.Array, known: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and codes of the features present in each text, once each; with ``known`` only those, by number."""
    flat, counts = words(texts, None)
    coded = flat.dictionary_encode()
    row = np.repeat(np.arange(len(counts)), counts)
    size = len(coded.dictionary)
    pair = np.unique(row * max(size, 1) + coded.indices.to_numpy(zero_copy_only=False))
    row, word = pair // max(size, 1), pair % max(size, 1)
    codes = feature_codes(coded.dictionary)
    if known is not None:
        codes = [[known[c] for c in own if c in known] for own in codes]
    number = np.fromiter(map(len, codes), np.int64, size)
    start = np.cumsum(number) - number
    every = np.fromiter((c for own in codes for c in own), np.int64, int(number.sum()))
    own = number[word]
    at = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own) + np.repeat(start[word], own)
    both = np.stack([np.repeat(row, own), every[at]], 1) if len(at) else np.zeros((0, 2), np.int64)
    both = both[np.lexsort((both[:, 1], both[:, 0]))]
    fresh = np.ones(len(both), bool)
    fresh[1:] = (both[1:] != both[:-1]).any(1)
    return both[fresh, 0], both[fresh, 1]


class Sparse:
    """Rows of present features and some dense columns, with a linear model over them."""

    def __init__(self, row: np.ndarray, feature: np.ndarray, rows: int, features: int, dense: np.ndarray):
        self.row, self.feature, self.rows, self.features, self.dense = row, feature, rows, features, dense

    def logit(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.feature], self.rows) + self.dense @ w[self.features: -1] + w[-1]

    def gradient(self, e: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.feature, e[self.row], self.features), self.dense.T @ e, [e.sum()]])

    def take(self, mask: np.ndarray) -> Sparse:
        place = np.cumsum(mask) - 1
        on = mask[self.row]
        return Sparse(place[self.row[on]], self.feature[on], int(mask.sum()), self.features, self.dense[mask])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_linear(x: Sparse, y: np.ndarray, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression by Adam over all rows; labels of one kind give their smoothed share."""
    w = np.zeros(x.features + x.dense.shape[1] + 1)
    share = (y.sum() + 0.5) / (len(y) + 2)
    w[-1] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return w
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, ROUNDS + 1):
        g = x.gradient(sigmoid(x.logit(w)) - y) / len(y) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def fit_chain(row: np.ndarray, feature: np.ndarray, labels: np.ndarray, features: int) -> list[np.ndarray]:
    """One model per category in order. A model sees what the ones before say of its rows, and
    learns from what they say of rows they were not fitted to."""
    n, models, said = len(labels), [], np.zeros((len(labels), 0))
    part = np.arange(n) % FOLDS
    for k in range(labels.shape[1]):
        x, y = Sparse(row, feature, n, features, said), labels[:, k]
        models.append(fit_linear(x, y))
        unseen = np.zeros(n)
        for f in range(FOLDS):
            if (part != f).any() and (part == f).any():
                unseen[part == f] = sigmoid(x.take(part == f).logit(fit_linear(x.take(part != f), y[part != f])))
        said = np.column_stack([said, unseen])
    return models


def kinds_of(row: np.ndarray, feature: np.ndarray, rows: int, features: int, kinds: int = KINDS, rounds: int = 20) -> np.ndarray:
    """Which of ``kinds`` groups each row belongs to: rows whose features occur together, in any language.

    ``row, feature`` are the toxic rows' features, the first ones being those
    that speak most for the label. Rows are unit vectors of their first ``SEEDS``
    features, weighed by rarity, and grouped around ``kinds`` mean directions:
    the first is the row nearest to all, the next ones those farthest from the
    ones before. A row without such a feature belongs to none (-1).
    """
    on = feature < SEEDS
    x = np.zeros((rows, min(features, SEEDS)))
    x[row[on], feature[on]] = 1
    x *= np.log((rows + 1) / (x.sum(0) + 1))
    size = np.sqrt((x * x).sum(1))
    own = size > 0
    out = np.full(rows, -1)
    if own.sum() < kinds:
        return out
    x = x[own] / size[own, None]
    centre = [x[np.argmax(x @ x.sum(0))]]
    while len(centre) < kinds:
        centre.append(x[np.argmin(np.max(x @ np.array(centre).T, axis=1))])
    centres = np.array(centre)
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.array([x[near == k].sum(0) if (near == k).any() else centres[k] for k in range(kinds)])
        centres = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-12)
    # the largest group first, so that numbers do not depend on the order of rows
    order = np.argsort(-np.bincount(near, minlength=kinds), kind="stable")
    out[own] = np.argsort(order)[near]
    return out


def run_chain(row: np.ndarray, feature: np.ndarray, rows: int, features: int, models: list[np.ndarray]) -> np.ndarray:
    said = np.zeros((rows, 0))
    for w in models:
        said = np.column_stack([said, sigmoid(Sparse(row, feature, rows, features, said).logit(w))])
    return said


def score_toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
                   threshold: float = 0.5, parts: int = 4, held_part: int = 2, rows: int = TRAIN_ROWS) -> DataFrame:
    """Probabilities of the toxicity categories for every whole text.

    Features are the presence of a word's letters and of word beginnings; those
    kept speak most clearly for the label in the training rows, at most
    ``rows`` labelled ones outside the held-out part, chosen by a hash of their
    id (of texts that share an id, the one with the smallest hash). The
    categories that come before the label are groups of toxic training rows
    whose words occur together (``kinds_of``), largest first. Returns per
    row ``doc_id, held_out``, a probability per category,
    ``score`` (that of the last category) and ``toxic`` (1 from ``threshold``
    on). NULL text counts as empty; without labels every text gets the same
    low score; repeated rows each get theirs.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).dropna()
    known = known.filter(fold(F.col("doc_id"), parts) != held_part).groupBy("doc_id").agg(F.round(F.avg("y")).alias("y"))
    chosen = smallest_hashes(stage(known, "known"), rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id")  # broadcast: ``rows`` rows of two numbers at most
    each = joined.groupBy("doc_id").agg(F.min("y").alias("y"), F.min(F.struct(F.xxhash64("text").alias("own"), "text")).alias("best"))
    sample = stage(each.select("doc_id", "best.text", "y"), "sample")  # ``rows`` rows at most

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, code = presence(batch.column("text"))
            y = batch.column("y").to_numpy()[row]
            every, place = np.unique(code, return_inverse=True)
            with_label = np.bincount(place, y, len(every)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(with_label), pa.array(np.bincount(place, minlength=len(every)) - with_label)], names=["code", "yes", "no"])

    seen = mapped(sample, counts, "code long, yes long, no long").groupBy("code").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    size = sample.agg(F.sum("y"), F.count(F.lit(1))).first()
    n_yes, n_no = float(size[0] or 0), float(size[1]) - float(size[0] or 0)
    odds = F.log((F.col("yes") + 0.5) / (n_yes + 1)) - F.log((F.col("no") + 0.5) / (n_no + 1))
    weight = odds * F.col("yes")
    best = seen.filter(F.col("yes") >= SUPPORT).filter(odds > 1).orderBy(weight.desc(), "code").limit(FEATURES).select("code").collect()
    number = {r[0]: i for i, r in enumerate(best)}
    features = len(number)
    names = [*(f"kind_{k + 1}" for k in range(KINDS)), "toxic"]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, feature = presence(batch.column("text"), number)
            own = np.split(feature, np.searchsorted(row, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array([o.tolist() for o in own], pa.list_(pa.int32()))], names=["doc_id", "y", "own"])

    got = sorted((r[0], r[1], tuple(r[2])) for r in mapped(sample, rows_of, "doc_id long, y double, own array<int>").collect())
    y = np.array([g[1] for g in got])
    row, feature = np.repeat(np.arange(len(got)), [len(g[2]) for g in got]).astype(np.int64), np.array([f for g in got for f in g[2]], np.int64)
    bad, kind = np.flatnonzero(y > 0), np.full(len(got), -1)
    place = np.full(len(got), -1)
    place[bad] = np.arange(len(bad))
    yes = place[row] >= 0 if len(row) else np.zeros(0, bool)
    kind[bad] = kinds_of(place[row[yes]], feature[yes], len(bad), features)
    target = np.column_stack([*((kind == k) for k in range(KINDS)), y > 0]).astype(float) if got else np.zeros((0, len(names)))
    models = fit_chain(row, feature, target, features)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, feature = presence(batch.column("text"), number)
            said = run_chain(row, feature, batch.num_rows, features, models)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(np.round(c, 9)) for c in said.T)], names=["doc_id", *names])

    out = mapped(texts, work, "doc_id long, " + ", ".join(f"{n} double" for n in names))
    return out.select(
        "doc_id", (fold(F.col("doc_id"), parts) == held_part).alias("held_out"), *names[:-1], F.col("toxic").alias("score"), (F.col("toxic") >= threshold).cast("int").alias("toxic"))
