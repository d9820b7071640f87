"""Language-model scoring: a word bigram model in sharded tries, counted over all training documents."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.packing import word_hashes
from starloom.llm.shared import doc_columns, drop_staged, fold, mapped, shuffle_partitions, slices, stage, words
from starloom.llm.trie import Trie, quantise, value

CHUNK = 1_000_000  # tokens of one chunk; a longer document is a chunk of its own
CLASSES = 16  # a very frequent context is stored in so many parts, by classes of its successors
DISCOUNT = 0.75  # taken from every bigram count
CONTEXT_BITS = 44
START, END, UNKNOWN = np.uint64(0x517A127F00000001), np.uint64(0x0E4D57A700000003), np.uint64(0x0BADC0DE00000005)
_MIX = np.uint64(0x9E3779B97F4A7C15)

CHUNKS = "chunk long, doc_ids array<long>, train array<boolean>, lengths array<int>, vocabulary binary, sequence binary"


def chunked(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Documents as chunks of about ``chunk`` tokens: a sorted vocabulary of 64-bit word codes, and every text as places in it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, n = TaskContext.get().partitionId() << 32, 0
        ids, train, lengths, hashed, total = [], [], [], [], 0

        def emit() -> pa.RecordBatch:
            vocabulary, place = np.unique(np.concatenate(hashed), return_inverse=True)
            return pa.RecordBatch.from_arrays([
                pa.array([base + n]), pa.array([ids], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())), pa.array([lengths], pa.list_(pa.int32())),
                pa.array([vocabulary.astype("<u8").tobytes()], pa.binary()), pa.array([place.astype("<u4").tobytes()], pa.binary())],
                names=["chunk", "doc_ids", "train", "lengths", "vocabulary", "sequence"])

        for batch in slices(batches, "text"):
            flat, counts = words(batch.column("text"))
            hashed.append(word_hashes(flat))
            ids += batch.column("doc_id").to_pylist()
            train += batch.column("train").to_pylist()
            lengths += counts.tolist()
            total += len(flat)
            if total >= chunk:
                yield emit()
                n += 1
                ids, train, lengths, hashed, total = [], [], [], [], 0
        if ids:
            yield emit()

    return mapped(rows, work, CHUNKS)


class Chunk:
    """One chunk's tokens: all texts end to end, each followed by its end."""

    def __init__(self, row: dict):
        self.vocabulary = np.frombuffer(row["vocabulary"], "<u8")
        self.lengths = np.array(row["lengths"], np.int64)
        self.train = np.array(row["train"], bool)
        place = np.frombuffer(row["sequence"], "<u4").astype(np.int64)
        v = len(self.vocabulary)  # then come the end, the start and unknown words
        self.codes = np.concatenate([self.vocabulary, [END, START, UNKNOWN]])
        tokens = np.full(len(place) + len(self.lengths), v, np.int64)
        self.row = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)
        last = np.cumsum(self.lengths + 1) - 1
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner] = place
        before = np.roll(tokens, 1)
        before[np.concatenate([[0], last[:-1] + 1])[: len(last)]] = v + 1
        self.tokens, self.before = tokens, before

    def word_counts(self) -> np.ndarray:
        """Training occurrences of each word of the vocabulary."""
        return np.bincount(self.tokens[self.train[self.row]], minlength=len(self.codes))[: len(self.vocabulary)]

    def pairs(self, count: np.ndarray, hot_from: float, shards: int) -> tuple[np.ndarray, ...]:
        """Distinct neighbours of which the first is known, in the order of their shards; all unknown second words are one.

        Returns per pair its shard, context code and successor code, whether its
        context is stored in parts, its training count here, and for every token the pair's number or -1.
        """
        size = len(self.codes)
        known = count[self.before] > 0
        both = self.before * size + np.where(count[self.tokens] > 0, self.tokens, size - 1)
        distinct, place = np.unique(both[known], return_inverse=True)
        u, w = distinct // size, distinct % size
        hot = count[u] > hot_from
        group = np.where(w == size - 1, 0, successor_class(self.codes[w]))
        shard, context = address(self.codes[u], np.where(hot, group + 1, 0), shards)
        successor = (self.codes[w] >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((successor, context, shard))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        trained = np.bincount(place[self.train[self.row[known]]], minlength=len(distinct))
        which = np.full(len(self.tokens), -1, np.int64)
        which[known] = rank[place]
        total = np.where(hot, count[u], 0)
        return shard[order], context[order], successor[order], total[order], trained[order], which


def successor_class(codes: np.ndarray) -> np.ndarray:
    return ((codes * _MIX) >> np.uint64(60)).astype(np.int64) % CLASSES


def address(codes: np.ndarray, part: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and context code of a word as context: as a whole (part 0), or of one of its parts."""
    own = (codes + part.astype(np.uint64)) * _MIX
    own ^= own >> np.uint64(32)
    return ((own & np.uint64(0xFFFFF)) % np.uint64(shards)).astype(np.int64), own >> np.uint64(64 - CONTEXT_BITS)


def _ask_words(chunks: DataFrame, shards: int) -> DataFrame:
    """Each chunk's vocabulary, cut into shards by code, with its training counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                counts = c.word_counts().astype("<u4")
                shard = (c.vocabulary >> np.uint64(40)).astype(np.int64) * shards >> 24
                at = np.searchsorted(shard, np.arange(shards + 1))
                full = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["chunk"])),
                    pa.array([c.vocabulary[at[s]: at[s + 1]].tobytes() for s in full], pa.binary()), pa.array([counts[at[s]: at[s + 1]].tobytes() for s in full], pa.binary())],
                    names=["shard", "chunk", "codes", "counts"])

    return mapped(chunks, work, "shard int, chunk long, codes binary, counts binary")


def _count_words(table: pa.Table) -> pa.Table:
    """Of one shard: the total count of every word asked for, per asking chunk; and one row of sums."""
    codes = [np.frombuffer(b, "<u8") for b in table["codes"].to_pylist()]
    every, place = np.unique(np.concatenate(codes), return_inverse=True)
    counts = np.concatenate([np.frombuffer(b, "<u4") for b in table["counts"].to_pylist()])
    total = np.bincount(place, counts, len(every)).astype(np.int64)
    answers = np.split(total[place].astype("<u8"), np.cumsum([len(c) for c in codes])[:-1])
    sums = np.array([(total > 0).sum(), total.sum(), (total == 1).sum(), (total == 2).sum()])
    rows = len(codes)
    return pa.table({
        "shard": pa.array([*table["shard"].to_pylist(), table["shard"][0].as_py()], pa.int32()), "chunk": pa.array([*table["chunk"].to_pylist(), None], pa.int64()),
        "answer": pa.array([*(a.tobytes() for a in answers), None], pa.binary()), "sums": pa.array([*[None] * rows, sums.astype(np.int64).tolist()], pa.list_(pa.int64()))})


def _ask_pairs(rows: DataFrame, model: dict, shards: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                shard, context, successor, total, trained, _ = c.pairs(_counts(row, model), model["hot_from"], shards)
                at = np.searchsorted(shard, np.arange(shards + 1))
                full = np.flatnonzero(np.diff(at))
                cut = lambda a, kind: pa.array([a[at[s]: at[s + 1]].astype(kind).tobytes() for s in full], pa.binary())  # noqa: E731, B023
                # contexts repeat: they go once each, with how many pairs follow
                lead = np.ones(len(shard), bool)
                lead[1:] = (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])
                run = np.diff(np.append(np.flatnonzero(lead), len(shard)))
                head = np.concatenate([[0], np.cumsum(lead)])[at]
                cut_head = lambda a, kind: pa.array([a[head[s]: head[s + 1]].astype(kind).tobytes() for s in full], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([
                    pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["chunk"])), cut_head(context[lead], "<u8"), cut_head(run, "<u4"),
                    cut_head(total[lead], "<u8"), cut(successor, "<u4"), cut(trained, "<u4")],
                    names=["shard", "chunk", "contexts", "runs", "totals", "successors", "counts"])

    return mapped(rows, work, "shard int, chunk long, contexts binary, runs binary, totals binary, successors binary, counts binary")


ANSWERS = "shard int, chunk long, codes binary, backoffs binary, parts binary, kinds binary"


def _answer_pairs(table: pa.Table) -> pa.Table:
    """Of one shard: build the trie from all training counts, then look up every pair asked for.

    One more row has the parts of very frequent contexts that lie here, with the
    number of distinct successors of each.
    """
    read = lambda name, kind: [np.frombuffer(b, kind) for b in table[name].to_pylist()]
    runs, successors = np.concatenate(read("runs", "<u4")).astype(np.int64), read("successors", "<u4")
    contexts, run_of = np.unique(np.concatenate(read("contexts", "<u8")), return_inverse=True)
    whole = np.zeros(len(contexts), np.int64)  # a context in parts: its count over all of them
    whole[run_of] = np.concatenate(read("totals", "<u8"))
    asked, count = np.concatenate(successors), np.concatenate(read("counts", "<u4")).astype(np.int64)
    # every chunk's pairs are in order already, so a stable sort has only to merge them
    key = (np.repeat(run_of, runs).astype(np.uint64) << np.uint64(32)) | asked
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key, n = key[first], np.add.reduceat(count[order], first)
    key, n = key[n > 0], n[n > 0]
    rank = (key >> np.uint64(32)).astype(np.int64)
    kinds, own = np.bincount(rank, minlength=len(contexts)), np.bincount(rank, n, len(contexts))
    parted = whole > 0
    whole = np.where(parted, whole, own)
    seen = kinds > 0
    trie = Trie(contexts[seen].astype(np.int64), kinds[seen], key.astype(np.uint32), (n - DISCOUNT) / whole[rank], back_off(kinds[seen], whole[seen]), CONTEXT_BITS)
    code, back = trie.query(contexts[run_of].astype(np.int64), runs, asked)
    cuts = np.cumsum([len(x) for x in successors])[:-1]
    shard, none = table["shard"].to_pylist(), [None] * table.num_rows
    return pa.table({
        "shard": pa.array([*shard, shard[0]], pa.int32()), "chunk": pa.array([*table["chunk"].to_pylist(), None], pa.int64()),
        "codes": pa.array([*(c.tobytes() for c in np.split(code, cuts)), None], pa.binary()), "backoffs": pa.array([*(b.tobytes() for b in np.split(back, cuts)), None], pa.binary()),
        "parts": pa.array([*none, contexts[parted].astype("<u8").tobytes()], pa.binary()), "kinds": pa.array([*none, kinds[parted].astype("<u8").tobytes()], pa.binary())})


def back_off(kinds: np.ndarray, count: np.ndarray) -> np.ndarray:
    """What a context leaves to the single words: a discount for each distinct successor."""
    return DISCOUNT * kinds / count


def _parted(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Successor kinds of all parts of very frequent contexts, by shard and context code.

    There are fewer such contexts than twice the shards, as each has more than
    that share of all tokens, and ``CLASSES`` parts of each.
    """
    rows = answers.filter("chunk IS NULL AND octet_length(parts) > 0").select("shard", "parts", "kinds").collect()
    at = np.concatenate([np.zeros(0, np.uint64), *((np.uint64(r["shard"]) << np.uint64(CONTEXT_BITS)) | np.frombuffer(r["parts"], "<u8") for r in rows)])
    kinds = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["kinds"], "<u8") for r in rows)]).astype(np.int64)
    order = np.argsort(at)
    return at[order], kinds[order]


def _counts(row: dict, model: dict) -> np.ndarray:
    """Training counts of the chunk's words, then of the end, the start and unknown words."""
    parts = [np.frombuffer(a["answer"], "<u8") for a in sorted(row["words"], key=lambda a: a["shard"])] if row["words"] else []
    return np.concatenate([*parts, [model["texts"], model["texts"], 0]]).astype(np.int64)


def _score_chunk(row: dict, model: dict, shards: int) -> pa.RecordBatch:
    c = Chunk(row)
    count = _counts(row, model)
    n, v, d = model["tokens"], model["kinds"], model["discount"]
    own = count[c.tokens]
    base = np.log10((own + 1) / (n + v + 1))
    single = np.where(own > 0, (own - d) / max(n, 1), d * v / max(n, 1)) if n else np.full(len(own), 1.0)
    chance = single.copy()
    which = c.pairs(count, model["hot_from"], shards)[5]
    answers = sorted(row["pairs"], key=lambda a: a["shard"]) if row["pairs"] else []
    code = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(a["codes"], np.uint8) for a in answers)])
    back = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(a["backoffs"], np.uint8) for a in answers)])
    asked = which >= 0  # all but the words after an unknown one
    left = np.append(value(back), 0.0)[which]
    hot = np.flatnonzero(count > model["hot_from"])
    if len(hot):
        # a context in parts leaves what all its parts leave, by the formula of every other context
        shard, context = address(np.repeat(c.codes[hot], CLASSES), np.tile(np.arange(1, CLASSES + 1), len(hot)), shards)
        key = (shard.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | context
        at, kinds = model["parted"]
        place = np.minimum(np.searchsorted(at, key), max(0, len(at) - 1))
        of = np.zeros(len(count))
        if len(at):
            of[hot] = value(quantise(back_off(np.where(at[place] == key, kinds[place], 0).reshape(-1, CLASSES).sum(1), count[hot])))
        parted = (count > model["hot_from"])[c.before]
        left[parted] = of[c.before][parted]
    chance[asked] = value(code[which[asked]]) + left[asked] * single[asked]
    score = np.log10(np.maximum(chance, 1e-300))
    texts = len(c.lengths)
    add = lambda x: np.bincount(c.row, x, texts)
    return pa.RecordBatch.from_arrays([
        pa.array(row["doc_ids"], pa.int64()), pa.array((~c.train).tolist(), pa.bool_()), pa.array(c.lengths + 1), pa.array(add(own > 0).astype(np.int64)),
        pa.array(np.full(texts, n, np.int64)), pa.array(add(base)), pa.array(add(score))],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", parts: int = 7, held_part: int = 2, chunk: int = CHUNK,
                    hot_from: float | None = None) -> DataFrame:
    """log10 probability of every whole text under a bigram model of the training texts.

    Tokens are words between white space, A-Z in lower case, and one end per
    text. The model takes ``DISCOUNT`` from every bigram count and gives what
    is left to the discounted word frequencies, in which all unknown words are
    one. Words and pairs are coded by hashes. Counts come from all texts outside
    the held-out part.

    Texts are written once as chunks. Chunks ask the shards of the vocabulary
    for their words' counts, and then the shards of the bigrams for their
    pairs: a pair travels once per chunk, with its training count, which serves
    both to build the shard's trie and to be looked up in it. A context with
    more than its share of all tokens (``hot_from``) is stored in parts by
    classes of its successors, so no shard grows with one word; it backs off by
    the same formula as all others, from the sum over its parts, so that no
    score depends on the number of shards.

    NULL text counts as empty and scores its end alone. A missing id counts as
    an empty text when parts are dealt. Repeated rows all count and each get a
    row. Without training texts the score is 0 and every word unknown.
    """
    spark = docs.sparkSession
    n_parts = shuffle_partitions(spark)
    shards = 4 * n_parts
    rows = doc_columns(docs, text_col, id_col).select("doc_id", (fold(F.col("doc_id"), parts) != held_part).alias("train"), "text")
    name = f"starloom_chunks_{uuid.uuid4().hex}"
    chunked(rows, chunk).write.option("compression", "zstd").bucketBy(n_parts, "chunk").saveAsTable(name)
    chunks = spark.table(name)
    try:
        counted = stage(_ask_words(chunks, shards).groupBy("shard").applyInArrow(_count_words, "shard int, chunk long, answer binary, sums array<long>"), "words")
        sums = counted.filter("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s"))
        got = {r[0]: int(r[1]) for r in sums.collect()}  # four numbers
        texts = rows.agg(F.sum(F.col("train").cast("long"))).first()[0] or 0
        model = _model([got.get(i, 0) for i in range(4)], texts, hot_from or got.get(1, 0) / (2 * shards))
        by_chunk = counted.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("shard", "answer")).alias("words"))
        known = chunks.join(by_chunk, "chunk", "left")
        answers = stage(_ask_pairs(known, model, shards).groupBy("shard").applyInArrow(_answer_pairs, ANSWERS), "answers")
        model["parted"] = _parted(answers)
        paired = answers.filter("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("shard", "codes", "backoffs")).alias("pairs"))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield _score_chunk(batch.slice(i, 1).to_pylist()[0], model, shards)

        scores = stage(mapped(known.join(paired, "chunk", "left"), work, SCORE), "scores")
        drop_staged(counted, answers)
        return scores
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _model(sums: list[int], texts: int, hot_from: float) -> dict:
    """Totals over the vocabulary with the end in it."""
    kinds, tokens, once, twice = sums
    if texts:
        kinds, tokens, once, twice = kinds + 1, tokens + texts, once + (texts == 1), twice + (texts == 2)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    return {"kinds": kinds, "tokens": tokens, "texts": texts, "discount": discount, "hot_from": hot_from}
