"""Phrase collocations by dynamic itemset counting over cyclic scans of shards."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.shared import LOWER, UPPER, drop_staged, mapped, raw, shuffle_partitions, slices, stage, words

LEAST, LONGEST, TOP = 30, 4, 2000
SHARDS = 4  # parts of the corpus; a phrase is counted on as many scans in a row, whichever comes first
CHUNK = 1_000_000  # tokens of one chunk; a longer text is a chunk of its own
SLOTS = 1 << 24  # bytes of the activation table, which every Python worker holds
CONTAINED = 80  # a phrase goes if a longer one around it has that many hundredths of its occurrences
NEVER = 255
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_BREAKS, _GAPS = ".,;:!?\n\x0b\x0c\r", " \t"
_TABLE = bytes(32 if chr(b) in _BREAKS + _GAPS else b for b in bytes.maketrans(UPPER.encode(), LOWER.encode()))
_BREAK = np.array([chr(b) in _BREAKS for b in range(256)])
_SPACE = np.array([chr(b) in _BREAKS + _GAPS for b in range(256)])

CHUNKS = "cycle int, chunk long, langs array<string>, totals array<long>, words array<string>, lang_of binary, keys binary, sequence binary"
COUNTS = "shard int, chunk long, keys binary, counts binary, active binary"
STATE = "shard int, keys binary, counts binary, active binary, homes binary, hits binary, opened long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _key(left: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
    """Key of the phrases whose first and last k - 1 words have these keys: 62 bits of hash, and k - 1."""
    return _mixed(left * _MIX[0] + right) & ~np.uint64(3) | np.uint64(k - 1)


def _slots(keys: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(2)) % np.uint64(slots), (keys >> np.uint64(33)) % np.uint64(slots)


def _activated(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The scan from which a phrase is known to be frequent, ``NEVER`` if it is not.

    Two phrases can share both slots. Then one counts as frequent too early, in
    all tasks and from the same scan on: its extensions are counted in vain, but
    over a whole cycle, so no count changes.
    """
    a, b = _slots(keys, len(table))
    return np.maximum(table[a], table[b])


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-case words of the texts, how many each text has, and whether a word begins a piece."""
    flat, counts = words(texts, _TABLE)
    offsets, data = raw(texts)
    chars = np.frombuffer(data, np.uint8)
    space = _SPACE[chars]
    start = ~space
    start[1:] &= space[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    start[heads] = ~space[heads]
    piece = np.cumsum(_BREAK[chars])[start]
    new = np.ones(len(piece), bool)
    new[1:] = piece[1:] != piece[:-1]
    first = np.cumsum(counts) - counts
    new[first[counts > 0]] = True
    return flat, counts, new


def chunked(rows: DataFrame, chunk: int = CHUNK, shards: int = SHARDS) -> DataFrame:
    """Texts as chunks of about ``chunk`` tokens: the distinct words of each language, and the text as places among them.

    Place ``len(words)`` parts the pieces. ``cycle`` is the shard of the chunk.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, held, langs, total = TaskContext.get().partitionId(), 0, [], {}, 0
        for batch in slices(batches, "text"):
            flat, counts, new = tokens(batch.column("text"))
            own = np.array([langs.setdefault(lang, len(langs)) for lang in batch.column("lang").to_pylist()], np.int64)
            held.append((flat.dictionary_encode(), np.repeat(own, counts), new))
            total += len(flat)
            if total >= chunk:
                yield _chunk(held, list(langs), (part + n) % shards, (part << 32) + n)
                n, held, langs, total = n + 1, [], {}, 0
        if total:
            yield _chunk(held, list(langs), (part + n) % shards, (part << 32) + n)

    return mapped(rows, work, CHUNKS)


def _chunk(held: list[tuple], langs: list[str], cycle: int, number: int) -> pa.RecordBatch:
    from xxhash import xxh3_64_intdigest as digest

    books = [coded.dictionary for coded, _, _ in held]
    both = pa.concat_arrays(books).dictionary_encode()
    at, begin, place = both.indices.to_numpy(zero_copy_only=False), 0, []
    for (coded, _, _), book in zip(held, books):
        place.append(at[begin + coded.indices.to_numpy(zero_copy_only=False)])
        begin += len(book)
    size = len(both.dictionary)
    pair = np.concatenate([lang for _, lang, _ in held]) * size + np.concatenate(place)
    used = np.zeros(len(langs) * size, bool)
    used[pair] = True
    local = (np.cumsum(used) - 1)[pair]
    kinds = np.flatnonzero(used)
    lang_of, own = kinds // size, both.dictionary.take(pa.array(kinds % size))
    lead = pa.array([f"{len(lang)}:{lang}" for lang in langs]).take(pa.array(lang_of))
    keys = np.fromiter(map(digest, pc.binary_join_element_wise(lead, own, "").cast(pa.binary()).to_pylist()), np.uint64, len(own)) & ~np.uint64(3)
    sequence = np.insert(local, np.flatnonzero(np.concatenate([new for _, _, new in held])), len(own))
    return pa.RecordBatch.from_arrays([
        pa.array([cycle], pa.int32()), pa.array([number], pa.int64()), pa.array([langs], pa.list_(pa.string())),
        pa.array([np.bincount(lang_of[local], minlength=len(langs)).tolist()], pa.list_(pa.int64())), pa.array([own.to_pylist()], pa.list_(pa.string())),
        *(pa.array([a.astype(kind).tobytes()], pa.binary()) for a, kind in ((lang_of, "<u4"), (keys, "<u8"), (sequence, "<u4")))],
        names=["cycle", "chunk", "langs", "totals", "words", "lang_of", "keys", "sequence"])


def _phrases(keys: np.ndarray, sequence: np.ndarray, table: np.ndarray, scan: int) -> Iterator[tuple]:
    """Per length: keys, counts, scan of activation and first place of the chunk's phrases that are active in ``scan``.

    Words are active from the first scan; a longer phrase from the scan after
    the one in which the later of its two subphrases became frequent.
    """
    size = len(keys)
    counts = np.bincount(sequence, minlength=size + 1)[:size]
    first = np.zeros(size, np.int64)
    first[sequence[::-1][sequence[::-1] < size]] = np.flatnonzero(sequence[::-1] < size)
    first = len(sequence) - 1 - first
    yield 1, keys, counts, np.zeros(size, np.uint8), first
    known = np.append(_activated(keys, table), np.uint8(NEVER))
    at = np.where(known[sequence] <= scan, sequence, -1)
    for k in range(2, LONGEST + 1):
        place = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
        if not len(place):
            return
        both, lead, back, counts = np.unique(at[place] * np.int64(len(keys)) + at[place + 1], return_index=True, return_inverse=True, return_counts=True)
        left, right = both // len(keys), both % len(keys)
        active = np.maximum(known[left], known[right])
        keys = _key(keys[left], keys[right], k)
        yield k, keys, counts, active, place[lead]
        known = np.maximum(active, _activated(keys, table))  # a shared slot must not make a phrase known before it is active
        at = np.full(len(at), -1, np.int64)
        on = known[back] <= scan
        at[place[on]] = back[on]


def _packed(table: np.ndarray) -> bytes:
    """The activation table as it travels: long runs of ``NEVER`` take no room."""
    return pa.compress(table.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, slots: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, slots, "zstd"), np.uint8)


def _scan(chunks: DataFrame, packed: bytes, slots: int, scan: int, cycle: int, parts: int) -> DataFrame:
    """Counts in this scan of all phrases that are active and not yet through their cycle, packed by shard of their keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _unpacked(packed, slots)
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                for _, keys, counts, active, _ in _phrases(np.frombuffer(row["keys"], "<u8"), np.frombuffer(row["sequence"], "<u4").astype(np.int64), now, scan):
                    open_ = active.astype(np.int64) + cycle > scan
                    found.append((keys[open_], counts[open_], active[open_]))
                keys, counts, active = (np.concatenate(x) for x in zip(*found))
                shard = ((keys >> np.uint64(44)).astype(np.int64) * parts) >> 20
                order = np.argsort(shard, kind="stable")
                at = np.searchsorted(shard[order], np.arange(parts + 1))
                full = np.flatnonzero(np.diff(at))
                cut = lambda a, kind: pa.array([a[order[at[s]: at[s + 1]]].astype(kind).tobytes() for s in full], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["chunk"])), cut(keys, "<u8"), cut(counts, "<u4"), cut(active, "u1")],
                    names=["shard", "chunk", "keys", "counts", "active"])

    return mapped(chunks.filter(F.col("cycle") == scan % cycle).select("chunk", "keys", "sequence"), work, COUNTS)


def _merge(scan: int, cycle: int, slots: int, least: int):
    """Add one scan's counts to a shard's state; phrases that end their cycle below ``least`` leave it.

    A phrase that has become frequent remembers a chunk that holds it, its home.
    """

    def work(old: pa.Table, new: pa.Table) -> pa.Table:
        read = lambda t, name, kind: [np.frombuffer(b, kind) for b in t[name].to_pylist()]
        shard = (old if old.num_rows else new)["shard"][0].as_py()
        keys, place = np.unique(np.concatenate(read(old, "keys", "<u8") + read(new, "keys", "<u8")), return_inverse=True)
        before = np.zeros(len(keys), np.int64)
        had = read(old, "counts", "<u8")
        size = sum(map(len, had))
        before[place[:size]] = np.concatenate([np.zeros(0, np.uint64), *had])
        added = np.concatenate([np.zeros(0, np.uint32), *read(new, "counts", "<u4")])
        counts = before + np.bincount(place[size:], added, len(keys)).astype(np.int64)
        active = np.zeros(len(keys), np.uint8)
        np.maximum.at(active, place, np.concatenate(read(old, "active", "u1") + read(new, "active", "u1")))
        often = counts >= least
        homes = np.zeros(len(keys), np.int64)
        asked = read(new, "keys", "<u8")
        homes[place[size:]] = np.repeat(np.array(new["chunk"].to_pylist(), np.int64), [len(k) for k in asked])
        homes[(before >= least)] = np.concatenate([np.zeros(0, np.int64), *read(old, "homes", "<i8")])  # both in the order of keys
        fresh = keys[often & (before < least)]
        hit = np.concatenate(_slots(fresh, slots))
        stay = often | (active.astype(np.int64) + cycle - 1 > scan)
        out = [(keys[stay], "<u8"), (counts[stay], "<u8"), (active[stay], "u1"), (homes[often], "<i8"), (np.unique(hit), "<u4")]
        opened = int((fresh & np.uint64(3) < LONGEST - 1).sum())  # those that longer phrases can be made of
        return pa.table({"shard": pa.array([shard], pa.int32()), **{
            n: pa.array([a.astype(kind).tobytes()], pa.binary()) for n, (a, kind) in zip(("keys", "counts", "active", "homes", "hits"), out)}, "opened": pa.array([opened])})

    return work


def _newly_set(state: DataFrame, slots: int) -> Iterator[tuple[int, np.ndarray]]:
    """The slots that this scan's hits set, as a bit per slot: first slot and bits of each range."""
    width = min(slots, 1 << 16)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hits in batch.column("hits").to_pylist():
                at = np.frombuffer(hits, "<u4").astype(np.int64)
                cuts = np.searchsorted(at, np.arange(0, slots + width, width))
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)), pa.array([(at[cuts[i]: cuts[i + 1]] - i * width).astype("<u4").tobytes() for i in full], pa.binary())], names=["nth", "slots"])

    def bits(rows: pa.Table) -> pa.Table:
        on = np.zeros(width, np.uint8)
        on[np.concatenate([np.frombuffer(b, "<u4") for b in rows["slots"].to_pylist()])] = 1
        return pa.table({"nth": rows["nth"].slice(0, 1), "bits": pa.array([np.packbits(on).tobytes()], pa.binary())})

    cut = mapped(state.select("hits"), split, "nth int, slots binary")
    for row in cut.groupBy("nth").applyInArrow(bits, "nth int, bits binary").collect():  # a bit per slot at most
        yield row["nth"] * width, np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:width].astype(bool)


def _at_home(state: DataFrame, least: int) -> DataFrame:
    """Keys and counts of the frequent phrases, packed by home: ``chunk, found``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts, homes = np.frombuffer(row["keys"], "<u8"), np.frombuffer(row["counts"], "<u8"), np.frombuffer(row["homes"], "<i8")
                keys, counts = keys[counts >= least], counts[counts >= least]
                order = np.argsort(homes, kind="stable")
                chunk, first = np.unique(homes[order], return_index=True)
                cuts = [*first.tolist(), len(order)]
                cut = lambda a: pa.array([a[order[i:j]].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([pa.array(chunk), cut(keys), cut(counts)], names=["chunk", "keys", "counts"])

    packed = mapped(state.select("keys", "counts", "homes"), work, "chunk long, keys binary, counts binary")
    return packed.groupBy("chunk").agg(F.collect_list(F.struct(F.col("keys").alias("k"), F.col("counts").alias("c"))).alias("found"))


def _spelt(chunks: DataFrame, home: DataFrame, packed: bytes, slots: int) -> DataFrame:
    """The phrases behind the keys, each from its home, with their counts. Chunks lie in buckets, so only keys move."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = _unpacked(packed, slots)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("langs", "lang_of", "keys", "sequence", "found")}
                asked, a = (np.concatenate([np.frombuffer(f[n], "<u8") for f in row["found"]]) for n in "kc")
                order = np.argsort(asked)
                asked, a = asked[order], a[order].astype(np.int64)
                own, sequence = batch.column("words")[i].values, np.frombuffer(row["sequence"], "<u4").astype(np.int64)
                langs, lang_of = pa.array(row["langs"], pa.string()), np.frombuffer(row["lang_of"], "<u4")
                for k, keys, _, _, place in _phrases(np.frombuffer(row["keys"], "<u8"), sequence, now, NEVER - 1):
                    spot = np.minimum(np.searchsorted(asked, keys), len(asked) - 1)
                    on = asked[spot] == keys
                    at = sequence[place[on][:, None] + np.arange(k)]
                    phrase = own.take(pa.array(at[:, 0]))
                    for j in range(1, k):
                        phrase = pc.binary_join_element_wise(phrase, own.take(pa.array(at[:, j])), " ")
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(lang_of[at[:, 0]])), phrase, pa.array(np.full(len(at), k, np.int32)), pa.array(a[spot[on]])], names=["lang", "phrase", "k", "a"])

    both = chunks.select("chunk", "langs", "words", "lang_of", "keys", "sequence").join(home, "chunk")
    return mapped(both, work, "lang string, phrase string, k int, a long")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                     chunk: int = CHUNK, cycle: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, a`` of all phrases of one to four words that occur ``least`` times, and ``lang, n`` of all words.

    The corpus is cut into ``cycle`` shards, which are scanned one after
    another, over and over. One scan counts phrases of all lengths that are
    active in it. Words are active from the start; a longer phrase as soon as
    the counts so far of both its subphrases (without its last and without its
    first word) reach ``least``; each is counted on ``cycle`` scans in a row,
    which is once over the whole corpus, wherever it began. Scans end when no
    phrase can be inside its cycle any more, after four cycles at most.

    Counts lie in a table bucketed by shards of the keys, one packed row per
    shard, which a scan rewrites; infrequent phrases leave it after their cycle.
    Which phrases became frequent is known to the next scan by a table of
    ``slots`` bytes, two per phrase, so what is sent to the workers never grows;
    where slots are shared, phrases are activated too early, never too late.
    A frequent phrase is spelt by one chunk that holds it. Keys have 62 bits: of
    two billion phrases in the tables, one in 300 runs has a frequent one that
    shares its key and counts too much.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    table, scan, last = np.full(slots, NEVER, np.uint8), 0, -1
    name = lambda i: f"starloom_phrases_{mark}_{i}"
    mark, held = uuid.uuid4().hex, []
    try:
        chunked(rows, chunk, cycle).write.option("compression", "zstd").partitionBy("cycle").bucketBy(parts, "chunk").saveAsTable(name("chunks"))
        chunks = spark.table(name("chunks"))
        spark.createDataFrame([], STATE).write.bucketBy(parts, "shard").saveAsTable(name("empty"))
        held.append(name("empty"))
        while scan < cycle or last + cycle >= scan:
            new = _scan(chunks, _packed(table), slots, scan, cycle, 4 * parts)
            both = spark.table(held[-1]).groupBy("shard").cogroup(new.groupBy("shard"))
            held.append(name(scan))
            both.applyInArrow(_merge(scan, cycle, slots, least), STATE).write.option("compression", "zstd").bucketBy(parts, "shard").saveAsTable(held[-1])
            spark.sql(f"DROP TABLE {held.pop(0)}")
            if spark.table(held[-1]).agg(F.sum("opened")).first()[0]:
                last = scan + 1
            for begin, on in _newly_set(spark.table(held[-1]), slots):
                own = table[begin: begin + len(on)]
                own[on & (own == NEVER)] = scan + 1
            scan += 1

        home = stage(_at_home(spark.table(held[-1]), least), "homes")
        found = stage(_spelt(chunks, home, _packed(table), slots), "phrases")
        pairs = chunks.select(F.explode(F.arrays_zip("langs", "totals")).alias("x"))
        totals = stage(pairs.groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.totals").alias("n")), "totals")
        drop_staged(home)
        return found, totals
    finally:
        for one in [*held, name("chunks")]:
            spark.sql(f"DROP TABLE IF EXISTS {one}")


def _cuts(found: DataFrame) -> DataFrame:
    """Per phrase its lowest-scoring cut: ``l, r, score``; equal scores go to the shorter first part."""
    word = F.split("phrase", " ")
    longer = found.filter("k > 1").select("lang", "phrase", "a", word.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("j"))
    side = F.array(
        F.struct(F.lit("l").alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("j")), " ").alias("part")),
        F.struct(F.lit("r").alias("side"), F.array_join(F.slice("w", F.col("j") + 1, F.size("w")), " ").alias("part")))
    asked = longer.select("lang", "phrase", "a", "j", F.explode(side).alias("x")).select("lang", "phrase", "a", "j", "x.side", "x.part")
    counts = found.select(F.col("lang"), F.col("phrase").alias("part"), F.col("a").alias("f"))
    each = asked.join(counts, ["lang", "part"]).groupBy("lang", "phrase", "a", "j").agg(
        *(F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in "lr"))
    score = F.expr("cast(2000000 * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)")
    return each.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "j", "l", "r")).alias("x")).select(
        "lang", "phrase", "a", "x.l", "x.r", "x.score")


def _contained(found: DataFrame) -> DataFrame:
    """Per phrase the most occurrences that a longer phrase around it has: ``lang, phrase, around``."""
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: F.array_join(F.slice(F.split("phrase", " "), i, n), " "))))
    return found.filter("k > 2").select("lang", "a", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("around"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, contained: int = CONTAINED,
                 chunk: int = CHUNK, cycle: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The ``top`` phrases of two to four words of every language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts (A-Z in lower case) are split at ``. , ; : ! ?`` and line breaks into
    pieces, and those at spaces and tabs into words; phrases lie inside a piece.
    ``a, l, r`` are occurrences of the phrase and of the two parts of its cut
    with the lowest ``score`` (two millions of ``a`` over ``l + r``, floored).
    A phrase inside a longer one with nearly as many occurrences is left out.
    Order: score, then occurrences, then the phrase by its bytes.

    NULL text has no words and a NULL language counts as ``und``; repeated rows
    count each; ties are all ordered; without a frequent phrase, and for an
    empty table, there are no rows. Texts of any length count whole.
    """
    found, totals = frequent_phrases(docs, text_col, lang_col, least, chunk, cycle, slots)
    rows = _cuts(found).join(_contained(found), ["lang", "phrase"], "left")
    rows = rows.filter(F.col("around").isNull() | (F.col("around").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * contained))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = rows.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(shuffle_partitions(docs.sparkSession))))
    # the first of every share of a language, and the first of those
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
