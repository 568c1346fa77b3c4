"""Phrase collocations by dynamic itemset counting.

Texts are cut into words once and dealt to ``SHARDS`` shards, which are scanned one after the other, round
and round. All words are counted from the start. A longer phrase becomes active as soon as both its
subphrases, all words but the last and all but the first, have been counted ``least`` times, however far
their own counts have come; it is counted in the shards from there on and is complete after one full cycle,
when it has seen every shard once. So phrases of different lengths are counted in the same scans, and the
scans end with the first after which no phrase is left incomplete. Counts never shrink as a phrase
loses words, so no phrase that reaches ``least`` is missed.

A scan finds in its texts which phrases to count by two bit tables of fixed size, broadcast: hashes of
all phrases that have reached ``least``, and of those that did so within the last cycle. A phrase whose
parts are all in the first and not both complete is counted, under its 64-bit hash. A false hit may count
a phrase outside its cycle, which changes nothing: its count in a shard is the same whenever the shard is
scanned, and is taken once per shard.

Which phrases have reached ``least`` is asked after every scan. One that has must have an equal share of it
in some shard at least, so phrases without such a count anywhere are passed over before they are gathered:
by a bit table once more, a join with a frame of fixed size. Only counts of the others are shuffled again.

Tasks take the chunks of texts one at a time, find phrases a stretch of a chunk at a time and add up what they
tell within a fixed number of bytes, so that a task's memory does not grow with its share of the texts.

Hashes only choose. A last scan of all shards spells out the phrases that have reached ``least`` and counts
them as they are spelled, so what is returned is exact.

Everything is per language, a null one ``und``. Nulls and edges: null and empty texts have no words;
repeated rows count each; an empty table gives no rows. Identifiers and extra columns are not read.
"""

from __future__ import annotations

import math
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import settled, sifted, table
from kerbside.session import job_session, scratch_dir
from kerbside.sources import paths

SHARDS = 3
LONGEST = 5
LEAST = 100
SCALE = 1000
TOP = 2000
TABLE_BITS = 2**24  # of each bit table of a scan
SIFT_BITS = 2**22  # of the one that sifts counts
SEED = 42
#: ASCII letters in lower case, and one mark for all that ends a piece. No word holds the mark.
MARK = b"."
SPELLED = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\v\f\r", bytes(range(97, 123)) + MARK * 9)
HASHED = "hash long, n_words int, n long"
SPELLED_OUT = "lang string, phrase binary, n_words int, n long"
CHUNK = 2**23  # bytes of text that are cut into words together
BATCH = 2**22  # bytes that Python gets at once, or a row if it has more
STRETCH = 2**19  # words of a chunk in which phrases are found together
HELD = 2**25  # bytes of phrases and counts that a task sums up before it tells them
WAVES = 2  # tasks a core in the last scan
CHUNKS = "lang string, words array<binary>, hashes binary, codes binary, shard int"


def tokens(text: bytes) -> list[bytes]:
    """The words in order, with ``MARK`` between pieces."""
    return text.translate(SPELLED).replace(MARK, b" . ").split()  # of spaces and tabs, as no others are left


def word_hash(lang: str) -> Callable[[bytes], int]:
    """A language's words as 64-bit hashes."""
    seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
    return lambda word: xxhash.xxh64_intdigest(word, seed)


def joined_hash(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all but its last word, and the last word's."""
    return head << np.uint64(7) ^ head >> np.uint64(57) ^ word


def lean_session(spark: SparkSession) -> SparkSession:
    """A session of the job's own that hands Python a chunk, or some megabytes of texts, at a time.

    A batch is held on both sides, and texts or chunks of 64 MB, Spark's own bound, at once in each task take
    more than the work on them.
    """
    own = job_session(spark)
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
    return own


class BitTable:
    """Which hashes are in a set, with false hits and no false misses."""

    def __init__(self, table: np.ndarray):
        self.table, self.bits, self.empty = table, 8 * len(table), not table.any()

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % np.uint64(self.bits)
        return self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def chunk_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different words of some texts, ``MARK`` first, and the texts as numbers of words."""
    number: dict[bytes, int] = defaultdict(lambda: len(number))
    codes = array("i")
    for text in texts:  # one at a time, as a word takes ten times its bytes while it is an object
        codes.append(number[MARK])
        codes.extend(map(number.__getitem__, tokens(text)))
    return list(number), np.array(codes, np.int32)


def chunks(docs: DataFrame, shards: int = SHARDS, size: int = CHUNK) -> DataFrame:
    """Rows of ``CHUNKS``: the texts of a task cut into words, some ``size`` bytes of a language to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)
        shard = TaskContext.get().partitionId()

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal shard
            words, codes = chunk_of(held.pop(lang))
            sizes.pop(lang)
            hashes = np.fromiter(map(word_hash(lang), words), np.uint64, len(words))
            shard += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]), pa.array([words], pa.list_(pa.binary())), pa.array([hashes.tobytes()]),
                    pa.array([codes.tobytes()]), pa.array([shard % shards], pa.int32()),
                ],
                ["lang", "words", "hashes", "codes", "shard"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[lang].append(text.as_py())
                sizes[lang] += len(held[lang][-1])
                if sizes[lang] >= size:
                    yield flush(lang)
                elif sum(sizes.values()) >= 4 * size:
                    yield flush(max(sizes, key=sizes.get))
        for lang in sorted(held):
            yield flush(lang)

    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    return texts.mapInArrow(run, CHUNKS)


def places_of_phrases(
    hashes: np.ndarray, codes: np.ndarray, reached: BitTable, longest: int, stretch: int = STRETCH
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(n, places, hashes, of_parts) of the phrases of two words and more whose parts are all known.

    ``of_parts`` are the hashes of the two subphrases. Phrases that start in the same ``stretch`` words come
    together, so each n comes once a stretch.
    """
    for start in range(0, len(codes), stretch):
        part = codes[start : start + stretch + longest - 1]
        for n, place, hashed, parts in _places_in_stretch(hashes, part, reached, longest):
            own = np.searchsorted(place, stretch)  # places ascend; what starts later is the next stretch's
            yield n, place[:own] + start, hashed[:own], parts[:, :own]


def _places_in_stretch(
    hashes: np.ndarray, codes: np.ndarray, reached: BitTable, longest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The same, in all of ``codes``. Hashes are put together place by place."""
    place = np.nonzero(codes)[0]
    of_word = np.zeros(len(codes), np.uint64)
    of_word[place] = hashed = hashes[codes[place]]
    for n in range(2, longest + 1):
        known = reached.holds(hashed)
        # Places where a phrase of n - 1 words and its neighbour one word on are both known.
        both = np.nonzero((place[1:] == place[:-1] + 1) & known[1:] & known[:-1])[0]
        if not len(both):
            return
        parts = np.stack([hashed[both], hashed[both + 1]])
        place, hashed = place[both], joined_hash(hashed[both], of_word[place[both] + n - 1])
        yield n, place, hashed, parts


def _chunk(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    for lang, words, hashes, codes in zip(*batch.columns[:4]):
        yield lang.as_py(), words.values, np.frombuffer(hashes.as_py(), np.uint64), np.frombuffer(codes.as_py(), np.int32)


def scan_shard(shard: DataFrame, start: bool, reached: BitTable, recent: BitTable, longest: int) -> DataFrame:
    """(hash, n_words, n): one row per phrase to count of the shard's chunks.

    ``start`` is for scans that count words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(hashes: np.ndarray, n: int, occurrences: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)), pa.array(np.full(len(hashes), n, np.int32)),
                    pa.array(occurrences.astype(np.int64)),
                ],
                ["hash", "n_words", "n"],
            )

        for batch in batches:
            for _, _, hashes, codes in _chunk(batch):
                if start:
                    yield told(hashes[1:], 1, np.bincount(codes, minlength=len(hashes))[1:])
                if recent.empty:
                    continue
                for n, _, hashed, parts in places_of_phrases(hashes, codes, reached, longest):
                    counted = recent.holds(parts[0]) | recent.holds(parts[1])
                    kinds, occurrences = np.unique(hashed[counted], return_counts=True)
                    yield told(kinds, n, occurrences)

    return shard.mapInArrow(run, HASHED).groupBy("hash", "n_words").agg(F.sum("n").alias("n"))


def summed(counts: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Counts of ``SPELLED_OUT`` with those of equal phrases added up, at most ``most`` bytes at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    keys = ["lang", "phrase", "n_words"]
    for batch in counts:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            held = _added(held, keys)
            size = sum(b.nbytes for b in held)
            if size >= most * 3 // 4:  # adding up no longer helps
                yield from held
                held, size = [], 0
    if held:
        yield from _added(held, keys)


def _added(held: list[pa.RecordBatch], keys: list[str]) -> list[pa.RecordBatch]:
    # Threads would each hold sums of their own.
    added = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return added.select([*keys, "n_sum"]).rename_columns([*keys, "n"]).to_batches(max_chunksize=2**16)


def spelled(held: DataFrame, reached: BitTable, longest: int) -> DataFrame:
    """Rows of ``SPELLED_OUT``: each task's counts of the phrases whose hash is known.

    All words are counted under no phrase of 0 words. A task has a row per phrase, not per phrase and chunk.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, hashes, codes in _chunk(batch):

                def told(phrases: pa.Array, n: int, occurrences: np.ndarray, lang=lang) -> pa.RecordBatch:
                    total = len(phrases)
                    return pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang]).take(pa.array(np.zeros(total, np.int64))), phrases,
                            pa.array(np.full(total, n, np.int32)), pa.array(occurrences.astype(np.int64)),
                        ],
                        ["lang", "phrase", "n_words", "n"],
                    )

                of_words = np.bincount(codes, minlength=len(hashes))
                of_words[0] = 0
                yield told(pa.array([b""], pa.binary()), 0, of_words.sum(keepdims=True))
                known = np.nonzero(reached.holds(hashes) & (of_words > 0))[0]
                yield told(words.take(pa.array(known)), 1, of_words[known])
                for n, place, hashed, _ in places_of_phrases(hashes, codes, reached, longest):
                    at = place[reached.holds(hashed)]
                    code = codes[at].astype(np.int64)
                    for i in range(1, n):  # numbers of phrases one word longer, from those of the heads
                        kinds, first, code, occurrences = np.unique(
                            code * len(words) + codes[at + i],
                            return_index=True, return_inverse=True, return_counts=True,
                        )
                    ids = [pa.array(codes[at[first] + i]) for i in range(n)]
                    yield told(pc.binary_join_element_wise(*map(words.take, ids), b" "), n, occurrences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from summed(counts(batches), HELD)

    return held.mapInArrow(run, SPELLED_OUT)


def spelled_out(held: DataFrame, reached: BitTable, longest: int) -> DataFrame:
    """(lang, phrase, n_words, n) of phrases whose hash is known, and all words under no phrase of 0 words.

    Tasks are as many as the cluster runs in some waves, however many files there are, so that the rows grow
    with the phrases and not with their product with the chunks.
    """
    tasks = WAVES * held.sparkSession.sparkContext.defaultParallelism
    each = spelled(held.coalesce(tasks), reached, longest)
    counts = each.groupBy("lang", "phrase", "n_words").agg(F.sum("n").alias("n"))
    return counts.select("lang", F.col("phrase").cast("string").alias("phrase"), "n_words", "n")


def _part(first: str, length: str) -> str:
    """SQL for some of a phrase's words."""
    return f"array_join(slice(split(phrase, ' '), {first}, {length}), ' ')"


def totals(counted: list[DataFrame], least: int, shards: int) -> DataFrame:
    """(hash, n_words): phrases counted ``least`` times in some scans, each shard taken once.

    Only phrases that have ``least / shards`` in some shard can be. Their bits are a frame of at most
    ``SIFT_BITS / 64`` rows, which bounds what is broadcast; what it lets through is gathered.
    """
    every = reduce(DataFrame.unionByName, counted)
    heavy = every.filter(F.col("n") >= -(-least // shards))
    found = sifted(every, heavy, "hash", SIFT_BITS)
    by_shard = [f"coalesce(max(n) FILTER (WHERE shard = {s}), 0L)" for s in range(shards)]
    found = found.groupBy("hash", "n_words").agg(F.expr(f"{' + '.join(by_shard)} AS f"))
    return found.filter(F.col("f") >= least).select("hash", "n_words")


def set_bits(phrases: DataFrame, bits: int = TABLE_BITS) -> np.ndarray:
    """The phrases' bits as bytes; at most ``bits`` positions reach the driver, as words of 64 bits."""
    words = (
        phrases.select(F.expr(f"hash & {bits - 1}L").alias("at"))
        .groupBy(F.shiftright("at", 6).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(at & 63)))").alias("set"))
        .toArrow()
    )
    table = np.zeros(bits // 64, "<i8")
    table[words.column("word").to_numpy()] = words.column("set").to_numpy()
    return table.view(np.uint8)


def phrase_counts(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    shards: int = SHARDS,
    bits: int = TABLE_BITS,
    chunk: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, f) of all phrases that occur ``least`` times, and (lang, n) of all words."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "phrase-shards")
    # Snappy would keep buffers of whole pages, here of many megabytes, outside the heap; zstd streams.
    chunks(docs, shards, chunk).write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    held = lean_session(spark).read.schema(CHUNKS).parquet(folder)
    counted: list[tuple[str, DataFrame]] = []  # of the last cycle's scans, with their folders
    reached: list[DataFrame] = []
    tables: list[np.ndarray] = []  # of the last cycle's scans, of phrases that can make others active
    all_bits = np.zeros(bits // 8, np.uint8)
    known = recent = BitTable(all_bits)
    scan = 0
    while scan < shards or not recent.empty:
        part = held.filter(F.col("shard") == scan % shards)
        counts = scan_shard(part, scan < shards, known, recent, longest)
        counts = counts.withColumn("shard", F.lit(scan % shards))
        place = scratch_dir(spark, f"phrases-{scan}")
        counts.write.parquet(place)
        counted.append((place, spark.read.schema(counts.schema).parquet(place)))
        # A phrase that has just become complete has its counts in the last scans; older ones can go.
        if len(counted) > shards:
            paths.delete(spark, counted.pop(0)[0])
        now = totals([c for _, c in counted], least, shards)
        if reached:
            now = now.join(reduce(DataFrame.unionByName, reached), ["hash", "n_words"], "left_anti")
        reached.append(settled(now, f"phrases-reached-{scan}"))
        scan += 1
        tables = [*tables, set_bits(reached[-1].filter(f"n_words < {longest}"), bits)][-shards:]
        all_bits = all_bits | tables[-1]
        known, recent = BitTable(all_bits), BitTable(np.bitwise_or.reduce(tables))
    whole = all_bits | set_bits(reduce(DataFrame.unionByName, reached), bits)
    found = spelled_out(held, BitTable(whole), longest)
    place = scratch_dir(spark, "phrase-counts")
    found.write.parquet(place)
    found = spark.read.schema(found.schema).parquet(place)  # by the caller's session, not that of the chunks
    for place in (folder, *(place for place, _ in counted)):
        paths.delete(spark, place)
    words = found.filter("n_words = 0").select("lang", "n")
    frequent = found.filter(f"n_words > 0 AND n >= {least}").withColumnRenamed("n", "f")
    return frequent, settled(words.filter("n > 0"), "phrase-words")


def collocations(frequent: DataFrame, words: DataFrame, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A phrase is scored at its worst cut. Phrases inside a longer one that occurs as often drop out; it
    is enough to look at phrases one word longer, as counts in between lie between. Products are decimals
    of 38 digits.
    """
    candidates = frequent.filter("n_words > 1").withColumnRenamed("f", "a")
    longer = candidates.filter("n_words > 2").selectExpr(
        "lang",
        "a",
        f"explode(array({_part('1', 'n_words - 1')}, {_part('2', 'n_words - 1')})) AS phrase",
    )
    cuts = candidates.join(longer.distinct(), ["lang", "phrase", "a"], "left_anti").selectExpr(
        "*", "explode(sequence(1, n_words - 1)) AS k"
    )
    cuts = cuts.selectExpr("*", f"{_part('1', 'k')} AS head", f"{_part('k + 1', 'n_words - k')} AS tail")
    for part, count in (("head", "l"), ("tail", "r")):
        known = frequent.selectExpr("lang", f"phrase AS {part}", f"f AS {count}")
        cuts = cuts.join(known, ["lang", part])
    big = "CAST({} AS DECIMAL(20, 0))"
    score = f"CAST({scale} AS DECIMAL(10, 0)) * {big.format('a')} * {big.format('n')}"
    scored = cuts.join(words, "lang").selectExpr(
        "lang", "phrase", "a", "n", "k", "l", "r",
        f"({score}) DIV ({big.format('l')} * {big.format('r')}) AS score",
    )
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(F.expr("min(struct(score, k, l, r))").alias("cut"))
    worst = settled(worst, "phrase-scores")
    # The best of each cell, then of the cells' best: a task sorts a root's share of a language.
    cells = 1 + math.isqrt(worst.count() // top)
    best_first = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    in_cell = F.row_number().over(Window.partitionBy("lang", "cell").orderBy(*best_first))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best_first))
    return (
        worst.withColumn("cell", F.pmod(F.xxhash64("phrase"), F.lit(cells)))
        .withColumn("place", in_cell)
        .filter(F.col("place") <= top)
        .withColumn("rank", place)
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of two to five words."""
    return collocations(*phrase_counts(table(lean_session(spark), sf_dir, "documents")))
