"""Language-model scoring by deleted interpolation of bigrams and unigrams.

``P(w | v) = m2 * c(v, w) / c(v) + m1 * P(w)``, where P(w) is the smoothed unigram share and the
weights m1 + m2 = 1 depend on how often the context v was seen: there is a pair for each bucket of
context frequency. They are learned by expectation-maximisation on deleted counts: each bigram
occurrence is held out in turn, so it weighs as if it had been seen once less.

How the corpus is counted:

* words are 64-bit hashes; their training counts are one grouped table;
* tasks look the counts up in that table while it has at most ``MAX_VOCAB`` rows (a bounded copy per
  Python worker); beyond, tokens and counts meet in a join. Both give the same counts;
* a bigram of two of the ``HOT`` most frequent words (or of the start and one) is counted in a dense
  table of fixed size and never shuffled by document, so no common pair lands in one task. Any other
  bigram is rarer than the last of those words;
* other bigrams go to partitions by hash, as packed arrays of keys with the texts they occur in;
  what a text needs of its own goes along: its unigram score, its contexts by bucket, its hot pairs.
  One shuffle serves all passes over it: statistics for the weights, then each text's share. The
  texts themselves are read twice, to count words and to count bigrams.

Nulls and edges: a null text is empty, an empty one is its end alone; a null identifier is the empty
text when folds are dealt; equal texts share one set of entries in a batch and get equal scores; with
nothing to learn from, all probabilities are those of the smoothing. Extra columns are not read.
Documents have to come in one order whenever a lost task reads them again, as files do.
"""

from __future__ import annotations

import pickle
import sys
import types
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kerbside.llm.common import ascii_lower, id_fold, settled, shuffled_once, table, words
from kerbside.session import scratch_dir

FOLDS, HELD_OUT = 5, 1
MAX_VOCAB = 1 << 23
HOT = 1024
CHUNK_TOKENS = 1 << 18
PART_TOKENS = 1 << 21
EXACT_CONTEXTS = 8  # contexts seen up to so often have a bucket each, the others one per doubling
BUCKETS = 64
RATIO_BINS, BINS_PER_DOUBLING, LOWEST = 512, 8, -24
EM_STEPS = 100
SIDE = HOT + 1  # of the dense table; entry 0 is the start of a text


def tokenised(docs: DataFrame, train: Column) -> DataFrame:
    """(doc_id, text_key, train, h): the hashes of a text's words, in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes = F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))
    return docs.select(
        "doc_id", F.xxhash64(text).alias("text_key"), train.alias("train"), hashes.alias("h")
    )


def vocabulary(tokens: DataFrame, end: int) -> DataFrame:
    """(h, c): training counts of words and of the end."""
    each = tokens.filter("train").select(F.explode(F.expr(f"concat(h, array({end}L))")).alias("h"))
    return each.groupBy("h").agg(F.count(F.lit(1)).alias("c"))


@dataclass(frozen=True)
class Counts:
    """What every task knows: totals, fixed tokens, the hot words in order of hash."""

    path: str | None  # of the vocabulary, None if counts come with the tokens
    n_tokens: int
    n_words: int
    n_texts: int
    end: int
    hot: np.ndarray

    def share(self, c: np.ndarray) -> np.ndarray:
        """The smoothed unigram share of words counted ``c`` times."""
        return (c + 0.5) / (self.n_tokens + 0.5 * (self.n_words + 1))

    def hot_index(self, h: np.ndarray) -> np.ndarray:
        """1 and up for hot words, 0 for others."""
        if not len(self.hot):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
        return np.where(self.hot[at] == h, at + 1, 0)


def _loaded(path: str, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """The vocabulary as sorted hashes and counts, once per Python worker.

    Workers outlive tasks; what they keep is a module, as functions are sent anew with each task.
    """
    kept = sys.modules.setdefault("kerbside_kept_vocabulary", types.ModuleType("kerbside_kept_vocabulary"))
    if getattr(kept, "path", None) != path:
        kept.path = kept.sorted = None
        system, where = pafs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")
        files = [f for f in system.get_file_info(pafs.FileSelector(where)) if f.path.endswith(".parquet")]
        rows = [pq.ParquetFile(f.path, filesystem=system).metadata.num_rows for f in files]
        narrow = np.uint32 if n_tokens < 2**32 else np.int64
        h, c, at = np.empty(sum(rows), np.int64), np.empty(sum(rows), narrow), 0
        for f, n in zip(files, rows):  # file by file, so that only one is held twice
            part = pq.read_table(f.path, filesystem=system, columns=["h", "c"])
            h[at : at + n], c[at : at + n] = part.column("h").to_numpy(), part.column("c").to_numpy()
            at += n
        order = np.argsort(h)
        kept.path, kept.sorted = path, (h[order], c[order])
    return kept.sorted


def context_bucket(c: np.ndarray) -> np.ndarray:
    """The bucket of contexts seen ``c`` times; 0 for contexts never seen."""
    doubling = np.log2(np.maximum(c, 1) / EXACT_CONTEXTS).astype(np.int64)
    return np.where(c <= EXACT_CONTEXTS, c, EXACT_CONTEXTS + 1 + np.minimum(doubling, 50)).astype(np.int64)


@dataclass
class Chunk:
    """Different texts of some rows, their tokens end to end."""

    weight: np.ndarray  # how many rows with each text are learned from
    rows: tuple[list, np.ndarray, np.ndarray]  # of all rows: identifier, train, number of the text
    text: np.ndarray  # of each token from here on: number of its text
    c_before: np.ndarray  # count of its context
    c: np.ndarray  # its own count
    hot_pair: np.ndarray  # place in the dense table, -1 if the pair is not hot
    key: np.ndarray  # of the bigram


def _flat(h: list[np.ndarray], counts: list[np.ndarray] | None, know: Counts) -> tuple[np.ndarray, ...]:
    """Texts laid end to end, each closed by the end token: text number, hash, count, is-first."""
    n = np.array([len(x) + 1 for x in h])
    text = np.repeat(np.arange(len(h)), n)
    ends = np.cumsum(n) - 1
    flat = np.full(int(n.sum()), know.end, np.int64)
    inner = np.ones(len(flat), bool)
    inner[ends] = False
    flat[inner] = np.concatenate(h) if len(h) else []
    first = np.zeros(len(flat), bool)
    first[ends - n + 1] = True
    if counts is not None:
        c = np.concatenate(counts)
    else:
        known, value = _loaded(know.path, know.n_tokens)
        c = np.zeros(len(flat), np.int64)
        if len(known):
            some, inverse = np.unique(flat, return_inverse=True)  # in order, so look-ups stay close
            at = np.minimum(np.searchsorted(known, some), len(known) - 1)
            c = np.where(known[at] == some, value[at], 0).astype(np.int64)[inverse]
    return text, flat, c, first


def chunks(batches: Iterable[pa.RecordBatch], know: Counts) -> Iterator[Chunk]:
    """Batches cut into chunks of about ``CHUNK_TOKENS``; equal texts of a chunk are one."""
    for batch in batches:
        lengths = batch.column("h").value_lengths().to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths + 1) // CHUNK_TOKENS
        for g in np.unique(group):
            part = batch.slice(int(np.searchsorted(group, g)), int((group == g).sum()))
            train = part.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
            keys, rows, inverse = np.unique(
                part.column("text_key").to_numpy(), return_index=True, return_inverse=True
            )
            weight = np.bincount(inverse, train, len(keys)).astype(np.int64)
            column = part.column("h")
            values = column.flatten().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            h = [values[bounds[i] : bounds[i + 1]] for i in rows]
            counts = None
            if know.path is None:
                counts = [np.array(part.column("c")[int(i)].as_py(), np.int64) for i in rows]
            text, flat, c, first = _flat(h, counts, know)
            before = np.roll(flat, 1)
            c_before = np.where(first, know.n_texts, np.roll(c, 1))
            hot = know.hot_index(flat)
            hot_before = np.where(first, 0, np.roll(hot, 1))
            is_hot = (hot > 0) & (first | (hot_before > 0))
            with np.errstate(over="ignore"):
                left = np.where(first, 0, before).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                key = (left ^ (left >> np.uint64(29))) + flat.astype(np.uint64)
                key *= np.uint64(0xBF58476D1CE4E5B9)
                key ^= key >> np.uint64(32)
                key *= np.uint64(0x94D049BB133111EB)
            pair = np.where(is_hot, hot_before * SIDE + hot, -1)
            told = part.column("doc_id").to_pylist(), train.astype(bool), inverse
            yield Chunk(weight, told, text, c_before, c, pair, key)


def _planes(a: np.ndarray) -> bytes:
    """An array's bytes by significance, which compresses where high bytes agree."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def _unplanes(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack(batches: Iterable[pa.RecordBatch], know: Counts, parts: int, task: int) -> Iterator[tuple[int, bytes]]:
    """(part, packed arrays): bigrams by key, and from ``parts`` on the texts they come from.

    A text is known by its chunk, numbered by task and order, and its number there. Bigrams whose
    context or word has no training count cannot have one and are left out. Counts of hot pairs come
    at the end, once per task.
    """
    dense = np.zeros(SIDE * SIDE, np.int64)
    for number, chunk in enumerate(chunks(batches, know), task << 20):
        hot = chunk.hot_pair >= 0
        yield parts + number % parts, pickle.dumps(("texts", number, _own(chunk, know)), 5)
        np.add.at(dense, chunk.hot_pair[hot], chunk.weight[chunk.text[hot]])
        rest = np.nonzero(~hot & (chunk.c > 0) & (chunk.c_before > 0))[0]
        rest = rest[np.argsort(chunk.key[rest], kind="stable")]
        key, text = chunk.key[rest], chunk.text[rest]
        start = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else rest
        count = np.add.reduceat(chunk.weight[text], start) if len(start) else start
        one = rest[start]
        ratio = (1 / (chunk.c_before[one] * know.share(chunk.c[one]))).astype(np.float32)
        bucket = context_bucket(chunk.c_before[one]).astype(np.uint8)
        uses = np.diff(np.append(start, len(key))).astype(np.uint32)
        key = key[start]
        home = (key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        cut = np.searchsorted(home, np.arange(parts + 1, dtype=np.uint64))
        offset = np.concatenate([[0], np.cumsum(uses, dtype=np.int64)])
        for p in np.nonzero(np.diff(cut))[0].tolist():
            a, b = cut[p], cut[p + 1]
            packed = (
                _planes(np.diff(key[a:b], prepend=np.uint64(0))),
                _planes(count[a:b].astype(np.uint32)),
                _planes(ratio[a:b]),
                bucket[a:b].tobytes(),
                _planes(uses[a:b]),
                _planes(text[offset[a] : offset[b]].astype(np.uint32)),
            )
            yield p, pickle.dumps(("keys", number, packed), 5)
    at = np.nonzero(dense)[0]
    for p in range(parts if len(at) else 0):
        own = at[at % parts == p]
        if len(own):
            yield p, pickle.dumps(("dense", task, (own, dense[own])), 5)


def _own(chunk: Chunk, know: Counts) -> tuple:
    """What a chunk's texts need besides their other bigrams."""
    n = len(chunk.weight)
    bucket = context_bucket(chunk.c_before)
    contexts = np.bincount(chunk.text * BUCKETS + bucket, minlength=n * BUCKETS)
    place = np.nonzero(contexts)[0]
    hot = np.nonzero(chunk.hot_pair >= 0)[0]
    return (
        chunk.rows,
        np.bincount(chunk.text, minlength=n),
        np.bincount(chunk.text, chunk.c > 0, n).astype(np.int64),
        np.bincount(chunk.text, np.log10(know.share(chunk.c)), n),
        place.astype(np.int32),
        contexts[place].astype(np.int32),
        np.bincount(chunk.text[hot], minlength=n).astype(np.int32),
        _planes(chunk.hot_pair[hot].astype(np.uint32)),
        bucket[hot].astype(np.uint8),
    )


def _unpack(blobs: Iterable[bytes]):
    """A part's keys with total counts, and its blobs; the dense sums apart."""
    held, dense = [], []
    for blob in blobs:
        kind, number, packed = pickle.loads(blob)
        if kind == "dense":
            dense.append(packed)
        else:
            key = np.cumsum(_unplanes(packed[0], np.uint64), dtype=np.uint64)
            held.append((number, key, packed))
    keys = np.concatenate([k for _, k, _ in held]) if held else np.empty(0, np.uint64)
    counts = [_unplanes(p[1], np.uint32) for _, _, p in held]
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(keys) else np.empty(0, bool)
    total = np.bincount(np.cumsum(new) - 1, np.concatenate(counts)[order]) if len(keys) else np.empty(0)
    each = np.empty(len(keys), np.int64)
    each[order] = total[np.cumsum(new) - 1] if len(keys) else 0
    return held, dense, each, order[new] if len(keys) else np.empty(0, np.int64)


def ratio_histogram(bucket: np.ndarray, count: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Deleted counts by context bucket and ratio of the two estimates; place 0: none is left.

    A bigram seen n times stands for n held-out tokens, each with n - 1 sightings left.
    """
    left = np.zeros(len(count), np.int64)
    seen = count > 1
    # Contexts seen rarely lose a notable share with the one that is held out.
    context = bucket[seen].astype(float)
    fewer = np.where(context <= EXACT_CONTEXTS, context / np.maximum(context - 1, 1), 1)
    x = (count[seen] - 1) * ratio[seen] * fewer
    left[seen] = np.clip((np.log2(x) - LOWEST) * BINS_PER_DOUBLING + 1, 1, RATIO_BINS - 1)
    place = bucket.astype(np.int64) * RATIO_BINS + left
    return np.bincount(place, count, BUCKETS * RATIO_BINS)


def mixture_weights(histogram: np.ndarray) -> np.ndarray:
    """The bigrams' weight in each context bucket, by expectation-maximisation."""
    h = histogram.reshape(BUCKETS, RATIO_BINS)
    x = 2.0 ** ((np.arange(RATIO_BINS) - 0.5) / BINS_PER_DOUBLING + LOWEST)
    x[0] = 0
    weight = np.full((BUCKETS, 1), 0.5)
    total = h.sum(1, keepdims=True)
    for _ in range(EM_STEPS):
        belief = weight * x / (weight * x + 1 - weight)
        weight = np.where(total > 0, (h * belief).sum(1, keepdims=True) / np.maximum(total, 1), 0)
        weight = np.clip(weight, 1e-6, 1 - 1e-6)
    return np.where(total > 0, weight, 1e-6).ravel()


def _statistics(blobs: Iterable[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, places, counts): of the histogram (0) and of the dense table (1), what is not zero."""
    held, dense, each, first = _unpack(blobs)
    if held:
        bucket = np.concatenate([np.frombuffer(p[3], np.uint8) for _, _, p in held])[first]
        ratio = np.concatenate([_unplanes(p[2], np.float32) for _, _, p in held])[first]
        some = each[first] > 0
        histogram = ratio_histogram(bucket[some], each[first][some], ratio[some].astype(float))
        place = np.nonzero(histogram)[0]
        yield 0, place, histogram[place]
    if dense:
        place, inverse = np.unique(np.concatenate([at for at, _ in dense]), return_inverse=True)
        yield 1, place, np.bincount(inverse, np.concatenate([n for _, n in dense]))


def _shares(blobs: Iterable[bytes], odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, sum of log10(1 + odds * ratio)) of the texts in a part's blobs."""
    held, _, each, _ = _unpack(blobs)
    places, gains, at = [np.empty(0, np.int64)], [np.empty(0)], 0
    for number, key, p in held:
        count = each[at : at + len(key)]
        at += len(key)
        bucket = np.frombuffer(p[3], np.uint8)
        gain = np.log10(1 + odds[bucket] * count * _unplanes(p[2], np.float32).astype(float))
        sums = np.bincount(_unplanes(p[5], np.uint32), np.repeat(gain, _unplanes(p[4], np.uint32)))
        some = np.nonzero(sums)[0]
        places.append((number << 20) + some)
        gains.append(sums[some])
    return np.concatenate(places), np.concatenate(gains)


def _texts(blob: bytes, odds: np.ndarray, stay: np.ndarray, ratios: np.ndarray) -> tuple:
    """(identifiers, train, place, tokens, known, base score, score without other bigrams) of rows."""
    _, number, packed = pickle.loads(blob)
    (ids, train, text), n_tokens, n_known, base, place, contexts, n_hot, pairs, bucket = packed
    n = len(n_tokens)
    gain = np.log10(1 + odds[bucket] * ratios[_unplanes(pairs, np.uint32)])
    score = base + np.bincount(place // BUCKETS, contexts * stay[place % BUCKETS], n)
    score += np.bincount(np.repeat(np.arange(n), n_hot), gain, n)
    return ids, train, (number << 20) + text, n_tokens[text], n_known[text], base[text], score[text]


def with_counts(tokens: DataFrame, vocab: DataFrame, end: int) -> DataFrame:
    """Tokens with ``c``, each token's training count and the end's last, by a join."""
    tokens = settled(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    each = tokens.select("row", F.posexplode(F.expr(f"concat(h, array({end}L))")).alias("pos", "h"))
    counted = (
        each.join(vocab, "h", "left")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("c", F.lit(0)).alias("c")))).alias("pc"))
        .select("row", F.col("pc.c").alias("c"))
    )
    return settled(tokens.join(counted, "row"), "counted-tokens")


def score(docs: DataFrame, train: Column, max_vocab: int = MAX_VOCAB, hot: int = HOT) -> DataFrame:
    """Output: doc_id, train, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    tokens = tokenised(docs, train)
    end = spark.range(1).select(F.xxhash64(F.lit(""))).first()[0]
    path = scratch_dir(spark, "vocabulary")
    vocabulary(tokens, end).write.parquet(path)
    vocab = spark.read.schema("h long, c long").parquet(path)
    total = vocab.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("v"),
        F.coalesce(F.max(F.expr(f"CASE WHEN h = {end}L THEN c END")), F.lit(0)).alias("texts"),
    ).first()
    frequent = vocab.orderBy(F.desc("c"), "h").limit(min(hot, HOT)).collect()  # HOT rows at most
    frequent = sorted((r.h, r.c) for r in frequent)
    inside = total.v <= max_vocab
    if not inside:
        tokens = with_counts(tokens, vocab, end)
    know = Counts(
        path if inside else None, total.n, total.v, total.texts, end, np.array([h for h, _ in frequent], np.int64)
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total.n // PART_TOKENS)
    columns = ["doc_id", "text_key", "train", "h", *([] if inside else ["c"])]
    tokens = tokens.select(*columns)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for p, blob in pack(batches, know, parts, task):
            yield _batch(part=pa.array([p], pa.int32()), blob=pa.array([blob], pa.binary()))

    blobs = shuffled_once(
        tokens.mapInArrow(packed, "part int, blob binary").repartitionById(2 * parts, "part")
    )
    of_keys = blobs.filter(F.col("part") < parts).select("blob")
    of_texts = blobs.filter(F.col("part") >= parts).select("blob")

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, place, n in _statistics(_values(batches)):
            kinds = pa.array(np.full(len(place), kind, np.int32))
            yield _batch(kind=kinds, place=pa.array(place), n=pa.array(n.astype(np.int64)))

    # Both tables are of fixed size: the histogram, and at most SIDE * SIDE hot pairs.
    sums = of_keys.mapInArrow(statistics, "kind int, place long, n long").groupBy("kind", "place")
    found = sums.agg(F.sum("n").alias("n")).toArrow()
    kind, place, n = (found.column(c).to_numpy() for c in ("kind", "place", "n"))
    histogram = np.zeros(BUCKETS * RATIO_BINS)
    histogram[place[kind == 0]] = n[kind == 0]
    place, seen = place[kind == 1], n[kind == 1]
    ratios = np.zeros(SIDE * SIDE, np.float32)
    if len(place):
        c_hot = np.array([total.texts, *(c for _, c in frequent)])
        left, right = c_hot[place // SIDE], c_hot[place % SIDE]
        ratio = 1 / (left * know.share(right))
        some = seen > 0
        histogram = histogram + ratio_histogram(context_bucket(left)[some], seen[some], ratio[some])
        ratios[place] = seen * ratio
    weight = mixture_weights(histogram)
    odds, stay = weight / (1 - weight), np.log10(1 - weight)
    stay[0] = odds[0] = 0  # a context never seen leaves all to the unigrams
    dense_ratios = spark.sparkContext.broadcast(ratios)  # 4 MB

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, gains = _shares(_values(batches), odds)
        home = (places >> 20) % parts
        order = np.argsort(home, kind="stable")
        cut = np.searchsorted(home[order], np.arange(parts + 1))
        for p in np.nonzero(np.diff(cut))[0].tolist():
            own = order[cut[p] : cut[p + 1]]
            packed = _planes(np.diff(places[own], prepend=np.int64(0))), gains[own].astype(np.float32)
            blob = pa.array([pickle.dumps(packed, 5)], pa.binary())
            yield _batch(part=pa.array([p], pa.int32()), blob=blob)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [pickle.loads(b) for b in _values(batches)]
        if found:
            places = np.concatenate([np.cumsum(_unplanes(x, np.int64)) for x, _ in found])
            some, inverse = np.unique(places, return_inverse=True)
            gain = np.bincount(inverse, np.concatenate([g for _, g in found]))
            yield _batch(place=pa.array(some), gain=pa.array(gain))

    gains = (
        of_keys.mapInArrow(shares, "part int, blob binary")
        .repartitionById(parts, "part")
        .select("blob")
        .mapInArrow(summed, "place long, gain double")
    )
    doc_id = docs.schema["doc_id"].dataType
    arrow_id = to_arrow_type(doc_id)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blob in _values(batches):
            ids, *columns = _texts(blob, odds, stay, dense_ratios.value)
            names = ["train", "place", "n_tokens", "n_known", "base_score", "own"]
            yield _batch(doc_id=pa.array(ids, arrow_id), **dict(zip(names, map(pa.array, columns))))

    per_row = of_texts.mapInArrow(
        rows,
        f"doc_id {doc_id.simpleString()}, train boolean, place long, n_tokens long, n_known long,"
        " base_score double, own double",
    )
    return per_row.join(gains, "place", "left").select(
        "doc_id",
        "train",
        "n_tokens",
        "n_known",
        F.lit(total.n).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("own") + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*columns.values()], [*columns])


def _values(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
    """The single column of the batches, value by value."""
    for batch in batches:
        for value in batch.column(0):
            yield value.as_py()


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the model of those outside the held-out fold."""
    held_out = id_fold("doc_id", FOLDS) == HELD_OUT
    return score(table(spark, sf_dir, "documents"), ~held_out).select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
