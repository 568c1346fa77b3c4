"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, learned by cyclic boosting: round by round, every
feature in turn adds a small step of a shallow tree fitted to the residuals. The pairs of features
that explain most of what is left get tables over two features in the same way. A text's score is
the sum of its bins' entries, so scoring is a few vectorised look-ups.

The model is fitted on the documents of at most ``SAMPLE`` distinct labels, those with the smallest
hash of their identifier; that and the tables' sizes bound what the driver holds and what is sent to
the tasks. Rows of one identifier, label and text count once. Texts that share an identifier fill up
to twice as many rows, each label's first by hash before any second. Features come from whole texts.

Nulls and edges: null and empty texts have all features zero and a score like any other; labels
that are null are not learned from; without labels every score is one half, with labels of one kind
near that kind's share. Repeated rows get equal scores. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import id_fold, settled, table

SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 6
STEP, SMOOTH = 0.1, 5.0
CHUNK = 1 << 20

_CLASSES = {
    "letters": lambda c: chr(c).isalpha() or c >= 128,
    "upper": lambda c: 65 <= c <= 90,
    "digits": lambda c: 48 <= c <= 57,
    "spaces": lambda c: c == 32 or 9 <= c <= 13,
    "stops": lambda c: chr(c) in ".,;:?",
    "bangs": lambda c: chr(c) == "!",
    "bars": lambda c: chr(c) in "|<>{}[]\\^~_=+/",
    "signs": lambda c: chr(c) in "#$%&*@",
    "quotes": lambda c: chr(c) in "\"'()-`",
    "lines": lambda c: c == 10,
}
CLASS_OF_BYTE = np.array([[bool(f(c)) and (c < 128 or n == "letters") for n, f in _CLASSES.items()] for c in range(256)], float)
FEATURES = [
    *_CLASSES,
    "log_bytes",
    "word_bytes",
    "long_words",
    "distinct_words",
    "distinct_pairs",
    "distinct_lines",
    "line_words",
    "byte_entropy",
]


def features(text: bytes | None) -> np.ndarray:
    """The features of a UTF-8 text, in the order of ``FEATURES``."""
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    n = len(text)
    counts = np.zeros(256)
    for at in range(0, n, CHUNK):
        counts += np.bincount(np.frombuffer(text, np.uint8, min(CHUNK, n - at), at), minlength=256)
    words = text.lower().split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = counts[counts > 0] / n
    k = len(_CLASSES)
    out[:k] = counts @ CLASS_OF_BYTE / n
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    out[k:] = [
        np.log1p(n),
        lengths.mean() if words else 0,
        (lengths > 15).mean() if words else 0,
        len(set(words)) / max(1, len(words)) ** 0.75,
        len(set(zip(words, words[1:]))) / max(1, len(words) - 1),
        len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))),
        -(share * np.log2(share)).sum(),
    ]
    return out


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``pairs`` maps two features to a table over coarser bins."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, j], side="right")]
        for (i, j), values in self.pairs.items():
            total += values[self._coarse(x, i), self._coarse(x, j)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def _coarse(self, x: np.ndarray, j: int) -> np.ndarray:
        return np.searchsorted(self.coarse[j], x[:, j], side="right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow tree over ordered bins: each bin's leaf value, from gradient and weight sums."""
    value = np.full(len(g), g.sum() / (h.sum() + SMOOTH))
    if depth == 0 or len(g) < 2:
        return value
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + SMOOTH) + gr**2 / (hr + SMOOTH)
    at = int(gain.argmax()) + 1
    if gain[at - 1] <= g.sum() ** 2 / (h.sum() + SMOOTH) + 1e-9:
        return value
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree that cuts the first feature once and each side once by the second; its gain."""
    best, found = None, -1.0
    for a in range(1, max(2, len(g))):
        sides = [(g[:a].sum(0), h[:a].sum(0)), (g[a:].sum(0), h[a:].sum(0))]
        leaves = [_tree(sg, sh, 1) for sg, sh in sides]
        gain = sum(float((leaf * sg).sum()) for leaf, (sg, _) in zip(leaves, sides))
        if gain > found:
            best, found = (a, leaves), gain
    a, leaves = best
    return np.concatenate([np.tile(leaves[0], (a, 1)), np.tile(leaves[1], (len(g) - a, 1))])[: len(g)], found


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of single features, then of the most telling pairs."""
    if not len(y):
        return AdditiveModel()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(intercept=float(np.log(rate / (1 - rate))))
    if y.min() == y.max():
        return model
    k = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(k)]
    model.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def sums(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)

    for _ in range(ROUNDS):
        for j in range(k):
            step = STEP * _tree(*sums(bins[j], len(model.tables[j])))
            model.tables[j] += step
            total += step[bins[j]]
    coarse = [model._coarse(x, j) for j in range(k)]
    shapes = [len(e) + 1 for e in model.coarse]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        index = coarse[i] * shapes[j] + coarse[j]
        g, h = sums(index, shapes[i] * shapes[j])
        return index, g.reshape(shapes[i], -1), h.reshape(shapes[i], -1)

    gains = {(i, j): _pair_tree(*grid(i, j)[1:])[1] for i in range(k) for j in range(i + 1, k)}
    chosen = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.pairs = {(i, j): np.zeros((shapes[i], shapes[j])) for i, j in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            index, g, h = grid(i, j)
            step = STEP * _pair_tree(g, h)[0]
            model.pairs[i, j] += step
            total += step.ravel()[index]
    return model


def text_features(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``x``, the features of ``text``."""
    names = [*keep, "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(len(keep))]
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(x, pa.list_(pa.float64()))], names)

    chosen = docs.select(*keep, F.col("text").cast("binary"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1])
    return chosen.mapInArrow(run, f"{schema}, x array<double>" if schema else "x array<double>")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None) -> AdditiveModel:
    """Fit on at most ``SAMPLE`` labelled documents among the labels that ``learn`` lets through."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        usable = usable.filter(learn)
    labelled = usable.select("doc_id", F.col(label).cast("double").alias("y")).distinct()
    sample = labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(SAMPLE)
    # SAMPLE rows at most, which bounds what is broadcast.
    chosen = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(F.broadcast(sample), "doc_id")
    same = text_features(chosen, "doc_id", "y", "h").groupBy("doc_id", "y", "h")
    matched = settled(same.agg(F.first("x").alias("x")), "quality-matched")
    first = matched.groupBy("doc_id", "y").agg(F.min("h").alias("first"))
    rows = (
        matched.join(F.broadcast(first), ["doc_id", "y"])
        .orderBy(F.col("h") != F.col("first"), F.xxhash64("doc_id", "h"), "doc_id", "y", "h")
        .limit(2 * SAMPLE)
        .select("doc_id", "y", "x")
        .toArrow()
    )
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = rows.column("y").to_numpy()
    order = np.lexsort((*x.T, y, rows.column("doc_id").to_numpy()))  # the order of arrival varies
    return fit(x[order], y[order])


def score(docs: DataFrame, model: AdditiveModel, column: str = "score") -> DataFrame:
    """The documents with ``column``, the probability of label 1; a column of that name is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.cast(pa.binary()).as_py()) for t in batch.column("text")])
            scores = model.score(x.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, column])

    kept = docs.drop(column)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(column, T.DoubleType())]))


def learns() -> Column:
    """Labels that may be learned from: the identifier's fold is not 0."""
    return id_fold("doc_id", FOLDS) != 0


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    model = train(docs, labels, learn=learns())
    column = "quality_score"
    while column in map(str.lower, docs.columns):
        column = f"_{column}"
    return score(docs, model, column).filter(F.col(column) >= threshold).drop(column)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, learned from labels outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, learn=learns())
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (id_fold("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
