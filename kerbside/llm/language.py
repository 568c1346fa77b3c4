"""Language identification with error-correcting output codes.

Every language has a codeword of ``n_bits`` bits; codewords are far apart. One binary classifier per
bit, a logistic regression on hashed byte n-grams, predicts that bit. Decoding weighs each bit's
logistic loss by how well the bit was learned and takes the language whose codeword costs least;
where the runner-up costs hardly more the document is flagged as ambiguous.

The classifiers are fitted on a bounded sample: at most ``SAMPLE`` documents, shared evenly between
languages (``LEAST`` each at least), those with the smallest hash of identifier and text. Texts are read
whole, when learning and when predicting.

Nulls and edges: a null text or one without a letter is ``und`` with score zero; without any document
to learn from all are ``und``; with one language all others are that language. Equal texts get equal
predictions. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import id_fold, id_text, md5_number, table

SAMPLE, LEAST = 3000, 20
FOLDS, HELD_OUT = 4, 2
DIMS = 2048
LEAST_BITS = 15
STEPS, RATE, DECAY = 120, 0.05, 1e-4
AMBIGUOUS = 0.2
CHUNK = 1 << 20
UNDETERMINED = "und"
#: ASCII other than letters becomes one separator; letters are lower-cased.
SPELLING = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)).lower()


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    if re.search(rb"[A-Za-z]", text):
        return True
    return any(map(str.isalpha, text.decode("utf-8", "ignore")))


def ngram_features(text: bytes) -> np.ndarray:
    """Hashed counts of byte pairs and triples of the whole text, damped and of unit length."""
    counts = np.zeros(DIMS)
    for at in range(0, len(text), CHUNK):
        part = re.sub(rb" +", b" ", text[max(0, at - 2) : at + CHUNK].translate(SPELLING))
        b = np.frombuffer(b" " + part + b" ", np.uint8).astype(np.uint32)
        two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (b[2:] * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)
        shift = np.uint32(32 - DIMS.bit_length() + 1)
        counts += np.bincount(two >> shift, minlength=DIMS) + np.bincount(three >> shift, minlength=DIMS)
    damped = np.sqrt(counts)
    return damped / (np.linalg.norm(damped) or 1)


def codewords(n: int, n_bits: int, seed: int = 0) -> np.ndarray:
    """(n, n_bits) of -1 and 1: of many random codes the one whose closest words are farthest.

    Every bit tells some languages from others.
    """
    rng = np.random.default_rng(seed)
    best, distance = None, -1
    for _ in range(300):
        code = rng.choice([-1, 1], (n, n_bits))
        flat = np.abs(code.sum(0)) == n
        code[0, flat] *= -1
        apart = (code[:, None] != code[None]).sum(-1)
        least = apart[~np.eye(n, dtype=bool)].min() if n > 1 else n_bits
        if least > distance:
            best, distance = code, least
    return best


@dataclass
class CodeModel:
    """Languages, their codewords, and for each bit its weights, bias and trust."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, ambiguous) of rows of features."""
        margins = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.trust
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(x))
        share = np.exp(loss.min(1, keepdims=True) - loss)
        score = 1 / share.sum(1)
        if len(self.languages) == 1:
            return order[:, 0], score, np.zeros(len(x), bool)
        gap = loss[rows, order[:, 1]] - loss[rows, order[:, 0]]
        return order[:, 0], score, gap < AMBIGUOUS


def fit(x: np.ndarray, language: np.ndarray) -> CodeModel | None:
    """All bits' logistic regressions at once, by Adam steps on the whole sample."""
    languages = sorted(set(language.tolist()))
    if not languages:
        return None
    n_bits = max(LEAST_BITS, 4 * len(languages).bit_length())
    code = codewords(len(languages), n_bits)
    index = np.array([languages.index(v) for v in language])
    y = code[index]
    # A language counts the same however many samples it has.
    share = (1 / np.bincount(index))[index] / len(languages)
    w, moment, square = (np.zeros((x.shape[1] + 1, n_bits)) for _ in range(3))
    one = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    for step in range(1, STEPS + 1):
        grad = -y / (1 + np.exp(np.clip(y * (one @ w), -30, 30)))
        grad = one.T @ (grad * share[:, None]).astype(np.float32) + DECAY * w
        moment = 0.9 * moment + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        w -= RATE * 8 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    right = ((one @ w > 0) == (y > 0)).T @ share
    trust = np.clip(2 * right - 1, 0.01, 1)
    return CodeModel(languages, code, w[:-1], w[-1], trust / trust.sum() * n_bits)


def sample_rows(docs: DataFrame, learn: Column) -> DataFrame:
    """(lang, x): the sample to learn from, its share per language by the smallest hashes."""
    spread = md5_number(F.concat_ws(":", id_text("doc_id"), F.xxhash64("text").cast("string")))
    usable = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # A row per language, as the model itself has; each takes as many as the sample has for it.
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    per = max(LEAST, SAMPLE // max(1, len(counts)))
    placed = usable.select("lang", "text", spread.alias("place"))

    def near_bounds(below: dict[str, float]) -> DataFrame:
        bounds = docs.sparkSession.createDataFrame(list(below.items()), "lang string, below double")
        return placed.join(F.broadcast(bounds), "lang").filter("place < below")

    below = {r.lang: 3.0 * per / r.n * 2**32 for r in counts}
    found = {r.lang: r["count"] for r in near_bounds(below).groupBy("lang").count().collect()}
    # Rows that repeat share a place; a language that has too few below its bound gives all its rows.
    below |= {k: 2.0**32 for k in below if found.get(k, 0) < per}
    # Only what is near the bound, some three times the sample, is shuffled with its text; of a language
    # without bound, each task's first ``per`` rows.
    near = near_bounds(below)
    best = Window.partitionBy("lang").orderBy("place", F.xxhash64("text"))
    return near.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= per).select("lang", "text")


def train(docs: DataFrame, learn: Column) -> CodeModel | None:
    """Fit on the sample; its features, at most ``SAMPLE`` rows or so, come to the driver."""
    rows = sample_rows(docs, learn).select("lang", F.col("text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [i for i, t in enumerate(batch.column("text")) if has_letter(t.as_py())]
            x = [ngram_features(batch.column("text")[i].as_py()).astype(np.float32) for i in keep]
            lang = batch.column("lang").take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([lang, pa.array(x, pa.list_(pa.float32()))], ["lang", "x"])

    got = rows.mapInArrow(run, "lang string, x array<float>").toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, DIMS)
    lang = np.array(got.column("lang").to_pylist(), object)
    order = np.lexsort((*x[:, ::256].T, lang.astype(str)))  # the order of arrival varies
    return fit(x[order], lang[order])


def identify(docs: DataFrame, model: CodeModel | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            known = np.array([model is not None and has_letter(t) for t in texts], bool)
            lang = np.full(len(texts), UNDETERMINED, object)
            score, ambiguous = np.zeros(len(texts)), np.zeros(len(texts), bool)
            rows = np.nonzero(known)[0]
            for at in range(0, len(rows), 512):
                some = rows[at : at + 512]
                best, score[some], ambiguous[some] = model.predict(
                    np.array([ngram_features(texts[i]) for i in some])
                )
                lang[some] = np.array(model.languages, object)[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(ambiguous)],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run, f"doc_id {doc_id}, lang_pred string, score double, ambiguous boolean"
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, id_fold("doc_id", FOLDS) != HELD_OUT)
    return identify(docs, model).select(
        "doc_id",
        (id_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
        "ambiguous",
    )
