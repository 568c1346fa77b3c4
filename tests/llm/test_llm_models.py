"""Classifier, language identification and language model: held-out results, plain counts, edges."""

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from kerbside.llm import language, lm, quality
from kerbside.llm.common import id_fold, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not there")
DOCS = "doc_id long, text string, lang string, score double, x string, row string, gain string"


def make(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "x", "y", "z") for r in rows], DOCS)


# Quality


@data
def test_quality_on_held_out_labels(spark):
    got = {r.doc_id: r for r in quality.op6_quality(spark, SF).collect()}
    docs = table(spark, SF, "documents")
    assert len(got) == docs.count()
    labels = table(spark, SF, "labels").collect()
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in labels)
    for held_out, least in ((True, 0.9), (False, 0.97)):
        some = [r for r in labels if got[r.doc_id].held_out == held_out]
        right = sum(got[r.doc_id].predicted == r.quality for r in some)
        assert right >= least * len(some)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.9
    assert (0, 1) in model.pairs
    flat = quality.fit(x[:50], np.ones(50))
    assert (flat.score(x) > 0.95).all()
    assert (quality.AdditiveModel().score(x) == 0.5).all()


def test_repeated_rows_keep_no_label_out(spark, monkeypatch):
    """One identifier has most label rows and documents; every other label is still learned from."""
    docs = make(spark, [(0, f"### {i % 90}", "en") for i in range(300)] + [(i, "good words", "en") for i in range(1, 10)])
    labels = [(0, 0)] * 50 + [(i, 1) for i in range(1, 10)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    monkeypatch.setattr(quality, "SAMPLE", 10)
    monkeypatch.setattr(quality, "fit", lambda x, y: (x, y))
    x, y = quality.train(docs, lab)
    assert sorted(y) == [0.0] * 11 + [1.0] * 9
    again, _ = quality.train(docs.orderBy(F.desc("text")).repartition(7), lab)
    assert (x == again).all()


def test_quality_edges(spark):
    rows = [(i, "good clean words here " * 5 if i % 2 else "### $$$ %%%" * 9, "en") for i in range(60)]
    rows += [(100, None, None), (101, "", "en"), (None, "some text", None), (1, "again", "en"), (102, "w " * 300_000, "en")]
    labels = [(i, i % 2, 0) for i in range(60)] + [(3, None, None), (None, 1, 0), (9999, 1, 1), (5, 1, 0)]
    docs = make(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, lab, learn=quality.learns())
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    kept = quality.keep_good(docs, lab)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i in range(60) if i % 2} <= ids and not {i for i in range(60) if i % 2 == 0} & ids
    assert {r.score for r in kept.collect()} == {0.5}  # their own column
    nothing = quality.train(docs, lab.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.keep_good(docs.limit(0), lab).count() == 0


# Language


@data
def test_language_on_held_out_documents(spark):
    got = language.op10_language(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    for held_out in (True, False):
        some = [r for r in got if r.held_out == held_out and r.lang_pred != "und"]
        assert sum(r.lang_pred == truth[r.doc_id] for r in some) >= 0.97 * len(some)


def test_codewords_are_far_apart():
    for n in (2, 4, 30):
        code = language.codewords(n, max(15, 4 * n.bit_length()))
        apart = (code[:, None] != code[None]).sum(-1)[~np.eye(n, dtype=bool)]
        assert apart.min() >= 3 and (np.abs(code.sum(0)) < n).all()


def test_sample_has_languages_without_identifiers(spark, monkeypatch):
    """Null and repeated identifiers, with other texts or the same: each language has its share."""
    monkeypatch.setattr(language, "SAMPLE", 80)
    rows = [(i, f"some words {i}", "aa") for i in range(300)] + [(None, f"other words {i}", "bb") for i in range(300)]
    rows += [(None, "the same words", "cc")] * 300 + [(7, f"more words {i}", "dd") for i in range(300)]
    rows += [(11, "one text", "ee")] * 300 + [(12, "few", "ff")] * 3
    sample = language.sample_rows(make(spark, rows), F.lit(True)).collect()
    assert Counter(r.lang for r in sample) == dict.fromkeys(["aa", "bb", "cc", "dd", "ee"], 20) | {"ff": 3}


def test_language_edges(spark):
    rng = random.Random(0)
    sounds = {"aa": "abc", "bb": "xyz", "éé": "éèß"}
    rows = [(i, " ".join("".join(rng.choices(sounds[s], k=4)) for _ in range(30)), s)
            for i, s in enumerate(list(sounds) * 30)]
    rows += [(200, None, "aa"), (201, "", "aa"), (202, "12 34 !?", "bb"), (203, "Ж", None), (None, "abab baba", None), rows[0], rows[0]]
    rows += [(204, "abca " * 200_000, None)]
    docs = make(spark, rows)
    model = language.train(docs, id_fold("doc_id", 4) != 2)
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, lang in rows[:90]:
        assert by_id[i].lang_pred == lang
    assert {by_id[i].lang_pred for i in (200, 201, 202)} == {"und"} and by_id[200].score == 0
    assert by_id[204].lang_pred == "aa" and by_id[None].lang_pred == "aa"
    assert by_id[203].lang_pred in sounds
    assert language.train(docs, F.lit(False)) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    one = language.train(docs.filter("lang = 'aa'"), F.lit(True))
    assert {r.lang_pred for r in language.identify(docs, one).collect()} == {"aa", "und"}
    assert language.identify(docs.limit(0), model).count() == 0


# Language model


def tokens_of(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "</s>"]


def plain_scores(rows, train):
    """Exact counts, and weights by expectation-maximisation without bins."""
    uni, bi, texts = Counter(), Counter(), 0
    for _, text, _ in (r for r, t in zip(rows, train) if t):
        w = tokens_of(text)
        uni.update(w)
        bi.update(zip(["<s>", *w], w))
        texts += 1
    n, v = sum(uni.values()), len(uni)
    share = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    context = lambda u: texts if u == "<s>" else uni[u]
    bucket = lambda c: int(lm.context_bucket(np.array([c]))[0])
    held = {}
    for (u, w), c in bi.items():
        p2 = (c - 1) / (context(u) - 1) if context(u) > 1 else 0
        held.setdefault(bucket(context(u)), []).append((c, p2, share(w)))
    weight = {}
    for b, cases in held.items():
        m = 0.5
        for _ in range(100):
            m = sum(c * m * p2 / (m * p2 + (1 - m) * p1) for c, p2, p1 in cases) / sum(c for c, _, _ in cases)
            m = min(max(m, 1e-6), 1 - 1e-6)
        weight[b] = m
    out = []
    for doc_id, text, _ in rows:
        w = tokens_of(text)
        base = sum(math.log10(share(x)) for x in w)
        score = 0
        for u, x in zip(["<s>", *w], w):
            m = weight.get(bucket(context(u)), 0) if context(u) else 0
            seen = bi[u, x] / context(u) if context(u) else 0
            score += math.log10(m * seen + (1 - m) * share(x))
        out.append((doc_id, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


@pytest.fixture(scope="module")
def lm_rows():
    rng = random.Random(9)
    vocabulary = ["the", "The", "é", "É", "of", *("w%d" % i for i in range(60))]
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choices(vocabulary[:rng.choice([8, 65])], k=rng.randint(1, 60))), None) for i in range(150)]
    rows += [(200, None, None), (201, "", None), (202, "never seen words only", None), rows[3], rows[3]]
    return [*rows, *((300 + i, rows[7][1], None) for i in range(40)), (401, "the of " * 20_000, None)]


@pytest.mark.parametrize("how", [{}, {"max_vocab": 0}, {"hot": 0}, {"hot": 3}])
def test_lm_equals_plain_counts(spark, lm_rows, how, monkeypatch):
    """However counts reach the tasks and pairs are counted, in small chunks and in many parts."""
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(lm, "PART_TOKENS", 3000)
    docs = make(spark, lm_rows).repartition(3)
    held_out = id_fold("doc_id", 5) == 1
    got = lm.score(docs, ~held_out, **how).collect()
    train = [zlib.crc32(str(r[0]).encode()) % 5 != 1 for r in lm_rows]
    want = sorted(plain_scores(lm_rows, train), key=str)
    told = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=str)
    assert [t[:4] for t in told] == [w[:4] for w in want]
    assert np.allclose([t[4] for t in told], [w[4] for w in want], rtol=1e-9)
    assert np.allclose([t[5] for t in told], [w[5] for w in want], rtol=0.02, atol=0.05)


def test_lm_edges(spark):
    docs = make(spark, [(None, None, None), (1, "a b", None)])
    assert [r.score for r in lm.score(docs, F.lit(False)).collect()] == [0.0, 0.0]
    assert lm.score(docs.limit(0), F.lit(True)).count() == 0
    (a, b) = sorted(lm.score(docs, F.col("doc_id").isNull()).collect(), key=lambda r: r.n_tokens)
    assert (a.n_tokens, a.n_known, b.n_tokens, b.n_known) == (1, 1, 3, 1)


@data
def test_lm_beats_its_unigrams_on_held_out_documents(spark):
    got = lm.op4_lm_scoring(spark, SF).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def plain_features(text):
    """The features of a text, one by one from their definition."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(quality.FEATURES)
    n = len(raw)
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    words, lines = re.findall(rb"[^ \t-\r]+", lower), [x for x in raw.split(b"\n") if re.search(rb"[^ \t-\r]", x)]
    pairs = list(zip(words, words[1:]))
    share = [
        sum(chr(c).isalpha() or c >= 128 for c in raw), sum(65 <= c <= 90 for c in raw),
        sum(48 <= c <= 57 for c in raw), sum(c == 32 or 9 <= c <= 13 for c in raw),
        *(sum(c < 128 and chr(c) in s for c in raw) for s in (".,;:?", "!", "|<>{}[]\\^~_=+/", "#$%&*@", "\"'()-`")),
        sum(c == 10 for c in raw),
    ]
    return [
        *(x / n for x in share), math.log(1 + n), sum(map(len, words)) / len(words) if words else 0,
        sum(len(w) > 15 for w in words) / len(words) if words else 0, len(set(words)) / max(1, len(words)) ** 0.75,
        len(set(pairs)) / max(1, len(pairs)), len(set(lines)) / max(1, len(lines)),
        math.log(1 + len(words) / max(1, len(lines))), -sum(c / n * math.log2(c / n) for c in Counter(raw).values()),
    ]


def test_features_and_bins_against_plain_recomputation(spark):
    rng = random.Random(8)
    texts = [None, "", " \n", "Aé ß!", "one", "a\n\nb b\tc", "x" * 40 + " Y", "1|2 <z> $5 \"q\""]
    texts += ["".join(rng.choices("abc DE1\n.,!#|'é", k=rng.randint(1, 400))) for _ in range(80)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    for t in texts:
        assert quality.features(None if t is None else t.encode()) == pytest.approx(plain_features(t))
    x = np.array([quality.features(None if t is None else t.encode()) for t in texts])
    model = quality.fit(x, (x[:, 0] > np.median(x[:, 0])).astype(float))
    got = {r.doc_id: r.score for r in quality.score(make(spark, rows), model).collect()}
    for i, v in enumerate(x):
        total = model.intercept + sum(
            float(t[sum(1 for e in edges if v[f] >= e)]) for f, (edges, t) in enumerate(zip(model.edges, model.tables))
        )
        for (a, b), t in model.pairs.items():
            p, q = (sum(1 for e in model.coarse[f] if v[f] >= e) for f in (a, b))
            total += float(t[p][q])
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_quality_with_any_column_names(spark):
    rows = [(i, "good clean words here " * 5 if i % 2 else "### $$$ %%%" * 9, "en") for i in range(60)]
    lab = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = make(spark, rows).selectExpr("*", "1 AS own_score", "2 AS quality_score", "3 AS `_quality_score`", "4 AS shard")
    kept = quality.keep_good(docs, lab)
    assert kept.columns == docs.columns
    assert {(r.score, r.own_score, r.quality_score, r["_quality_score"], r.shard) for r in kept.collect()} == {(0.5, 1, 2, 3, 4)}
