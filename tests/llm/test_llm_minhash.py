"""MinHash near-duplicates against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from kerbside.llm import minhash

SCHEMA = "doc_id long, text string, node string, bucket int, n_shingles int"


def plain_set(text):
    words = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 2:
        return frozenset(words)
    return frozenset(map(" ".join, zip(words, words[1:])))


def plain(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    least = {m: min((rows[x][0] for x in ms if rows[x][0] is not None), default=None) for ms in groups.values() for m in ms}
    return sorted(((rows[i][0], len(sets[i]), least[i]) for i in range(len(rows))), key=str)


def edited(rng, words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdé", k=rng.randint(2, 7))) for _ in range(800)]
    texts = [None, "", " \n", "One", "one", "one two", "ONE\ttwo", "one two three", "w " * 9000]
    for _ in range(30):
        base = rng.choices(vocabulary, k=rng.randint(3, 90))
        texts.append(" ".join(base))
        texts += [" ".join(edited(rng, base, rng.randint(0, 5), vocabulary)).upper() for _ in range(rng.randint(0, 4))]
    # One group of many edited copies, with those apart from its original.
    base = rng.choices(vocabulary, k=120)
    texts += ["\n".join(edited(rng, base, rng.choice([1, 2, 4, 8, 13]), vocabulary)) for _ in range(150)]
    # A passage that many documents share.
    texts += [" ".join(base[:60] + rng.choices(vocabulary, k=40)) for _ in range(40)]
    rng.shuffle(texts)
    out = [(i * 7 % 2003, t) for i, t in enumerate(texts)]
    return [*out, out[5], out[5], (None, out[3][1]), (None, "nobody knows this one"), (None, None)]


def result(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    found = minhash.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, found), key=str)


def test_equals_all_pairs(spark, rows):
    assert result(spark, rows) == plain(rows)


@pytest.mark.parametrize(("gathered", "block"), [(4, 16), (20, 256), (0, 5)])
def test_large_groups_take_the_other_way(spark, rows, monkeypatch, gathered, block):
    monkeypatch.setattr(minhash, "GATHERED", gathered)
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "COLUMNS", 100)
    assert result(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None)]) == [(1, 0, 1)]


def test_permutations_and_estimate():
    x = np.random.default_rng(1).integers(0, 2**32, 10**6, dtype=np.uint32)
    x = np.unique(x)
    assert len(np.unique(minhash.sigma(x))) == len(x) == len(np.unique(minhash.pi(x.copy())))
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        agree = []
        for _ in range(60):
            h = rng.integers(0, 2**64, 400, dtype=np.uint64)
            common = round(400 * share / (1 + share) * 2 / 2)
            a, b = h[: 200 + common // 2], h[200 - common // 2 :]
            both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((minhash.signature(a) == minhash.signature(b)).mean() - both)
        assert abs(np.mean(agree)) < 0.01 and np.std(agree) < 0.035


def test_chunks_do_not_matter(monkeypatch):
    h = np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64)
    whole = minhash.signature(h)
    monkeypatch.setattr(minhash, "CHUNK", 77)
    assert (minhash.signature(h) == whole).all()


@pytest.mark.parametrize("bits", [64, 2**25])
def test_only_candidates_texts_are_shuffled(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(minhash, "SIFT_BITS", bits)
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    found = minhash.sketches(docs).filter("n_shingles > 1").limit(3)
    wanted = found.selectExpr("CAST(n_shingles AS LONG) AS node", "text_hash", "set_key").dropDuplicates(["node"])
    wanted = minhash.settled(wanted, "test-wanted")
    texts = docs.selectExpr("xxhash64(text) AS text_hash", "text")
    kept = minhash.sifted(texts, wanted, "text_hash", bits)
    hashes = {r.text_hash for r in wanted.collect()}
    passed = [r.text_hash for r in kept.collect()]
    every = [r.text_hash for r in texts.collect()]
    # With bits enough, nothing else comes through; with few, some of the others do and none is missed.
    assert sorted(h for h in passed if h in hashes) == sorted(h for h in every if h in hashes)
    assert bits == 64 or set(passed) == hashes
    assert minhash.shingle_sets(docs, wanted).count() == len(hashes)
