"""Phrases against plain counting."""

import random
import re
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from kerbside.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n int"


def plain(rows, least, top=2000):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    kept = {k: c for k, c in f.items() if c >= least}
    inside = {(g, w[i : i + k], c) for (g, w), c in kept.items() for k in range(2, len(w)) for i in range(len(w) - k + 1)}
    out = {}
    for (g, w), a in kept.items():
        if len(w) > 1 and (g, w, a) not in inside:
            cuts = [(1000 * a * n[g] // (f[g, w[:k]] * f[g, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.setdefault(g, []).append((-score, -a, " ".join(w).encode(), f[g, w[:k]], f[g, w[k:]]))
    return sorted(
        (g, i + 1, p.decode(), -a, l, r, n[g], -s)
        for g, found in out.items()
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    )


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocabulary = [*"abcdefgh", "é", "Ü", "x y", "\x00z", "(q)"]
    stock = [" ".join(rng.choices(vocabulary, k=rng.randint(2, 7))) for _ in range(12)]
    out = [(None, "en"), ("", None), (" \t", "en"), ("...!?", "de"), ("a " * 3000, "en"), ("a\tb\x0bc A B\rc", None)]
    for i in range(250):
        parts = [rng.choice([*stock, rng.choice(vocabulary), rng.choice(vocabulary).upper()]) for _ in range(rng.randint(1, 30))]
        out.append(("".join(p + rng.choice([" ", " ", "\t", ". ", ",", "\n"]) for p in parts), rng.choice(["en", "de", None])))
    return [*out, out[9], out[9]]


@pytest.mark.parametrize(("least", "shards", "bits"), [(20, 3, 2**24), (7, 4, 2**12), (20, 1, 64), (100, 2, 2**24)])
def test_equals_plain_counting(spark, rows, least, shards, bits):
    df = spark.createDataFrame([(i, t, g, "x", 1) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(3)
    got = phrases.collocations(*phrases.phrase_counts(df, least=least, shards=shards, bits=bits, chunk=1500))
    assert sorted(map(tuple, got.collect())) == plain(rows, least)


def test_the_best_of_many_cells(spark, rows):
    df = spark.createDataFrame([(i, t, g, "x", 1) for i, (t, g) in enumerate(rows)], SCHEMA)
    got = phrases.collocations(*phrases.phrase_counts(df, least=5), top=4)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 4)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(*phrases.phrase_counts(none)).count() == 0


@pytest.mark.parametrize("most", [1, 300, 2**26])
def test_counts_are_summed_before_they_are_told(most):
    def batch(found):
        columns = zip(*((g, p, 1, n) for g, p, n in found))
        types = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns, types)], ["lang", "phrase", "n_words", "n"])

    rng = random.Random(5)
    found = [(rng.choice("ab"), rng.choice([b"x", b"y z", b"\xff"]), i) for i in range(300)]
    told = list(phrases.summed((batch(found[i : i + 7]) for i in range(0, 300, 7)), most))
    total, rows = Counter(), 0
    for b in told:
        for g, p, _, n in zip(*(c.to_pylist() for c in b.columns)):
            total[g, p] += n
            rows += 1
    plain_total = Counter()
    for g, p, n in found:
        plain_total[g, p] += n
    assert total == plain_total and list(phrases.summed([], most)) == []
    assert most < 2**26 or rows == 6


def test_rows_of_the_last_scan_do_not_grow_with_the_chunks(spark, rows):
    df = spark.createDataFrame([(i, t, g, "x", 1) for i, (t, g) in enumerate(rows)], SCHEMA).coalesce(1)
    every = phrases.BitTable(phrases.np.full(8, 255, phrases.np.uint8))
    few, many = (phrases.chunks(df, 1, size) for size in (2**23, 500))
    assert many.count() > 5 * few.count()
    told = [phrases.spelled(c.coalesce(1), every, 3) for c in (few, many)]
    kinds = told[0].select("lang", "phrase", "n_words").distinct().count()
    assert [t.count() for t in told] == [kinds, kinds]


@pytest.mark.parametrize("stretch", [1, 2, 7, 2**19])
def test_phrases_of_stretches_are_those_of_the_whole(stretch):
    rng = phrases.np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 9).astype(phrases.np.uint64)
    codes = rng.integers(0, 9, 500, phrases.np.int32)
    reached = phrases.BitTable(rng.integers(0, 256, 64).astype(phrases.np.uint8) | 0x55)
    got, whole = (
        sorted(
            (n, int(at), int(h), int(a), int(b))
            for n, place, hashed, parts in phrases.places_of_phrases(hashes, codes, reached, 5, size)
            for at, h, a, b in zip(place, hashed, *parts)
        )
        for size in (stretch, len(codes))
    )
    assert got == whole and {n for n, *_ in whole} == {2, 3, 4, 5}


def test_memory_to_find_phrases_does_not_grow_with_the_chunk():
    every = phrases.BitTable(phrases.np.full(8, 255, phrases.np.uint8))
    rng = phrases.np.random.default_rng(4)
    hashes = rng.integers(0, 2**63, 50).astype(phrases.np.uint64)

    def peak(length):
        codes = rng.integers(0, 50, length, phrases.np.int32)
        tracemalloc.start()
        found = sum(len(place) for _, place, _, _ in phrases.places_of_phrases(hashes, codes, every, 5))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found > length
        return most

    assert peak(2**22) < 1.3 * peak(2**20)


def test_python_gets_some_megabytes_at_a_time(spark, tmp_path):
    text = "word " * 100_000
    df = spark.createDataFrame([(i, text, "en", "x", 1) for i in range(40)], SCHEMA).coalesce(1)
    folder = str(tmp_path / "texts")
    df.write.parquet(folder)

    def sizes(batches):
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes for b in batches], pa.int64())], ["n"])

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    texts = phrases.lean_session(spark).read.parquet(folder).select("text")
    got = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 40 * len(text) and max(got) < phrases.BATCH + 2 * len(text)
    assert spark.conf.get(setting) == before


def test_memory_to_cut_texts_is_not_that_of_their_words_as_objects():
    texts = [b"some words. " * 2000] * 50
    tracemalloc.start()
    words, codes = phrases.chunk_of(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words == [b".", b"some", b"words"] and codes.tolist() == [0, *[1, 2, 0] * 2000] * 50
    assert most < 5 * codes.nbytes
