"""Decontamination against a plain search for every window."""

import hashlib
import random
import re

import pytest
from kerbside.llm import decontamination as dc

DOCS = "doc_id long, text string, tokens string, n_words string, contaminated int"
ITEMS = "item_id long, text string, len int"


def plain_words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items):
    windows = []
    for item, text in items:
        w = plain_words(text)
        name = "null" if item is None else str(item)
        windows += [(name, w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w]
    out = []
    for doc_id, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for name, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i : i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    found.add(name)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    vocabulary = ["the", "of", "Ää", "b2", "été", *("w%d" % i for i in range(30))]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 9, 10, 11, 30])))) for i in range(20)]
    items += [(20, None), (21, "..."), (None, "nameless item"), (3, items[3][1]), (40, items[4][1])]
    docs = [(0, None), (1, ""), (2, "-- !"), (3, "The"), (4, "the of " * 3000)]
    for i in range(5, 60):
        words = rng.choices(vocabulary, k=rng.randint(1, 150))
        if rng.random() < 0.7:
            at = rng.randint(0, len(words))
            words[at:at] = (rng.choice(items)[1] or "").upper().replace("É", "é").replace("Ä", "Ä").split()
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    return [*docs, docs[7], (None, docs[8][1]), (None, docs[9][1]), (8, docs[9][1])], items


def test_documents_of_one_key_share_no_candidates(spark, monkeypatch):
    """Under a null or repeated identifier each text has its own candidates; copies share theirs."""
    kept = {}
    settled = dc.settled
    monkeypatch.setattr(dc, "settled", lambda df, label: kept.setdefault(label, settled(df, label)))
    text = "one two three four five six seven eight nine ten"
    docs = [(k, f"w{i} {text}") for k in (None, 5) for i in range(40)] + [(5, f"w0 {text}")] * 3
    df = spark.createDataFrame([(*d, "x", "y", 1) for d in docs], DOCS)
    items = spark.createDataFrame([(1, text, 1)], ITEMS)
    got = dc.hits(df, items).collect()
    assert len(got) == len(docs) and {r[dc.N_HIT] for r in got} == {10}
    lists = kept["window-candidates"].selectExpr("size(_dc_found) AS n").collect()
    assert len(lists) == 80 and {r.n for r in lists} == {1}


@pytest.mark.parametrize("limit", [50_000, 0])
def test_equals_plain_search(spark, tables, monkeypatch, limit):
    """With small sides broadcast, and with every join shuffled."""
    monkeypatch.setattr(dc, "BROADCAST_ROWS", limit)
    docs, items = tables
    df = spark.createDataFrame([(*d, "x", "y", 1) for d in docs], DOCS)
    bench = spark.createDataFrame([(*b, 1) for b in items], ITEMS)
    got = dc.contamination(df, bench).drop("items").collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, items)
    kept = dc.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    clean = [r[0] for r in plain(docs, items) if not r[5]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_empty_tables(spark, tables):
    docs, items = tables
    df = spark.createDataFrame([(*d, "x", "y", 1) for d in docs], DOCS)
    none = spark.createDataFrame([], ITEMS)
    got = dc.contamination(df, none)
    assert got.filter("contaminated OR n_items > 0").count() == 0 and got.count() == len(docs)
    bench = spark.createDataFrame([(*b, 1) for b in items], ITEMS)
    assert dc.contamination(spark.createDataFrame([], DOCS), bench).count() == 0
