"""URL filters against a plain look-up in time; fingerprints against their definition."""

import hashlib
import random
from datetime import datetime, timedelta

import pytest
import xxhash
from kerbside.llm import fingerprint, urlfilter

CAPTURES = "capture_id long, url string, fetched_at timestamp_ntz, key string, i int"
ENTRIES = "list_name string, key string, action string, at timestamp_ntz, month int"
DAY0 = datetime(2024, 1, 1)


def plain_keys(url):
    import re

    m = re.match(urlfilter.URL_PARTS, url or "")
    host = m[1].lower() if m else ""
    if not host:
        return []
    labels = host.split(".")
    out = [".".join(labels[i:]) for i in range(len(labels) - 1)]
    steps = [s for s in m[2].split("/") if s]
    return [*out, *(f"{host}/{'/'.join(steps[:i])}" for i in range(1, len(steps) + 1))]


def plain_judge(captures, entries):
    out = []
    for capture_id, url, at in captures:
        matches = set()
        for name, key in {(n, k) for n, k, _, _ in entries}:
            before = [(t, a) for n, k, a, t in entries if (n, k) == (name, key) and t is not None and a in ("add", "remove")]
            before = [x for x in before if at is not None and x[0] <= at]
            if key is not None and key in plain_keys(url) and before and max(before)[1] == "add":
                matches.add(f"{name}:{key}")
        out.append((capture_id, sorted(matches), bool(matches)))
    return sorted(out, key=str)


def test_captures_meet_the_lists_of_their_time(spark):
    rng = random.Random(6)
    hosts = ["a.example.org", "b.example.org", "example.net", "X.Deep.Sub.Example.com", "localhost", "1.2.3.4"]
    captures = [
        (i, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'u:p@'])}{rng.choice(hosts)}{rng.choice(['', ':80'])}"
            f"{rng.choice(['', '/', '/p', '/p/q?x=/y', '/P//q#z'])}", DAY0 + timedelta(days=rng.randint(0, 400)))
        for i in range(300)
    ]
    captures += [(900, None, DAY0), (901, "not an address", DAY0), (902, "http:///x", DAY0), (903, captures[0][1], None), captures[1], captures[1], (None, *captures[2][1:])]
    keys = ["example.org", "b.example.org", "sub.example.com", "example.net/p", "example.net/p/q", "1.2.3.4", "other.org"]
    entries = [
        (rng.choice(["one", "two"]), rng.choice(keys), rng.choice(["add", "remove"]), DAY0 + timedelta(days=rng.randint(-50, 420)))
        for _ in range(120)
    ]
    entries += [("one", None, "add", DAY0), ("one", "example.net", "add", None), ("one", "example.net", "keep", DAY0)]
    entries += [("one", "example.net", "add", DAY0), ("one", "example.net", "remove", DAY0), entries[0]]
    c = spark.createDataFrame([(*x, "k", 1) for x in captures], CAPTURES)
    e = spark.createDataFrame([(*x, 1) for x in entries], ENTRIES)
    got = [(r.capture_id, r.matches, r.blocked) for r in urlfilter.judge(c, e).collect()]
    assert sorted(got, key=str) == plain_judge(captures, entries)
    assert urlfilter.judge(c, e.limit(0)).filter("blocked").count() == 0
    assert urlfilter.judge(c.limit(0), e).count() == 0
    assert urlfilter.judge(c.filter("fetched_at IS NULL"), e).count() == 1


def test_hosts_of_one_label_can_be_listed(spark):
    urls = ["http://localhost/", "https://u@LocalHost:80/p/q", "http://intranet", "http://a.localhost/", "http://other/"]
    c = spark.createDataFrame([(i, u, DAY0, "k", 1) for i, u in enumerate(urls)], CAPTURES)
    e = spark.createDataFrame([("one", k, "add", DAY0, 1) for k in ("localhost", "intranet")], ENTRIES)
    got = {r.capture_id: (r.matches, r.blocked) for r in urlfilter.judge(c, e).collect()}
    local, none = (["one:localhost"], True), ([], False)
    assert got == {0: local, 1: local, 2: (["one:intranet"], True), 3: none, 4: none}


DOCS = "doc_id long, text string, marks string, bucket string, guest string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}é" for i in range(500)]
    out = [(i * 7, " ".join(rng.choices(vocabulary, k=rng.randint(0, 120)))) for i in range(200)]
    out += [(3, None), (4, ""), (5, " \n"), (6, "one"), (8, "a b c d"), (9, "😀é x " * 5000), (10, out[9][1])]
    return [*out, out[3], out[3], (21, "another text of one identifier"), (None, "no name here"), (None, None)]


def chunks(marks):
    return {marks[i : i + 8] for i in range(0, len(marks), 8)}


def dice(a, b):
    a, b = chunks(a), chunks(b)
    return 1.0 if not a and not b else 2 * len(a & b) / (len(a) + len(b))


@pytest.mark.parametrize("bucket", [2048, 4])
def test_edits_and_likeness(spark, rows, monkeypatch, bucket):
    monkeypatch.setattr(fingerprint, "BUCKET_DOCS", bucket)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS).repartition(3)
    got = fingerprint.edited_likeness(df).collect()
    signed = lambda t: (h := xxhash.xxh64_intdigest((t or "").encode(), 42) if t is not None else 42) - (2**64 if h >= 2**63 else 0)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, signed(r[1])))
    want, prints = [], {}
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == sorted(want, key=str)
    text_of = {}
    for i, text in rows:
        text_of.setdefault((i, len(text or "")), text or "")
    for r in got:
        assert r.near_edited == pytest.approx(dice(r.fingerprint, r.edited_fingerprint))
        assert 0 <= r.near_next <= 1
        prints.setdefault(text_of[r.doc_id, r.n_chars], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    own = {text: next(iter(p)) for text, p in prints.items()}
    near = [
        (str(i), len(text or ""), round(dice(own[text or ""], own[after or ""]), 9))
        for (i, text), (_, after) in zip(order, order[1:] + order[:1])
    ]
    assert sorted((str(r.doc_id), r.n_chars, round(r.near_next, 9)) for r in got) == sorted(near)


def test_anchors_are_closed_syncmers(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS)
    k, s = fingerprint.K, fingerprint.S

    def hash_of(words):
        seed = 42
        for w in words:
            seed = xxhash.xxh64_intdigest(w.encode(), seed)
        return seed - 2**64 if seed >= 2**63 else seed

    for r in fingerprint.marks(df.drop("marks"), "text", "m").select("text", "m").collect():
        w = (r.text or "").lower().split(" ") if r.text and r.text.strip() else []
        w = [x for x in (r.text or "").lower().split() if x]
        inner = [hash_of(w[i : i + s]) for i in range(len(w) - s + 1)]
        at = [i for i in range(len(w) - k + 1) if min(inner[i : i + k - s + 1]) in (inner[i], inner[i + k - s])]
        assert len(r.m) == (len(at) or (1 if w else 0))


def test_common_stretches_share_marks(spark):
    rng = random.Random(1)
    a, b, c = (" ".join(f"w{rng.randrange(9999)}" for _ in range(n)) for n in (80, 300, 90))
    df = spark.createDataFrame([(1, f"{a} {b}"), (2, f"{b} {c}"), (3, b)], "doc_id long, text string")
    m = {r.doc_id: set(r.m) for r in fingerprint.marks(df, "text", "m").collect()}
    assert len(m[3] - m[1]) <= 1 and len(m[3] - m[2]) <= 1 and len(m[1] & m[2]) >= len(m[3]) - 2


def test_single_and_no_document(spark):
    one = fingerprint.edited_likeness(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert fingerprint.edited_likeness(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hosts_of_one_label_in_query_and_sql(spark, tmp_path):
    """Listed hosts without a dot match their captures, in the query as in its SQL."""
    import compare
    from kerbside.llm import oracle

    hosts = ["localhost", "spamhost", "intranet", "a", "b", "c", "d", "x.spam.org", "spam.org", ""]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/p/q", "/p?x=1")]
    rows = [(i, u, "x") for i, u in enumerate(urls * 20)] + [(9000, None, "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = urlfilter.op8_url_filters(spark, str(tmp_path)).toPandas()
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert compare.difference(got, con.sql(oracle.ORACLES["op8_url_filters"]).df()) is None
    assert got[got.host == "spamhost"].blocked.all() and got.matches.str.contains("hosts:").any()
