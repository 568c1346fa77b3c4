"""Mixing against plain water-filling and bounds; sharding against its law."""

import random
import zlib
from collections import Counter

import pytest
from kerbside.llm import mixing, sharding
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string, shard string, taken string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for i in range(600):
        source = rng.choices(["big", "mid", "é", "tiny", None, ""], [50, 20, 15, 1, 5, 9])[0]
        out.append((i, "w " * rng.choice([0, 1, 3, 50, 200]), source))
    return [*out, (None, "a b", "big"), (None, None, "mid"), out[3], out[3], (700, "w " * 20_000, "big")]


def plain_targets(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return sizes, target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over


def test_mix_meets_targets(spark, rows):
    got = mixing.mix(make(spark, rows)).collect()
    sizes, targets = plain_targets(rows)
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    for s, t in targets.items():
        assert taken[s] == pytest.approx(t, rel=0.01, abs=4)
    again = mixing.mix(make(spark, rows[::-1])).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_small_sources_end_on_target_in_a_large_mix(spark):
    """Blocks of the shared schedule have 76 words here, more than most of the small sources have."""
    big = spark.range(500).selectExpr(
        "id AS doc_id", "repeat('w ', 10000) AS text", "concat('big', id % 2) AS source", "'x' AS shard", "'y' AS taken"
    )
    rows = [(10_000 + 100 * k + i, "w " * n, s) for k, (s, n) in enumerate([("a", 5), ("b", 40), ("c", 900)]) for i in range(3)]
    docs = big.unionByName(make(spark, [*rows, (None, "w " * 7, None)]))
    size, target, taken = Counter(), {}, Counter()
    for r in mixing.mix(docs).collect():
        assert r.taken <= 3 * r.size
        size[r.source], target[r.source] = r.source_size, r.target
        taken[r.source] += r.taken
    for s in ("a", "b", "c", None):
        assert taken[s] == target[s] == 3 * size[s]
    assert all(taken[s] == pytest.approx(target[s], rel=0.001) for s in ("big0", "big1"))
    whole = {r.source: r.n for r in mixing.mixed_documents(docs).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert [whole[s] for s in ("a", "b", "c", None)] == [9, 9, 9, 3]


def test_own_blocks_end_inside_a_block(spark):
    """A small source that is not at its cap: its last slot takes part of a block."""
    rows = [(i, "w " * 1000, "a") for i in range(40)] + [(100 + i, "w " * 1501, "b") for i in range(8)]
    got = mixing.mix(make(spark, rows), slots=128).collect()
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert sum(r.taken for r in mine) == round(mine[0].target) and mine[0].target < 3 * mine[0].source_size
    targets = mixing.source_targets(mixing.sized_documents(make(spark, rows)))
    scheduled = mixing.schedule(spark, targets, 128)
    sources = mixing.with_blocks(targets, scheduled)
    slots = mixing.blocks(scheduled, sources, 128).collect()
    assert sorted(r.slot for r in slots) == list(range(130))
    for r in sources.collect():
        mine = sorted((x for x in slots if x.source_no == r.source_no), key=lambda x: x.slot)
        assert [x["rank"] for x in mine] == list(range(r.n_slots + 1))
        # Equal blocks one after the other, the closing slot up to the target.
        assert [x.since for x in mine] == [i * r.block for i in range(len(mine))]
        assert all(x.until == x.since + r.block for x in mine[:-1])
        assert mine[-1].until == round(r.target) and r.block <= mine[-1].until - mine[-1].since <= r.block + r.n_slots


def plain_mix(rows, slots):
    """Words taken by document, by walking along the schedule slot by slot and word by word."""
    import hashlib

    sizes, targets = plain_targets(rows)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    total, edges, at = sum(targets.values()), [], 0.0
    for s in order:
        edges.append((at / total, (at + targets[s]) / total, s))
        at += targets[s]
    turns = Counter()
    for i in range(slots):
        u = i * mixing.GOLDEN % 1
        turns.update([s for lo, hi, s in edges if lo <= u < hi])
    taken = Counter()
    for s in order:
        mine = [(i, t, k) for k, (i, t, x) in enumerate(rows) if x == s and (t or "").split()]
        md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
        mine.sort(key=lambda r: (int(md5(f"0:{'' if r[0] is None else r[0]}:{md5(r[1])}")[:8], 16), r[0] is not None, r[0], len(r[1].split())))
        words = [k for _, t, k in mine for _ in t.split()]
        wanted, n, place = round(targets[s]), turns[s], 0
        for slot in range(n + 1):
            for _ in range(wanted - place if slot == n else wanted // (n + 1)):
                taken[words[place % len(words)]] += 1
                place += 1
    return taken


@pytest.mark.parametrize("slots", [64 * 6, 2000])
def test_equals_a_walk_along_the_schedule(spark, rows, slots):
    """Sources on both sides of a thousand blocks, one far below its slots, one at its cap."""
    some = [*rows[:300], (801, "z " * 9000, "big"), (802, "q", "one"), (803, "w v", "two")]
    some = list({(i, t): (i, t, s) for i, t, s in some}.values())  # repeated rows are taken in any order
    got = mixing.mix(make(spark, some), slots=slots).collect()
    number = {(i, t): k for k, (i, t, _) in enumerate(some)}
    texts = {r.doc_id: t for i, t, _ in some for r in got if r.doc_id == i}
    expected = plain_mix(some, slots)
    for r in got:
        if r.doc_id is not None:
            assert r.taken == expected[number[r.doc_id, texts[r.doc_id]]]
    assert sum(r.taken for r in got) == sum(expected.values())


def test_documents_without_identifier_spread(spark):
    """A third of the rows share the null identifier; no chunk of the shuffle holds them together."""
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN id END AS doc_id", "concat('w ', id) AS text", "'a' AS source", "'x' AS shard", "'y' AS taken"
    )
    places = mixing.sized_documents(df).groupBy("place").count()
    assert places.agg(F.max("count")).first()[0] <= 3


def test_schedule_is_even_everywhere(spark, rows):
    """Every stretch of the schedule is close to the weights."""
    targets = mixing.source_targets(mixing.sized_documents(make(spark, rows)))
    share = {r.source_no: r.hi - r.lo for r in targets.collect()}
    slots = mixing.schedule(spark, targets, 5000).orderBy("slot").collect()
    for at in range(0, len(slots) - 500, 500):
        seen = Counter(r.source_no for r in slots[at : at + 500])
        assert all(abs(seen[s] - 500 * p) <= 8 for s, p in share.items())
    for s in share:
        ranks = [r["rank"] for r in slots if r.source_no == s]
        assert ranks == list(range(len(ranks)))


def test_mixed_documents_are_whole_copies(spark, rows):
    df = make(spark, rows)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words, most = Counter(), Counter()
    for r in out.collect():
        words[r.source] += len(r.text.split())
        most[(r.doc_id, r.text)] += 1
    have = Counter((i, t) for i, t, _ in rows)
    assert all(n <= 3 * have[k] for k, n in most.items())
    _, targets = plain_targets(rows)
    longest = Counter()
    for _, t, s in rows:
        longest[s] = max(longest[s], len((t or "").split()))
    assert all(abs(words[s] - t) <= 4 + longest[s] for s, t in targets.items())


def test_mix_of_nothing(spark):
    assert mixing.mix(make(spark, [])).count() == 0
    got = mixing.mix(make(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [r.taken for r in got] == [0, 0] and mixing.mixed_documents(make(spark, [(1, None, "a")])).count() == 0


def test_shards_hold_near_equal_bytes(spark, rows):
    rows = [r for r in rows if r[0] != 700]
    got = sharding.shard_documents(make(spark, rows), n_shards=7).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    load, slots = Counter(), {}
    for r in got:
        load[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) <= max(r["size"] for r in got)
    want = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == want


def test_a_grown_map_moves_little(spark, rows):
    records = make(spark, rows[:600]).select(
        sharding.record_size().alias("size"), sharding.virtual_slot("doc_id", "text", 512).alias("virtual_slot")
    )
    loads = sharding.slot_loads(records)
    old = sharding.first_map(loads, 5)
    new = sharding.rebalance(old, loads, 6)
    both = old.alias("o").join(new.alias("n"), "virtual_slot").join(loads, "virtual_slot")
    rows_ = both.select("o.shard", F.col("n.shard").alias("to"), "n.version", "bytes").collect()
    assert len(rows_) == loads.count() and {r.version for r in rows_} == {1}
    total = sum(r.bytes for r in rows_)
    assert sum(r.bytes for r in rows_ if r.shard != r.to) <= 0.35 * total
    load = Counter()
    for r in rows_:
        load[r.to] += r.bytes
    assert set(load) == set(range(6)) and max(load.values()) <= 1.15 * total / 6


def test_shards_come_with_the_grown_map(spark, rows):
    """Every document has its shard of version 1, which moves little and fills the new shard."""
    rows = [r for r in rows if r[0] != 700]
    got = sharding.shard_documents(make(spark, rows), n_shards=7).collect()
    assert len(got) == len(rows) and len({(r.virtual_slot, r.rebalanced_shard) for r in got}) == len({r.virtual_slot for r in got})
    load = Counter()
    for r in got:
        load[r.rebalanced_shard] += r["size"]
    total = sum(load.values())
    assert set(load) == set(range(8)) and max(load.values()) <= 1.15 * total / 8
    assert 0 < sum(r["size"] for r in got if r.shard != r.rebalanced_shard) <= 0.35 * total


def test_shards_of_nothing(spark):
    assert sharding.shard_documents(make(spark, [])).count() == 0


def test_sharded_documents_stay_whole(spark, rows):
    df = make(spark, rows).withColumns({"before": F.lit(3), "lang": F.lit("en")})
    got = sharding.sharded_documents(df, n_shards=7)
    narrow = sharding.shard_documents(df, n_shards=7)
    assert got.columns[:9] == narrow.columns and got.columns[9:] == ["text", "source", "taken", "before", "lang"]
    rows_ = lambda x: sorted(map(str, x.collect()))
    assert rows_(got.select(narrow.columns)) == rows_(narrow)
    have = sorted(((i, t, s, "y", 3, "en") for i, t, s in rows), key=str)
    assert sorted(map(tuple, got.select("doc_id", "text", "source", "taken", "before", "lang").collect()), key=str) == have
    assert sharding.sharded_documents(make(spark, [])).count() == 0
