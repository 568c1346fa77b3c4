"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Shingles are hashed into a universe of 2**32 numbers. Two permutations of it make all coordinates of a
signature: sigma scatters the set once, and pi, circularly shifted by k, gives coordinate k as the
smallest pi(sigma(x) - k). Both are bijections by formula, so there is no table and no third hash.
``ROWS`` coordinates make a band, and two sets that agree in a band share a bucket. A pair at the
threshold misses all 64 bands with probability 3e-7.

Documents of equal sets are one node from the start. Buckets that share nodes make a group, which holds
all candidates of its nodes. Links are confirmed on the full sets, never by the signature:

* A group of bounded size is one row, whose sets are compared with each other.
* In a larger one every node is compared with its buckets' pivots, the nodes that share buckets with the
  most others. That connects edited copies by their original, at a few pairs a copy. What is then still
  apart is compared in pairs of blocks: nodes outside the group's main component with the whole group,
  or, where no component holds half of it, bucket by bucket.

No pairs of a group are written out but those with pivots; blocks give one link per node and component.
Nothing is capped. A pivot of many pairs is spread over as many tasks.

Nulls and edges: a document without words has an empty set, is linked with nothing and its own
component; one word is one shingle. A document without identifier joins its component, whose
identifier is the smallest there is, or null where there is none. Repeated rows stay, each with the
same result. Extra columns are not read. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import settled, sifted, table
from kerbside.llm.components import components

SHINGLE = 2
PERCENT = 80
ROWS = 7
BANDS = 64
GATHERED = 512  # nodes, and shingles below, of a group that one row may hold
GATHERED_SHINGLES = 2**20
BLOCK = 256
COLUMNS = 4096  # shingles of a matrix of marks
CHUNK = 1 << 10  # shingles hashed at a time
SIFT_BITS = 2**25  # of the bit table that sifts texts


def sigma(x: np.ndarray) -> np.ndarray:
    """The first permutation of the 32-bit numbers: multiplications by odd numbers and shifts."""
    x = (x ^ x >> np.uint32(16)) * np.uint32(0x7FEB352D)
    x = (x ^ x >> np.uint32(15)) * np.uint32(0x846CA68B)
    return x ^ x >> np.uint32(16)


def pi(x: np.ndarray) -> np.ndarray:
    """The second one; works in place."""
    x *= np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE3D)
    return x


def signature(hashes: np.ndarray, size: int = ROWS * BANDS) -> np.ndarray:
    """The smallest pi(sigma(x) - k) for every k below ``size``, of 64-bit shingle hashes."""
    scattered = sigma((hashes >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(size, dtype=np.uint32)
    least = np.full(size, 2**32 - 1, np.uint32)
    for at in range(0, len(scattered), CHUNK):
        part = scattered[at : at + CHUNK, None] - shifts  # wraps around: the shift is circular
        np.minimum(least, pi(part).min(axis=0), out=least)
    return least


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of a text's different shingles."""
    words = (text or b"").lower().split()  # of bytes, both are ASCII only
    if not words:
        return np.empty(0, np.uint64)
    spelled = {b" ".join(words)}
    if len(words) >= shingle:
        spelled = set(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, spelled), np.uint64, len(spelled)))


def band_keys(sign: np.ndarray, rows: int = ROWS) -> list[int]:
    """A key per band, different between bands."""
    bands = sign.reshape(-1, rows)
    return [xxhash.xxh64_intdigest(b.tobytes(), i) - 2**63 for i, b in enumerate(bands)]


def sketches(docs: DataFrame, shingle: int = SHINGLE, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key, bands); the key is a digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, banded = [], [], []
            for text in batch.column(2):
                hashes = shingle_hashes(text.as_py(), shingle)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh128_digest(hashes.tobytes()))
                banded.append(band_keys(signature(hashes, rows * bands), rows) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()), pa.array(banded, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_key", "bands"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary")).mapInArrow(
        run, f"doc_id {doc_id}, text_hash long, n_shingles long, set_key binary, bands array<long>"
    )


def shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, shingles): the full sets of the nodes ``wanted`` (node, text_hash), from their texts.

    A node's set is that of any document with the text; a text's hash that two texts share is told
    by the set's own key. A bit table of fixed size keeps other texts out of the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t.as_py(), shingle) for t in batch.column(1)]
            keys = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
            right = [i for i, (a, b) in enumerate(zip(keys, batch.column(2).to_pylist())) if a == b]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(right, pa.int64())),
                    pa.array([sets[i].view(np.int64) for i in right], pa.list_(pa.int64())),
                ],
                ["node", "shingles"],
            )

    texts = docs.select(F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    texts = sifted(texts, wanted, "text_hash", SIFT_BITS)
    chosen = texts.join(wanted, "text_hash").select("node", "text", "set_key")
    return chosen.mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def similar(a: list[np.ndarray], b: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which sets of ``a`` are similar to which of ``b``: exact intersections by products of matrices.

    Shingles in one set only meet nothing and get no column.
    """
    sets = [*a, *b]
    sizes = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(len(sets)), sizes)
    kinds, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    rows, column = rows[shared], (np.cumsum(held > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    common = np.zeros((len(a), len(b)))
    for low in range(0, int((held > 1).sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [low, low + COLUMNS])
        marks = np.zeros((len(sets), COLUMNS), np.float32)
        marks[rows[lo:hi], column[lo:hi] - low] = 1
        common += marks[: len(a)] @ marks[len(a) :].T
    return 100 * common >= percent * (sizes[: len(a), None] + sizes[None, len(a) :] - common)


def forest(near: np.ndarray) -> np.ndarray:
    """For each of some nodes, the first of its component, of a symmetric matrix of links."""
    label = np.arange(len(near))
    while True:
        least = np.where(near, label, len(near)).min(axis=1)
        least = np.minimum(least, label)
        if (least == label).all():
            return label
        label = least[least]


def _edges(nodes: list[int], to: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(to, pa.int64())], ["node", "to"])


def linked_groups(groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, to) from rows ``held`` of (node, shingles): a spanning forest of each row's links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = [], []
            for row in batch.column(0):
                held = row.values
                nodes = held.field("node").to_numpy()
                sets = [s.values.to_numpy() for s in held.field("shingles")]
                label = forest(similar(sets, sets, percent))
                moved = label != np.arange(len(nodes))
                out[0].extend(nodes[moved].tolist())
                out[1].extend(nodes[label[moved]].tolist())
            yield _edges(*out)

    return groups.select("held").mapInArrow(run, "node long, to long")


def linked_blocks(blocks: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, to) from rows of two blocks of (node, root, shingles): links between different roots.

    A node of ``few`` gets one link to each root it has links to in ``many``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list] = [], []
            for few, many in zip(batch.column(0), batch.column(1)):
                (nodes, roots, sets), (others, other_roots, other_sets) = (
                    (
                        x.values.field("node").to_numpy(),
                        x.values.field("root").to_numpy(),
                        [s.values.to_numpy() for s in x.values.field("shingles")],
                    )
                    for x in (few, many)
                )
                near = similar(sets, other_sets, percent) & (roots[:, None] != other_roots)
                for i in np.nonzero(near.any(axis=1))[0].tolist():
                    at = np.nonzero(near[i])[0]
                    first = at[np.unique(other_roots[at], return_index=True)[1]]
                    out[0].extend([int(nodes[i])] * len(first))
                    out[1].extend(others[first].tolist())
            yield _edges(*out)

    return blocks.select("few", "many").mapInArrow(run, "node long, to long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (node, to) whose full sets are similar enough.

    Sets travel to the pairs in two joins. A node with many pairs as ``to`` has its set copied for
    every ``BLOCK`` of them, so that they spread over tasks.
    """
    members = sets.selectExpr("node", "shingles AS own")
    pivots = sets.selectExpr("node AS to", "shingles AS other")
    degree = pairs.groupBy("to").agg(F.expr(f"count(1) DIV {BLOCK} + 1").alias("copies"))
    dealt = pairs.join(degree, "to").selectExpr("node", "to", "pmod(xxhash64(node), copies) AS copy")
    copied = pivots.join(degree, "to").selectExpr("to", "other", "explode(sequence(0L, copies - 1)) AS copy")
    return (
        dealt.join(members, "node")
        .join(copied, ["to", "copy"])
        .selectExpr("node", "to", "size(own) + size(other) AS total", "size(array_intersect(own, other)) AS common")
        .filter(f"100L * common >= {percent}L * (total - common)")
        .select("node", "to")
    )


def star_pairs(buckets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, to, alike): every node of a bucket with its pivot, and whether their sizes allow a link.

    The pivot is the node that shares buckets with the most others, as the original of edited copies
    does.
    """
    reach = settled(
        buckets.join(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")), "bucket")
        .groupBy("node").agg(F.sum("held").alias("reach")),
        "minhash-reach",
    )
    known = buckets.join(reach, "node").join(nodes.select("node", "n"), "node")
    best = known.groupBy("bucket").agg(F.expr("max(struct(reach, node, n))").alias("p"))
    return (
        known.join(best, "bucket")
        .filter("node <> p.node")
        .selectExpr("node", "p.node AS to", f"100L * least(n, p.n) >= {PERCENT}L * greatest(n, p.n) AS alike")
        .distinct()
    )


def blocked(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(few, many) of (group, node, root): what lies outside a group's main root, with all of the group.

    Both sides are dealt to blocks of some ``BLOCK`` nodes; each pair of blocks is a row.
    """
    by_root = groups.groupBy("group", "root").agg(F.count(F.lit(1)).alias("c"))
    main = by_root.groupBy("group").agg(
        F.expr("max(struct(c, root)).root").alias("main"),
        F.expr(f"sum(c) DIV {BLOCK} + 1").alias("many_blocks"),
        F.expr(f"(sum(c) - max(c)) DIV {BLOCK} + 1").alias("few_blocks"),
        F.count(F.lit(1)).alias("roots"),
    )
    known = groups.join(main.filter("roots > 1").drop("roots"), "group").join(sets, "node")
    dealt = known.withColumns(
        {"i": F.expr("pmod(xxhash64(node), few_blocks)"), "j": F.expr("pmod(xxhash64(node), many_blocks)")}
    )
    one = F.collect_list(F.struct("node", "root", "shingles"))
    few = dealt.filter("root <> main").withColumn("j", F.expr("explode(sequence(0L, many_blocks - 1))"))
    many = dealt.withColumn("i", F.expr("explode(sequence(0L, few_blocks - 1))"))
    keys = ["group", "i", "j"]
    return few.groupBy(*keys).agg(one.alias("few")).join(many.groupBy(*keys).agg(one.alias("many")), keys)


def links(nodes: DataFrame, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(node, root) of all nodes that are not their component's first.

    ``nodes`` is (node, n, bands, text_hash, set_key).
    """
    keyed = nodes.selectExpr("node", "explode(bands) AS bucket")
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("bucket")
    buckets = settled(keyed.join(shared, "bucket").select("bucket", "node"), "minhash-buckets")
    pairs = settled(star_pairs(buckets, nodes), "minhash-pairs")
    groups = settled(components(pairs.select("node", "to")), "minhash-groups")
    wanted = groups.select("node").unionByName(groups.selectExpr("root AS node")).distinct()
    known = nodes.select("node", "n", "text_hash", "set_key").join(wanted, "node")
    sets = settled(shingle_sets(docs, known.drop("n"), shingle), "minhash-sets")
    placed = known.select("node", "n").join(groups, "node", "left")
    placed = settled(placed.selectExpr("node", "n", "coalesce(root, node) AS group"), "minhash-placed")
    sizes = placed.groupBy("group").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("shingles"))
    sizes = settled(sizes.withColumn("whole", F.expr(f"held <= {GATHERED} AND shingles <= {GATHERED_SHINGLES}")), "minhash-sizes")
    small = placed.join(sizes.filter("whole"), "group").select("group", "node").join(sets, "node")
    gathered = small.groupBy("group").agg(F.collect_list(F.struct("node", "shingles")).alias("held"))
    edges = settled(linked_groups(gathered, percent), "minhash-links")
    large = placed.join(sizes.filter("NOT whole").select("group"), "group").select("group", "node")
    if not large.isEmpty():
        edges = edges.unionByName(_large_links(settled(large, "minhash-large"), buckets, pairs, sets, percent))
    return components(edges)


def _large_links(large: DataFrame, buckets: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, to): what connects the nodes of large groups (group, node).

    First every node with its pivots. What that leaves apart is compared in blocks: where one
    component holds most of a group, the rest with the whole group, else bucket by bucket. Sets of
    other nodes are left out once, before the joins.
    """
    sets = settled(sets.join(large.select("node"), "node", "left_semi"), "minhash-large-sets")
    own = pairs.filter("alike").join(large.select("node"), "node").select("node", "to")
    found = settled(verified(own, sets, percent), "minhash-stars")
    rooted = large.join(components(found), "node", "left").selectExpr("group", "node", "coalesce(root, node) AS root")
    rooted = settled(rooted, "minhash-rooted")
    main = rooted.groupBy("group", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("group")
    dense = main.agg(F.expr("2 * max(c) >= sum(c)").alias("dense"))
    judged = rooted.join(dense, "group")
    by_group = judged.filter("dense").select("group", "node", "root")
    by_bucket = judged.filter("NOT dense").select("node", "root").join(buckets, "node")
    few = settled(linked_blocks(blocked(by_group, sets), percent), "minhash-dense")
    rest = by_bucket.selectExpr("bucket AS group", "node", "root")
    return found.unionByName(few).unionByName(settled(linked_blocks(blocked(rest, sets), percent), "minhash-sparse"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Output: doc_id, text_hash, n_shingles, component_id; one row per document."""
    found = settled(sketches(docs, shingle), "minhash-sketches")
    sets = found.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("first_id"),
        F.min("text_hash").alias("text_hash"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    )
    # Numbered as they are written, so that a number stays with its set.
    nodes = settled(sets.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    roots = settled(links(nodes, docs, shingle, percent), "minhash-roots")
    rooted = nodes.select("node", "set_key", "first_id").join(roots, "node", "left")
    linked = rooted.unionByName(
        # A component's first node has no row of its own among the roots.
        nodes.select("node", "set_key", "first_id").join(
            roots.selectExpr("root AS node").distinct().withColumn("root", F.col("node")), "node"
        )
    ).filter("root IS NOT NULL")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # A large component is dealt over copies of its one row.
    copies = least.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(15))))
    linked = linked.withColumn("copy", F.pmod(F.xxhash64("node"), F.lit(16)).cast("int"))
    by_link = linked.join(copies, ["root", "copy"]).select("set_key", "component_id")
    alone = rooted.filter("root IS NULL").join(least.selectExpr("root AS node"), "node", "left_anti")
    by_set = by_link.unionByName(alone.selectExpr("set_key", "first_id AS component_id"))
    # A set of very many copies is one row on the right: Spark splits the left.
    held = found.filter("n_shingles > 0").join(by_set, "set_key")
    empty = found.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "text_hash", "n_shingles", "component_id"]
    return held.select(*columns).unionByName(empty.select(*columns))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component; one of each is kept."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
