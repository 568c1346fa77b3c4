"""Document fingerprints from closed syncmers over words.

A k-mer of ``K`` words is an anchor if the smallest of its inner runs of ``S`` words, by hash, is the
first or the last. Whether it is one depends on its own words only, so an edit elsewhere moves no
anchor. A fingerprint is the text's anchors in order, each with the distance to the next one: equal
stretches give equal marks wherever they stand, and a mark fits only where the spacing fits, too.
Texts without anchors, all under ``K`` words among them, are one mark; texts without words have none.

The likeness of two fingerprints is the share of their different marks that both have (twice the
common ones over the sum). Everything is built-in expressions.

Nulls and edges: a null text is empty; two fingerprints without marks are alike (1), one without is
unlike any other (0). Documents without identifier come last, by text hash; repeated identifiers are
ordered by text hash. A single document is its own successor. Identifiers are numbers. Extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import settled, table, words

K, S = 5, 2
BUCKET_DOCS = 2048
MAX_BUCKETS = 1 << 16  # bounds the rows that are broadcast: the first document of each bucket
CELLS = 128


def marks(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``, the marks of column ``text`` as an array of ints, in order."""
    w, s, p = f"_{out}_words", f"_{out}_inner", f"_{out}_at"
    last = K - S
    inner = ", ".join(f"{w}[i + {j}]" for j in range(S))
    least = ", ".join(f"{s}[i + {j}]" for j in range(last + 1))
    own = ", ".join(f"{s}[{p}[j] + {i}]" for i in [*range(0, last, S), last])
    return (
        df.withColumn(w, words(F.lower(F.coalesce(F.col(text), F.lit("")))))
        .withColumn(
            s,
            F.expr(
                f"transform(CASE WHEN size({w}) >= {K} THEN sequence(0, size({w}) - {S}) ELSE array() END,"
                f" i -> xxhash64({inner}))"
            ),
        )
        .withColumn(
            p,
            F.expr(
                f"filter(CASE WHEN size({s}) > {last} THEN sequence(0, size({s}) - {last} - 1) ELSE array() END,"
                f" i -> least({s}[i], {s}[i + {last}]) = least({least}))"
            ),
        )
        .withColumn(
            out,
            F.expr(
                f"CASE WHEN size({w}) = 0 THEN array() WHEN size({p}) = 0"
                f" THEN array(hash(array_join({w}, ' ')))"
                f" ELSE transform(sequence(0, size({p}) - 1), j -> hash({own},"
                f" CASE WHEN j + 1 < size({p}) THEN {p}[j + 1] - {p}[j] ELSE 0 END)) END"
            ),
        )
        .drop(w, s, p)
    )


def as_text(marked: str) -> Column:
    """Marks as one string, eight hex digits each."""
    return F.expr(
        f"array_join(transform({marked}, m -> lpad(lower(hex(m & 4294967295L)), 8, '0')), '')"
    )


def likeness(a: str, b: str) -> Column:
    """Of two arrays of marks, 0 to 1."""
    return F.expr(
        f"CASE WHEN size({a}) + size({b}) = 0 THEN 1D ELSE"
        f" 2D * size(array_intersect({a}, {b})) / (size(array_distinct({a})) + size(array_distinct({b}))) END"
    )


def _buckets(docs: DataFrame) -> DataFrame:
    """Adds ``bucket``, which grows with (doc_id, text_hash), of some ``BUCKET_DOCS`` documents.

    Cells of about equal numbers of documents are cut evenly by identifier. Documents without one
    follow, by hash.
    """
    seen = docs.agg(
        F.count("doc_id").alias("n"),
        F.percentile_approx("doc_id", [i / CELLS for i in range(CELLS + 1)], 10_000).alias("at"),
    ).first()
    at = sorted(set(seen["at"] or [0]))
    fine = max(1, min(MAX_BUCKETS // 2, -(-(seen.n or 0) // BUCKET_DOCS)) // max(1, len(at) - 1))
    bounds = f"array({', '.join(f'{x}D' if isinstance(x, float) else f'{int(x)}L' for x in at)})"
    cell = F.expr(f"greatest(1, size(filter({bounds}, b -> b <= doc_id)))")
    inside = F.expr(
        f"CASE WHEN cell >= {len(at)} THEN 0 ELSE least({fine - 1}, int({fine}D * (doc_id -"
        f" {bounds}[cell - 1]) / ({bounds}[cell] - {bounds}[cell - 1]))) END"
    )
    nameless = MAX_BUCKETS + F.shiftright("text_hash", 52)
    return (
        docs.withColumn("cell", cell)
        .withColumn("bucket", F.when(F.col("doc_id").isNull(), nameless).otherwise(F.col("cell") * fine + inside))
        .drop("cell")
    )


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, marks, next_text, next_marks), the next document by identifier.

    Texts are shuffled once, by bucket. Each bucket gets a copy of the document after its last, the
    first of the next bucket, so that every successor is at hand.
    """
    named = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_hash")
    )
    named = _buckets(named)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    firsts = settled(named.groupBy("bucket").agg(F.min(order).alias("first")), "bucket-firsts")
    by_bucket = Window.partitionBy().orderBy("bucket")
    # At most 2 * MAX_BUCKETS rows; the first bucket follows the last.
    guests = firsts.select(
        F.coalesce(
            F.lag("bucket").over(by_bucket), F.max("bucket").over(Window.partitionBy())
        ).alias("before"),
        F.col("bucket").alias("own"),
        F.col("first.text_hash").alias("first_hash"),
        F.col("first.doc_id").alias("first_id"),
    )
    on = F.expr("bucket = own AND doc_id <=> first_id AND text_hash = first_hash")
    home = F.expr("struct(bucket AS bucket, false AS guest)")
    away = F.expr("struct(before AS bucket, true AS guest)")
    placed = (
        named.join(F.broadcast(guests), on, "left")
        .withColumn("p", F.explode(F.when(F.col("own").isNull(), F.array(home)).otherwise(F.array(home, away))))
        .select("doc_id", "text", "text_hash", "p.bucket", "p.guest")
        .repartition("bucket")
    )
    row = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text_hash")
    return (
        marks(placed, "text", "marks")
        .withColumns({"next_text": F.lead("text").over(row), "next_marks": F.lead("marks").over(row)})
        .filter("NOT guest")
        .select("doc_id", "text", "marks", "next_text", "next_marks")
    )


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Documents, and what their fingerprints make of an edit and of the next document.

    The edited text has its last quarter replaced by the start of the next document.
    """
    pairs = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.expr("n_chars div 4").cast("int")
    pairs = pairs.withColumn(
        "edited",
        F.concat(
            F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut),
            F.substring(F.col("next_text"), F.lit(1), cut),
        ),
    )
    return marks(pairs, "edited", "edited_marks").select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("marks").alias("fingerprint"),
        as_text("edited_marks").alias("edited_fingerprint"),
        likeness("marks", "edited_marks").alias("near_edited"),
        likeness("marks", "next_marks").alias("near_next"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness."""
    return edited_likeness(table(spark, sf_dir, "documents"))
