"""Mixing sources to target weights with a low-discrepancy schedule.

The mix is a schedule of slots. Slot i takes the point frac(i * golden ratio) and the source whose span of
cumulative weights holds it, so every stretch of the schedule is close to the weights. A source with n
slots cuts its target into n + 1 parts: n blocks of equal size, one to each slot in order, and what its
target then lacks, which one closing slot takes at the schedule's end. So every source, whatever its size,
has its own block size and ends on its target to the word. Blocks follow one another along the source's
shuffled stream of documents, which starts again after its last word, ``MAX_EPOCHS`` times at most.
Documents meet the schedule in a join of their pieces with the blocks that slots took.

Nulls and edges: a null text has no words and is never taken, a null source is a source of its own
and the last, a null identifier is shuffled as the empty one, repeated rows count each. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import id_text, md5_number, settled, table, words

MAX_EPOCHS = 3
SLOTS = 2**16  # the schedule's length at any size of the corpus
SLOTS_PER_SOURCE = 64
CHUNKS_PER_ROOT = 4  # chunks of the shuffle per square root of the number of documents
GOLDEN = 0.6180339887498949
CELLS = 4096


def sized_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, text_hash, size in words, place in the shuffle)."""
    return docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("text_hash"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        # Of identifier and text, so that documents that share one spread all the same.
        md5_number(
            F.concat_ws(":", F.lit(str(seed)), id_text("doc_id"), F.md5(F.coalesce("text", F.lit(""))))
        ).alias("place"),
    )


def source_targets(sized: DataFrame) -> DataFrame:
    """(source_no, source, source_size, target, lo, hi): one row per source.

    Sources by code point, null last, weigh 1, 2, 3 and again; together they get the words of all.
    The level is the largest of those that come from capping the sources with the least words for
    their weight, so one ordered pass shares out the excess.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    ranked = sizes.withColumn(
        "source_no", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", (F.col("source_no") % 3 + 1).cast("double"))
    scarce = every.orderBy(F.expr("source_size / weight"), "source_no")
    before = scarce.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(every) - MAX_EPOCHS * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max(F.col("rest") / F.col("weight_left")).over(every)
    target = F.least(F.col("level") * F.col("weight"), (MAX_EPOCHS * F.col("source_size")).cast("double"))
    upto = every.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranked.withColumns({"rest": rest, "weight_left": weight_left})
        .withColumn("level", level)
        .withColumn("target", target)
        .withColumn("hi", F.sum("target").over(upto))
        .withColumn("total", F.sum("target").over(every))
        .selectExpr(
            "source_no",
            "source",
            "source_size",
            "target",
            "CASE WHEN total > 0 THEN (hi - target) / total ELSE 0D END AS lo",
            "CASE WHEN total > 0 THEN hi / total ELSE 0D END AS hi",
        )
    )


def schedule(spark: SparkSession, targets: DataFrame, n_slots: int) -> DataFrame:
    """(slot, source_no, rank): whose turn each slot is, and its number among its source's slots.

    Points and spans meet in cells of [0, 1), an equi-join. Ranks are counted in chunks of slots
    and the chunks' counts summed, so no task holds all slots of a source.
    """
    last = CELLS - 1
    spans = targets.filter("hi > lo").withColumn(
        "cell",
        F.expr(
            f"explode(sequence(least({last}, int(lo * {CELLS})), least({last}, int(hi * {CELLS}))))"
        ),
    )
    points = (
        spark.range(n_slots)
        .withColumnRenamed("id", "slot")
        .withColumn("point", F.expr(f"slot * {GOLDEN!r}D - floor(slot * {GOLDEN!r}D)"))
        .withColumn("cell", F.expr(f"least({last}, int(point * {CELLS}))"))
        .withColumn("chunk", F.expr("slot div 1024"))
    )
    spans = spans.select("source_no", "lo", "hi", "cell")
    held = points.join(spans, "cell").filter("lo <= point AND point < hi")
    counts = held.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "source_no", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    own = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot"))
    return (
        held.withColumn("own", own)
        .join(offsets, ["source_no", "chunk"])
        .selectExpr("slot", "source_no", "offset + own - 1 AS rank")
    )


def with_blocks(targets: DataFrame, scheduled: DataFrame) -> DataFrame:
    """The targets with ``wanted`` words, the source's number of slots ``n_slots`` and its ``block``."""
    counts = scheduled.groupBy("source_no").agg(F.count(F.lit(1)).alias("n_slots"))
    return (
        targets.join(counts, "source_no", "left")
        .withColumn("n_slots", F.coalesce("n_slots", F.lit(0)))
        .withColumn("wanted", F.expr("CAST(round(target) AS BIGINT)"))
        .withColumn("block", F.expr("wanted div (n_slots + 1)"))
    )


def blocks(scheduled: DataFrame, sources: DataFrame, n_slots: int) -> DataFrame:
    """(slot, source_no, rank, since, until): the words of the source's endless stream a slot takes."""
    closing = sources.selectExpr(f"{n_slots} + source_no AS slot", "source_no", "n_slots AS rank")
    return (
        scheduled.unionByName(closing)
        .join(sources.select("source_no", "n_slots", "wanted", "block"), "source_no")
        .withColumn("since", F.expr("rank * block"))
        .withColumn("until", F.expr("CASE WHEN rank = n_slots THEN wanted ELSE since + block END"))
        .filter("until > since")
        .select("slot", "source_no", "rank", "since", "until")
    )


def taken_words(taken: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_no, cell, spans): what slots take of each cell of a source's stream.

    Blocks are cut where the stream starts again, and at the borders of cells, which are as long as the
    source's blocks. A cell meets a few spans, two for each time the stream is gone through.
    """
    return (
        taken.join(sources.select("source_no", "source_size", "block"), "source_no")
        .withColumn("epoch", F.expr("explode(sequence(since div source_size, (until - 1) div source_size))"))
        .withColumn("lo", F.expr("greatest(since - epoch * source_size, 0L)"))
        .withColumn("hi", F.expr("least(until - epoch * source_size, source_size)"))
        .withColumn("width", F.expr("greatest(block, 1L)"))
        .withColumn("cell", F.expr("explode(sequence(lo div width, (hi - 1) div width))"))
        .selectExpr(
            "source_no",
            "cell",
            "struct(greatest(lo, cell * width) AS lo, least(hi, (cell + 1) * width) AS hi) AS span",
        )
        .groupBy("source_no", "cell")
        .agg(F.collect_list("span").alias("spans"))
    )


def streams(sized: DataFrame, targets: DataFrame, n_docs: int) -> DataFrame:
    """Documents with words, with the word of their source's stream at which they ``start``.

    A stream is cut into chunks by the place in the shuffle; sums of chunks give the offsets, so a
    source with a third of all documents spreads over as many tasks as it has chunks. Chunks per
    source and documents per chunk both grow with the square root of the number of documents.
    """
    chunks = max(1, int(CHUNKS_PER_ROOT * n_docs**0.5))
    width = -(-(2**32) // chunks)
    # One row per source.
    numbered = (
        sized.filter("size > 0")
        .alias("d")
        .join(
            targets.select("source_no", "source", "source_size", "wanted", "block").alias("t"),
            F.expr("d.source <=> t.source"),
        )
        .select("d.*", "source_no", "source_size", "wanted", "block", F.expr(f"place div {width}").alias("chunk"))
    )
    sums = numbered.groupBy("source_no", "chunk").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sums.select(
        "source_no", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")
    )
    own = F.sum("size").over(
        Window.partitionBy("source_no", "chunk")
        .orderBy("place", "doc_id", "size", "text_hash")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        numbered.withColumn("own", own)
        .join(offsets, ["source_no", "chunk"])
        .withColumn("start", F.col("offset") + F.col("own") - F.col("size"))
        .drop("offset", "own", "chunk")
    )


def pieces(streamed: DataFrame) -> DataFrame:
    """Documents cut at the borders of their source's cells: adds (cell, lo, hi).

    Of a source that is not gone through once, only what the mix reaches is cut.
    """
    return (
        streamed.withColumn("reach", F.expr("least(start + size, wanted)"))
        .filter("start < reach")
        .withColumn("width", F.expr("greatest(block, 1L)"))
        .withColumn("cell", F.expr("explode(sequence(start div width, (reach - 1) div width))"))
        .withColumn("lo", F.expr("greatest(start, cell * width)"))
        .withColumn("hi", F.expr("least(reach, (cell + 1) * width)"))
    )


def mix(docs: DataFrame, slots: int = SLOTS, seed: int = 0) -> DataFrame:
    """Output: doc_id, size, source_size, target, taken, source, text_hash.

    ``taken`` is how many words the mix takes of the document, repeats counted.
    """
    spark = docs.sparkSession
    sized = settled(sized_documents(docs, seed), "mix-sized")
    n_docs = sized.count()
    targets = settled(source_targets(sized), "mix-targets")
    n_slots = max(slots, SLOTS_PER_SOURCE * targets.count())
    scheduled = settled(schedule(spark, targets, n_slots), "mix-schedule")
    sources = settled(with_blocks(targets, scheduled), "mix-sources")
    spans = taken_words(blocks(scheduled, sources, n_slots), sources)
    streamed = streams(sized, sources, n_docs)
    both = "aggregate(spans, 0L, (a, s) -> a + greatest(0L, least(hi, s.hi) - greatest(lo, s.lo)))"
    used = (
        pieces(streamed)
        .join(spans, ["source_no", "cell"])
        .withColumn("words", F.expr(both))
        .groupBy("source_no", "start", "doc_id", "source", "text_hash", "size")
        .agg(F.sum("words").alias("taken"))
        .drop("source_no", "start")
    )
    # Without words, or beyond what the mix reaches.
    none = streamed.filter("start >= wanted").select("doc_id", "source", "text_hash", "size")
    none = none.unionByName(sized.filter("size = 0").drop("place")).withColumn("taken", F.lit(0).cast("long"))
    return (
        used.unionByName(none)
        .alias("d")
        .join(targets.alias("t"), F.expr("d.source <=> t.source"))
        .select("doc_id", "size", "source_size", "target", "taken", "d.source", "text_hash")
    )


def mixed_documents(docs: DataFrame, slots: int = SLOTS, seed: int = 0) -> DataFrame:
    """The documents as often as the mix takes them, to the nearest whole copy, none to three.

    A text is shuffled once, to its copies. Only rows of an identifier and text that occur more than
    once are told apart by their number among them.
    """
    taken = mix(docs, slots, seed).selectExpr(
        "doc_id AS _mx_i",
        "text_hash AS _mx_h",
        "CASE WHEN size > 0 THEN int(floor(taken / size + 0.5D)) ELSE 0 END AS _mx_copies",
    )
    held = settled(
        taken.groupBy("_mx_i", "_mx_h").agg(
            F.count(F.lit(1)).alias("_mx_rows"),
            # How many of the rows are taken at least once, twice, ...
            *(F.count_if(F.col("_mx_copies") >= n).alias(f"_mx_{n}") for n in range(1, MAX_EPOCHS + 1)),
        ),
        "mix-copies",
    ).filter("_mx_1 > 0")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.withColumns({"_mx_id": F.col("doc_id"), "_mx_hash": F.xxhash64("text")})
    on = F.expr("_mx_id <=> _mx_i AND _mx_hash = _mx_h")
    once = hashed.join(held.filter("_mx_rows = 1"), on)
    same = Window.partitionBy("_mx_id", "_mx_hash").orderBy("source")
    several = hashed.join(held.filter("_mx_rows > 1"), on).withColumn("_mx_no", F.row_number().over(same))
    return (
        once.withColumn("_mx_no", F.lit(1))
        .unionByName(several)
        .withColumn("_mx_times", F.expr(" + ".join(f"int(_mx_no <= _mx_{n})" for n in range(1, MAX_EPOCHS + 1))))
        .filter("_mx_times > 0")
        .withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), F.col("_mx_times"))))
        .select(*columns)
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' targets."""
    return mix(table(spark, sf_dir, "documents")).drop("text_hash")
