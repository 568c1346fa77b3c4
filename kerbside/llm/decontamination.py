"""Benchmark decontamination as a prefix-filtered set join of documents with benchmark windows.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window), and it
counts where all of it occurs. Seen as a set, a window is its shingles of ``SHINGLE`` words. All of
them have to be in the document, so its rarest one is a necessary prefix of length one:

1. hashes of all document shingles meet the benchmark's shingles; what stays says where each one
   occurs, and in how many documents, which is the rarity that orders them;
2. occurrences meet the windows of which they are the rarest shingle; the place in the window fixes
   where it would start, and length and position bounds drop what would stick out;
3. candidates go back to their documents, where the words at that place are compared with the
   window's words. Only this exact check makes a hit.

Nulls and edges: a null text, of a document or an item, has no words and no hits; a null item
identifier is the text ``null``; repeated items count once; candidates belong to an identifier and
the text's hash, so copies share them and other documents of one identifier or a null one do not.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import NON_WORD, ascii_lower, settled, table, words

WINDOW = 10
SHINGLE = 3
#: Benchmark rows up to which they are broadcast (some tens of MB); beyond, joins shuffle both sides.
BROADCAST_ROWS = 50_000


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def document_words(text: Column) -> Column:
    """Lower-cased words of letters, digits and whatever is not ASCII."""
    return words(ascii_lower(text), NON_WORD)


def shingle_hashes(tokens: str, size: int) -> str:
    """SQL for the hash of each run of ``size`` words, in order."""
    parts = ", ".join(f"{tokens}[i + {k}]" for k in range(size))
    return (
        f"transform(CASE WHEN size({tokens}) >= {size} THEN sequence(0, size({tokens}) - {size})"
        f" ELSE array() END, i -> xxhash64({size}, {parts}))"
    )


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, tokens, len) and the items of each (window_id, item)."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        document_words(F.col("text")).alias("tokens"),
    ).filter("size(tokens) > 0")
    cut = items.select(
        "item",
        F.expr(
            f"explode(transform(sequence(0, greatest(size(tokens) - {window}, 0)),"
            f" i -> slice(tokens, i + 1, {window})))"
        ).alias("tokens"),
    ).withColumn("window_id", F.sha2(F.concat_ws(" ", "tokens"), 256))
    distinct = cut.groupBy("window_id").agg(F.first("tokens").alias("tokens"))
    return (
        distinct.withColumn("len", F.size("tokens")),
        cut.select("window_id", "item").distinct(),
    )


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(window_id, at, shingle, width) of each window; windows under ``shingle`` words are one."""
    sized = [
        windows.filter(f"least(len, {shingle}) = {n}").select(
            "window_id",
            "len",
            F.lit(n).alias("width"),
            F.expr(f"posexplode({shingle_hashes('tokens', n)}) AS (at, shingle)"),
        )
        for n in range(1, shingle + 1)
    ]
    out = sized[0]
    for more in sized[1:]:
        out = out.unionByName(more)
    return out


#: Columns that :func:`hits` adds; the prefix keeps them apart from the documents' own.
N_WORDS, N_HIT, HIT_WINDOWS = "_dc_n_words", "_dc_n_hit", "_dc_windows"


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Documents with their own columns and ``N_WORDS``, ``N_HIT``, ``HIT_WINDOWS``.

    The last are the windows that occur.
    """
    windows, _ = windows_of(benchmark, window)
    windows = settled(windows, "windows")
    parts = settled(_window_shingles(windows, shingle), "window-shingles")
    n_parts = parts.count()
    # Up to ``shingle`` numbers: the widths that the benchmark's windows need.
    widths = [r.width for r in parts.select("width").distinct().collect()]
    known = _small(parts.select("shingle").distinct(), n_parts)
    text_hash = F.xxhash64("text").alias("_dc_text")
    tokens = docs.select("doc_id", text_hash, document_words(F.col("text")).alias("tokens"))
    found = None
    for width in sorted(widths):
        one = tokens.select(
            "doc_id",
            "_dc_text",
            F.expr(f"posexplode({shingle_hashes('tokens', width)}) AS (pos, shingle)"),
        )
        found = one if found is None else found.unionByName(one)
    if found is None:
        return docs.withColumns(
            {
                N_WORDS: F.size(document_words(F.col("text"))).cast("long"),
                N_HIT: F.lit(0).cast("long"),
                HIT_WINDOWS: F.array().cast("array<string>"),
            }
        )
    found = settled(found.join(known, "shingle", "left_semi"), "shingle-occurrences")
    rarity = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("rarity"))
    prefix = (
        parts.join(rarity, "shingle", "left")
        .groupBy("window_id", "len")
        .agg(F.min(F.expr("struct(coalesce(rarity, 0L) AS n, shingle, at)")).alias("rarest"))
        .filter("rarest.n > 0")
        .select("window_id", "len", "rarest.shingle", "rarest.at")
    )
    candidates = (
        found.join(_small(prefix, n_parts), "shingle")
        .withColumn("start", F.expr("pos - at"))
        .filter("start >= 0")
        .join(_small(windows.select("window_id", "tokens"), n_parts), "window_id")
        .select("doc_id", "_dc_text", F.struct("start", "len", "window_id", "tokens").alias("c"))
        .distinct()
    )
    by_doc = settled(
        candidates.groupBy(F.col("doc_id").alias("_dc_key"), F.col("_dc_text").alias("_dc_hash")).agg(
            F.collect_list("c").alias("_dc_found")
        ),
        "window-candidates",
    )
    # Candidates grow with the corpus, so they are never broadcast by force. Words are cut after the
    # join, so that it moves texts only.
    on = F.expr("doc_id <=> _dc_key AND _dc_text = _dc_hash")
    met = docs.withColumn("_dc_text", F.xxhash64("text")).join(by_doc, on, "left")
    checked = met.withColumn("_dc_tokens", document_words(F.col("text"))).withColumn(
        "_dc_hits",
        F.expr(
            "filter(coalesce(_dc_found, array()), c -> c.start + c.len <= size(_dc_tokens)"
            " AND slice(_dc_tokens, c.start + 1, c.len) = c.tokens)"
        ),
    )
    covered = F.expr(
        "size(array_distinct(flatten(transform(_dc_hits,"
        " c -> sequence(c.start, c.start + c.len - 1)))))"
    )
    return checked.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.size("_dc_tokens").cast("long").alias(N_WORDS),
        covered.cast("long").alias(N_HIT),
        F.expr("array_distinct(transform(_dc_hits, c -> c.window_id))").alias(HIT_WINDOWS),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Output: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    ``items`` are the identifiers, as sorted text, of the items with windows in the document.
    """
    found = hits(docs.select("doc_id", "text"), benchmark, window).drop("text")
    found = settled(found, "decontaminated")
    _, items = windows_of(benchmark, window)
    hit = found.filter(f"size({HIT_WINDOWS}) > 0")
    # Items are looked up per set of windows, not per document: copies share the work. Documents
    # without hits stay out of the join, where they would all be one key.
    named = (
        hit.select(HIT_WINDOWS)
        .distinct()
        .select(HIT_WINDOWS, F.explode(HIT_WINDOWS).alias("window_id"))
        .join(items, "window_id")
        .groupBy(HIT_WINDOWS)
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    clean = found.filter(f"size({HIT_WINDOWS}) = 0").withColumn("items", F.array().cast("array<string>"))
    joined = hit.join(named, HIT_WINDOWS).unionByName(clean)
    return joined.select(
        "doc_id",
        F.col(N_WORDS).alias("n_words"),
        F.col(N_HIT).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col(N_HIT) > 0).alias("contaminated"),
        "items",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    return hits(docs, benchmark, window).filter(f"{N_HIT} = 0").drop(N_WORDS, N_HIT, HIT_WINDOWS)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items).drop("items")
