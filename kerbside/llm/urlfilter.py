"""URL filters as a temporal join of captures with dated lists.

A list is a log of dated entries: a key (a domain, or a host with a path prefix) is added or removed
at a time. Entries become validity intervals, from an addition to the key's next entry. A capture is
judged by what was on the lists when it was fetched: each of its keys, its host's domains and its
path's prefixes, meets the interval of that key that holds the fetch time.

Intervals are cut at months and the join is on key and month, so a host with a third of all captures
spreads over months, and a key that comes and goes often does not meet all its captures.

Nulls and edges: a capture without address, host or fetch time matches nothing and stays; entries
without key or time, or with another action than ``add`` and ``remove``, do not count; entries of one
list, key and time are one, of which a removal wins. Repeated captures get equal results. Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import ascii_lower, md5_number, settled, table

URL_PARTS = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)"
START, DAYS = "2024-01-01", 360


def host_of(url: Column) -> Column:
    """The address's host in lower case, empty where there is none."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 1))


def keys_of(url: Column) -> Column:
    """What a list may name: the host, its domains of two labels or more, and host/path prefixes."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    steps = F.array_remove(
        F.split(F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 2), "/"), ""
    )
    prefixes = F.transform(
        F.when(F.size(steps) >= 1, F.sequence(F.lit(1), F.size(steps))).otherwise(F.array()),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")),
    )
    found = F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(domains, prefixes))
    return F.array_distinct(found)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, key, since, until) from (list_name, key, action, at); ``until`` null: still valid."""
    log = (
        entries.filter("key IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy("list_name", "key", "at")
        .agg(F.max("action").alias("action"))
    )
    later = F.lead("at").over(Window.partitionBy("list_name", "key").orderBy("at"))
    return (
        log.withColumn("until", later)
        .filter("action = 'add'")
        .select("list_name", "key", F.col("at").alias("since"), "until")
    )


def _month(at: str) -> str:
    return f"year({at}) * 12 + month({at})"


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Captures (capture_id, url, fetched_at) against the lists of their time.

    Output: capture_id, url, fetched_at, host, matches, blocked; ``matches`` are ``list:key`` in order.
    """
    captures = captures.select("capture_id", "url", "fetched_at")
    span = captures.agg(F.max("fetched_at").alias("last")).first().last
    intervals = validity_intervals(entries)
    if span is None:
        intervals = intervals.limit(0).withColumn("month", F.lit(0))
    else:
        end = f"least(coalesce(until, TIMESTAMP_NTZ '{span}'), TIMESTAMP_NTZ '{span}')"
        intervals = intervals.filter(f"since <= TIMESTAMP_NTZ '{span}'").withColumn(
            "month", F.expr(f"explode(sequence({_month('since')}, {_month(end)}))")
        )
    keyed = (
        captures.filter("fetched_at IS NOT NULL AND url IS NOT NULL")
        .select("capture_id", "url", "fetched_at", F.explode(keys_of(F.col("url"))).alias("key"))
        .withColumn("month", F.expr(_month("fetched_at")))
    )
    matched = (
        keyed.join(intervals, ["key", "month"])
        .filter("since <= fetched_at AND (until IS NULL OR fetched_at < until)")
        .select("capture_id", "url", "fetched_at", F.concat("list_name", F.lit(":"), "key").alias("m"))
        # A capture has few keys and a key few lists, which bounds the set.
        .groupBy("capture_id", "url", "fetched_at")
        .agg(F.array_sort(F.collect_set("m")).alias("matches"))
        .withColumnsRenamed({"capture_id": "i", "url": "u", "fetched_at": "f"})
    )
    found = captures.join(matched, F.expr("capture_id <=> i AND url = u AND fetched_at = f"), "left")
    return found.select(
        "capture_id",
        "url",
        "fetched_at",
        host_of(F.col("url")).alias("host"),
        F.coalesce("matches", F.array().cast("array<string>")).alias("matches"),
        F.col("matches").isNotNull().alias("blocked"),
    )


def _day(seed: str, text: Column, days: int = DAYS) -> Column:
    """A day of the year that the text's digest names."""
    offset = (md5_number(F.concat(F.lit(seed), text)) % days).cast("int")
    return F.date_add(F.lit(START).cast("date"), offset).cast("timestamp_ntz")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures; the tables have no fetch times, so a page's identifier names its day."""
    return pages.select(
        F.col("page_id").alias("capture_id"),
        "url",
        _day("fetch:", F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("fetched_at"),
    )


def lists_of(pages: DataFrame) -> DataFrame:
    """Dated list entries about the pages' own hosts and paths.

    Every fourth host is on list ``hosts`` from one day and off it on another; hosts named spam are on
    list ``spam`` from the start; every eighth address without query is on list ``paths`` from a day.
    """
    hosts = pages.select(host_of(F.col("url")).alias("key")).filter("key <> ''").distinct()
    listed = hosts.filter(md5_number(F.concat(F.lit("list:"), F.col("key"))) % 4 == 0)
    path = F.array_max(F.filter(keys_of(F.col("url")), lambda k: k.contains("/")))
    paths = pages.select(path.alias("key")).filter("key IS NOT NULL").distinct()
    some = paths.filter(md5_number(F.concat(F.lit("path:"), F.col("key"))) % 8 == 0)

    def entry(df: DataFrame, name: str, action: str, at: Column) -> DataFrame:
        return df.select(F.lit(name).alias("list_name"), "key", F.lit(action).alias("action"), at.alias("at"))

    spam = hosts.filter(F.col("key").contains("spam"))
    return (
        entry(listed, "hosts", "add", _day("add:", F.col("key")))
        .unionByName(entry(listed, "hosts", "remove", _day("remove:", F.col("key"))))
        .unionByName(entry(spam, "spam", "add", F.lit(START).cast("timestamp_ntz")))
        .unionByName(entry(some, "paths", "add", _day("add:", F.col("key"))))
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address against the lists of its fetch time."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(captures_of(pages), settled(lists_of(pages), "list-entries")).select(
        F.col("capture_id").alias("page_id"),
        "fetched_at",
        "host",
        F.array_join("matches", ",").alias("matches"),
        "blocked",
    )
