"""Sharding over fixed virtual slots, with a versioned slot-to-shard map.

Records are hashed into a fixed number of virtual slots. What is decided, stored and edited is only
the map from slots to shards, so it has ``n_slots`` rows whatever the corpus holds. Version 0 packs
the slots by their bytes, largest first, each into the lightest shard; :func:`rebalance` edits a
map into the next version and moves no more slots than the new shard count needs.

Nulls and edges: a null text has no bytes, a null key takes its slot from the text's digest, equal
rows share a slot, an empty table gives an empty map and no rows. Extra columns stay; the ones added
replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import md5_number, settled, table

N_SLOTS = 8192
N_SHARDS = 40
OVERHEAD = 16  # bytes a record takes besides its text


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus a fixed overhead."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def virtual_slot(key: str, text: str, n_slots: int = N_SLOTS) -> Column:
    """The record's fixed slot, from its key alone where there is one."""
    name = F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return (md5_number(name) % n_slots).cast("int")


def slot_loads(records: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, records) of the slots in use; partial sums meet in one row per slot."""
    return records.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records")
    )


def _pack(loads: DataFrame, order: str, start: Column) -> DataFrame:
    """(virtual_slot, shard): slots in ``order``, each into the shard that is lightest by then.

    ``start`` has each shard's bytes before. The fold runs over at most ``n_slots`` entries.
    """
    queue = F.array_sort(F.collect_list(F.expr(order)))
    begin = F.struct(F.col("start").alias("load"), F.array().cast("array<int>").alias("to"))

    def place(state: Column, slot: Column) -> Column:
        lightest = F.array_position(state.load, F.array_min(state.load))
        return F.transform(
            F.array(lightest),
            lambda at: F.struct(
                F.transform(
                    state.load, lambda v, i: F.when(i + 1 == at, v + slot.bytes).otherwise(v)
                ).alias("load"),
                F.array_append(state.to, (at - 1).cast("int")).alias("to"),
            ),
        )[0]

    return (
        loads.agg(queue.alias("queue"), start.alias("start"))
        .select("queue", F.aggregate("queue", begin, place).to.alias("to"))
        .select(F.posexplode("queue").alias("i", "slot"), "to")
        .select("slot.virtual_slot", F.expr("to[i]").alias("shard"))
    )


def first_map(loads: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Version 0 of the map: (version, virtual_slot, shard), near-equal bytes per shard."""
    order = "struct(-bytes AS heavy_first, virtual_slot, bytes)"
    packed = _pack(loads, order, F.array_repeat(F.lit(0).cast("long"), n_shards))
    return packed.select(F.lit(0).alias("version"), "virtual_slot", "shard")


def rebalance(slot_map: DataFrame, loads: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map for new loads or more shards.

    Each shard keeps its slots, smallest first, while they fit in the new mean; what does not fit
    moves to the shards that are lightest then. Slots that the map does not know are placed, too.
    """
    held = loads.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot", "left")
    mean = F.sum("bytes").over(Window.partitionBy()) / n_shards
    filled = F.sum("bytes").over(Window.partitionBy("shard").orderBy("bytes", "virtual_slot"))
    judged = held.withColumn("mean", mean).withColumn(
        "stays", F.col("shard").isNotNull() & (F.col("shard") < n_shards) & (filled <= F.col("mean"))
    )
    stay = judged.filter("stays").select("virtual_slot", "shard", "bytes")
    by_shard = stay.groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    start = by_shard.agg(
        F.map_from_entries(F.collect_list(F.struct("shard", "bytes"))).alias("kept")
    )
    start = start.select(
        F.transform(
            F.sequence(F.lit(0), F.lit(n_shards - 1)),
            lambda s: F.coalesce(F.element_at("kept", s), F.lit(0).cast("long")),
        ).alias("start")
    )
    order = "struct(-bytes AS heavy_first, virtual_slot, bytes)"
    # One row of ``n_shards`` numbers goes to every moving slot.
    moving = judged.filter("NOT stays").withColumn("one", F.lit(1))
    moving = moving.join(F.broadcast(start.withColumn("one", F.lit(1))), "one")
    moved = _pack(moving, order, F.any_value("start"))
    version = F.coalesce(F.max(slot_map.version) + 1, F.lit(1))
    return (
        stay.select("virtual_slot", "shard")
        .unionByName(moved)
        .withColumn("one", F.lit(1))
        .join(F.broadcast(slot_map.agg(version.alias("version")).withColumn("one", F.lit(1))), "one")
        .select("version", "virtual_slot", "shard")
    )


def assign(records: DataFrame, slot_map: DataFrame, loads: DataFrame, *tie: str) -> DataFrame:
    """Records with ``shard`` and ``slot``, their place in it, counted from 0 without gaps.

    A place is the slots before in the shard plus the rank in the slot, so no task sorts more than
    one slot. ``tie`` orders the records of a slot; equal rows take their places in any order.
    """
    before = F.sum("records").over(
        Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row per slot, which bounds what is broadcast.
    placed = loads.join(slot_map, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(before, F.lit(0)).cast("long").alias("before")
    )
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*tie))
    return (
        records.drop("shard", "before", "slot")
        .join(F.broadcast(placed), "virtual_slot")
        .withColumn("slot", F.col("before") + rank - 1)
        .drop("before")
    )


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> DataFrame:
    """Documents in shards of near-equal bytes.

    Output: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, rebalanced_shard.
    The text is read once and never shuffled. Version 0 of the map is stored in the shared folder, and
    so is version 1, its edit for one shard more, which gives ``rebalanced_shard``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    records = settled(
        docs.select(
            "doc_id",
            record_size().alias("size"),
            F.crc32(text).alias("text_crc32"),
            virtual_slot("doc_id", "text", n_slots).alias("virtual_slot"),
        ),
        "shard-records",
    )
    loads = settled(slot_loads(records), "slot-loads")
    slot_map = settled(first_map(loads, n_shards), "slot-map-v0")
    grown_map = settled(rebalance(slot_map, loads, n_shards + 1), "slot-map-v1")
    to = grown_map.select("virtual_slot", F.col("shard").alias("rebalanced_shard"))
    placed = assign(records, slot_map, loads, "doc_id", "text_crc32", "size")
    # At most one row per slot.
    return placed.join(F.broadcast(to), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "rebalanced_shard",
    )


def sharded_documents(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> DataFrame:
    """The documents whole, with the columns of :func:`shard_documents`, which replace their own.

    Loads come from a narrow pass. Then every document goes once to its virtual slot's task, as it must
    to be written by shard; no task sorts more than one slot at a time.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    added = {
        "size": record_size(),
        "text_crc32": F.crc32(text),
        "virtual_slot": virtual_slot("doc_id", "text", n_slots),
    }
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "rebalanced_shard"]
    own = [c for c in docs.columns if c.lower() not in {"doc_id", *new}]
    records = docs.select("doc_id", *own).withColumns(added)
    loads = settled(slot_loads(records.select("virtual_slot", "size")), "slot-loads")
    slot_map = settled(first_map(loads, n_shards), "slot-map-v0")
    grown_map = settled(rebalance(slot_map, loads, n_shards + 1), "slot-map-v1")
    to = grown_map.select("virtual_slot", F.col("shard").alias("rebalanced_shard"))
    clash = {"before"} & {c.lower() for c in own}
    renamed = records.withColumnsRenamed({c: f"_own_{c}" for c in own if c.lower() in clash})
    placed = assign(renamed, slot_map, loads, "doc_id", "text_crc32", "size")
    placed = placed.withColumnsRenamed({f"_own_{c}": c for c in own if c.lower() in clash})
    constants = {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    # At most one row per slot.
    return placed.join(F.broadcast(to), "virtual_slot").withColumns(constants).select("doc_id", *new, *own)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39, bytes near equal, and where they go with a 41st shard."""
    return shard_documents(table(spark, sf_dir, "documents"))
