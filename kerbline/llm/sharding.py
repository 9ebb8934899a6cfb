"""Shards by fixed virtual slots and a versioned map from slots to shards.

A record's slot follows from its id alone and never changes.  Which shard owns a slot is written in
a small table, the map, of which every edit is a new version:

* the first version of a map deals the slots evenly to the shards and depends on nothing but
  their number, so an id and a number of shards decide the shard;
* ``grown`` adds a shard by moving slots from every old shard to the new one only;
* ``rebalanced`` moves slots from shards that hold too many bytes to those that hold too few,
  by the bytes counted for each slot.

All of it is DataFrame operations; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.shared import shared_path, table

SLOTS = 8192
SHARDS = 24
#: Bytes that a record takes beside its text.
OVERHEAD = 8
#: Equal rows that are written out from one row, at most.
STRETCH = 100_000


def slot_of(record_id: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of an id, from its decimal digits; a null id counts as empty text."""
    text = F.coalesce(record_id.cast("string"), F.lit(""))
    return F.pmod(F.xxhash64(text), F.lit(slots)).cast("int")


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) and the overhead of a record."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + OVERHEAD).cast("long")


def slot_bytes(records: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``vslot, many, bytes`` of the slots that have records."""
    sized = records.select(slot_of(F.col(id_col)).alias("vslot"), size_of(F.col(text_col)).alias("size"))
    return sized.groupBy("vslot").agg(F.count("*").alias("many"), F.sum("size").alias("bytes"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 1 of a map, ``vslot, shard, version``: slots dealt to the shards in turn, in an
    order mixed by their hashes."""
    order = Window.orderBy(F.xxhash64("vslot"), "vslot")
    numbered = spark.range(slots).select(F.col("id").cast("int").alias("vslot"))
    turn = F.row_number().over(order) - 1  # at most ``slots`` rows, whatever the data
    return numbered.select(
        "vslot", (turn % shards).cast("int").alias("shard"), F.lit(1).alias("version")
    )


def grown(slot_map: DataFrame, shards: int) -> DataFrame:
    """The map's next version with one more shard, ``shards``, that takes an even share of the
    slots, in equal parts from all others.  No slot moves between old shards."""
    within = Window.partitionBy("shard").orderBy(F.xxhash64("vslot", F.lit("grow")), "vslot")
    ranked = slot_map.withColumn("turn", F.row_number().over(within))
    # The first slots of every shard move; all shards' first slots before any shard's second.
    moving = Window.orderBy("turn", "shard")
    total = F.count("*").over(Window.partitionBy())
    ranked = ranked.withColumn("place", F.row_number().over(moving)).withColumn("total", total)
    moves = F.col("place") <= F.floor(F.col("total") / (shards + 1))
    return ranked.select(
        "vslot",
        F.when(moves, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"),
        (F.col("version") + 1).alias("version"),
    )


def rebalanced(slot_map: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The map's next version with slots moved from shards of more bytes than the mean to those
    of fewer.

    A shard gives up its smallest slots, as many as its surplus holds; these go, the largest
    first, to the shard that is the emptiest by then.  ``weights`` is the result of
    ``slot_bytes``; a slot without records weighs nothing.
    """
    weighed = slot_map.join(weights.select("vslot", "bytes"), "vslot", "left")
    weighed = weighed.withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    mean = F.sum("bytes").over(Window.partitionBy()) / shards
    load = F.sum("bytes").over(Window.partitionBy("shard"))
    given = F.sum("bytes").over(
        Window.partitionBy("shard").orderBy("bytes", "vslot").rowsBetween(Window.unboundedPreceding, 0)
    )
    weighed = weighed.withColumns({"mean": mean, "load": load, "given": given})
    moves = (F.col("bytes") > 0) & (F.col("given") <= F.col("load") - F.col("mean"))
    weighed = weighed.withColumn("moves", moves)
    kept = weighed.where("not moves").groupBy("shard").agg(F.sum("bytes").alias("load"))
    loads = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = loads.join(kept, "shard", "left").select("shard", F.coalesce("load", F.lit(0)).alias("load"))
    # One row: the loads by shard, and the moving slots by falling size.  Both are bounded by the map.
    moving = weighed.where("moves").select(
        F.struct(F.col("bytes").cast("long").alias("bytes"), "vslot").alias("slot"),
        F.lit(None).cast("struct<shard:int,load:bigint>").alias("load"),
    )
    loads = loads.select(
        F.lit(None).cast("struct<bytes:bigint,vslot:int>").alias("slot"),
        F.struct("shard", F.col("load").cast("long").alias("load")).alias("load"),
    )
    state = moving.unionAll(loads).agg(
        F.array_sort(F.collect_list("load")).alias("loads"),
        F.sort_array(F.collect_list("slot"), asc=False).alias("moving"),
    )
    dealt = state.select(
        F.aggregate(
            "moving",
            F.struct(
                F.transform("loads", lambda s: s["load"].cast("long")).alias("loads"),
                F.expr("cast(array() as array<struct<vslot:int,shard:int>>)").alias("moved"),
            ),
            lambda so_far, slot: F.struct(
                F.transform(
                    so_far["loads"],
                    lambda load, i: F.when(
                        i + 1 == F.array_position(so_far["loads"], F.array_min(so_far["loads"])),
                        load + slot["bytes"],
                    ).otherwise(load),
                ).alias("loads"),
                F.concat(
                    so_far["moved"],
                    F.array(
                        F.struct(
                            slot["vslot"].alias("vslot"),
                            (
                                F.array_position(so_far["loads"], F.array_min(so_far["loads"])) - 1
                            ).cast("int").alias("shard"),
                        )
                    ),
                ).alias("moved"),
            ),
        ).alias("end")
    )
    moved = dealt.select(F.explode("end.moved").alias("m")).select("m.vslot", F.col("m.shard").alias("to"))
    return slot_map.join(moved, "vslot", "left").select(
        "vslot", F.coalesce("to", "shard").alias("shard"), (F.col("version") + 1).alias("version")
    )


def write_map(slot_map: DataFrame, path: str) -> None:
    """Adds a version to the map stored at ``path``; older versions stay readable."""
    slot_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map stored at ``path``, by default the latest."""
    every = spark.read.schema("vslot int, shard int, version int").parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def assign(
    records: DataFrame,
    slot_map: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, size, text_crc32, vslot, shard, slot`` for every record: ``slot`` numbers the records
    of a shard from 0 without gaps, by virtual slot, id, size and checksum.

    A null text has 8 bytes and the checksum of no bytes; a null id has a slot like any other.
    Records are numbered within their virtual slot and the counts of a shard's earlier slots
    are added, so no shard passes through one task.  Equal rows are counted before
    the shuffle and numbered as one, so that a repeated id does not grow its task either.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = records.select(
        F.col(id_col).alias("id"),
        size_of(F.col(text_col)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        slot_of(F.col(id_col)).alias("vslot"),
    )
    rows = rows.groupBy("vslot", "id", "size", "text_crc32").agg(F.count("*").alias("many"))
    before = Window.partitionBy("vslot").orderBy("id", "size", "text_crc32")
    rows = rows.withColumn(
        "inside", F.sum("many").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("many")
    )
    counts = slot_bytes(records, id_col, text_col).select("vslot", F.col("many").alias("in_slot"))
    ahead = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(counts, "vslot").select(
        "vslot", "shard", F.coalesce(F.sum("in_slot").over(ahead), F.lit(0)).alias("start")
    )
    placed = rows.join(F.broadcast(starts), "vslot")  # a row for each slot of the map at most
    first = F.col("start") + F.col("inside")
    record = ["id", "size", "text_crc32", "vslot", "shard"]
    # Equal rows are written out in stretches, so that no row holds the numbers of very many.
    placed = placed.select(
        *record,
        (first + F.col("many") - 1).alias("last"),
        F.explode(F.sequence(first, first + F.col("many") - 1, F.lit(STRETCH).cast("long"))).alias("begin"),
    )
    end = F.least("last", F.col("begin") + (STRETCH - 1))
    return placed.select(*record, F.explode(F.sequence("begin", end)).alias("slot"))


def op5_virtual_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 24 shards by key: an id and the number of shards decide."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_path(spark, "slot-map")
    write_map(first_map(spark), path)
    now = read_map(spark, path, 1)
    write_map(grown(now, SHARDS), path)
    later = read_map(spark, path, 2).select("vslot", F.col("shard").alias("grown_shard"))
    placed = assign(docs, now)
    return placed.join(F.broadcast(later), "vslot").select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
        F.col("vslot").alias("virtual_slot"),
    )
