"""Shards by virtual slots: records hash into slots, and a versioned map says which shard holds a slot."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsframe.workspace import materialize

SLOTS = 4096
OVERHEAD = 16


def virtual_slot(columns: list[str], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map (version, virtual_slot, shard): slots are dealt in turn."""
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        (F.col("id") % shards).cast("int").alias("shard"),
    )


def slot_sizes(records: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows); combined before the shuffle, at most one row per slot comes out."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def edit_map(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of the map, for ``shards`` shards of near equal bytes.

    A shard keeps its largest slots up to the mean; only what it holds beyond that moves, the largest slot first,
    each to the shard that then holds least. Shards the map did not have start empty, so the same edit grows it.
    All of this works on one row per slot, whatever the data.
    """
    # Empty slots stay where they are, if that shard still exists.
    slots = current.join(F.broadcast(sizes), "virtual_slot", "left").select(
        "version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes")
    )
    mean = slots.agg(F.sum("bytes") / shards).scalar()
    largest_first = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    held = slots.withColumn("running", F.sum("bytes").over(largest_first)).withColumn("mean", mean)
    stays = (F.col("running") <= F.col("mean")) & (F.col("shard") < shards)
    one = held.agg(
        F.max("version").alias("version"),
        F.collect_list(F.when(stays, F.struct("virtual_slot", "shard", "bytes"))).alias("kept"),
        F.sort_array(
            F.collect_list(F.when(~stays, F.struct((-F.col("bytes")).alias("minus"), "virtual_slot")))
        ).alias("moving"),
    )
    load = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate(
            F.filter("kept", lambda k: k["shard"] == s), F.lit(0).cast("bigint"), lambda total, k: total + k["bytes"]
        ),
    )

    def place(state: Column, slot: Column) -> Column:
        least = (F.array_position(state["load"], F.array_min(state["load"])) - 1).cast("int")
        return F.struct(
            F.transform(state["load"], lambda v, at: F.when(at == least, v - slot["minus"]).otherwise(v)).alias("load"),
            F.concat(state["moved"], F.array(F.struct(slot["virtual_slot"].alias("virtual_slot"), least.alias("shard")))).alias("moved"),
        )

    nothing = F.array().cast("array<struct<virtual_slot:int,shard:int>>")
    moved = F.aggregate("moving", F.struct(load.alias("load"), nothing.alias("moved")), place)["moved"]
    kept = F.transform("kept", lambda k: F.struct(k["virtual_slot"].alias("virtual_slot"), k["shard"].alias("shard")))
    return one.select((F.col("version") + 1).alias("version"), F.inline(F.concat(kept, moved)))


def shard_by_bytes(docs: DataFrame, shards: int, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(placed, maps): every row in one of ``shards`` shards of near equal bytes, and all versions of the map.

    ``placed`` has ``key``, ``size`` (UTF-8 bytes of the text plus 16), ``text_crc32``, ``virtual_slot``, ``shard``
    and ``slot``, the row's place in its shard, gapless from 0. A NULL text has no bytes and checksum 0; rows with
    a NULL key hash by size and checksum; whole repeats of a row share a virtual slot and get places of their own.
    Other columns of ``docs`` are not looked at. Shards differ by less than their smallest moved slot, or as far
    as single records force them to.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    records = docs.select(
        F.col(key).alias("key"), (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    ).withColumn("virtual_slot", virtual_slot(["key", "size", "text_crc32"], slots))
    records = materialize(records, "shard-records")
    sizes = materialize(slot_sizes(records), "slot-sizes")
    first = first_map(spark, shards, slots)
    maps = materialize(first.unionByName(edit_map(first, sizes, shards)), "slot-maps")
    latest = maps.where(F.col("version") == 2).join(F.broadcast(sizes), "virtual_slot", "left")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = latest.select("virtual_slot", "shard", F.coalesce(F.sum(F.coalesce("rows", F.lit(0))).over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("virtual_slot").orderBy("key", "size", "text_crc32")
    placed = records.withColumn("nth", F.row_number().over(within)).join(F.broadcast(starts), "virtual_slot").select(
        F.col("key").alias(key), "size", "text_crc32", "virtual_slot", "shard",
        (F.col("start") + F.col("nth") - 1).cast("bigint").alias("slot"),
    )
    return placed, maps
