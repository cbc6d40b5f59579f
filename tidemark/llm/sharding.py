"""Sharding by fixed virtual slots: records hash to slots, a versioned map sends slots to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import new_path, stage_table
from tidemark.sources import table_set

#: Virtual slots; fixed for the life of a data set.
SLOTS = 4096
#: Different rows of a slot that are ranked together; a slot has as many parts as its number of them asks for.
ROWS_PER_PART = 50_000
#: Equal rows that are numbered together.
COPIES_AT_ONCE = 10_000
_MAP = "slot_map"
_MAP_SCHEMA = "version int, virtual_slot int, shard int, slot_bytes long"


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key; a null key has a slot like any other value."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null, and 8 for the id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map: (version, virtual_slot, shard, slot_bytes), slots dealt to shards in turn."""
    return sizes.select(
        F.lit(1).alias("version"), "virtual_slot", (F.col("virtual_slot") % shards).alias("shard"), "slot_bytes"
    )


def grow_map(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version of a map of `shards` shards, edited for one shard more.

    Every old shard gives up its last slots, the same number or one less, and they all go to the new shard; no slot
    moves between old shards. The edit depends on the map's slots and the number of shards only.
    """
    in_shard = Window.partitionBy("shard").orderBy(F.desc("virtual_slot"))
    by_turn = Window.orderBy("turn", "shard")
    wanted = SLOTS // (shards + 1)
    ranked = slot_map.withColumn("turn", F.row_number().over(in_shard))
    # the window without keys sees at most SLOTS rows, which is a fixed number
    edited = ranked.withColumn("taken", F.row_number().over(by_turn) <= wanted)
    return edited.select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.when(F.col("taken"), F.lit(shards)).otherwise(F.col("shard")).alias("shard"),
        "slot_bytes",
    )


def slot_sizes(rows: DataFrame) -> DataFrame:
    """(virtual_slot, slot_bytes) for all slots, of rows (virtual_slot, size, copies); a slot without rows has 0 bytes."""
    counted = rows.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies")).alias("slot_bytes"))
    all_slots = rows.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("virtual_slot"))
    return all_slots.join(counted, "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("slot_bytes", F.lit(0)).alias("slot_bytes")
    )


def rebalance(slot_map: DataFrame, moves: DataFrame) -> DataFrame:
    """The next version of a map after an edit: `moves` (virtual_slot, to_shard) override the slots they name."""
    return slot_map.join(moves.groupBy("virtual_slot").agg(F.min("to_shard").alias("to_shard")), "virtual_slot", "left").select(
        (F.col("version") + 1).alias("version"),
        "virtual_slot",
        F.coalesce("to_shard", "shard").alias("shard"),
        "slot_bytes",
    )


def shard_loads(slot_map: DataFrame) -> DataFrame:
    """(version, shard, slots, bytes), to decide which slots to move."""
    return slot_map.groupBy("version", "shard").agg(
        F.count(F.lit(1)).alias("slots"), F.sum("slot_bytes").alias("bytes")
    )


def save_map(slot_map: DataFrame, folder: str) -> int:
    """Store the next version of a data set's map; the version's number.

    The folder keeps every version. The map must carry the number after the newest stored one: of two writers who edit
    the same version one wins, and the other gets an error (ValueError, or `SetConflict` if both write at once).
    """
    spark = slot_map.sparkSession
    newest = table_set.read_set(spark, folder)
    found = [r["version"] for r in slot_map.select("version").distinct().limit(2).collect()]
    if found != [newest.number + 1]:
        raise ValueError(f"the map has versions {found}, and {newest.number} is the newest one stored")
    return table_set.replace_tables(spark, folder, {_MAP: slot_map}, newest).number


def open_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A stored version of a data set's map, by default the newest one."""
    return table_set.read_tables(
        spark, folder, {_MAP: _MAP_SCHEMA}, table_set.read_set(spark, folder, version)
    )[_MAP]


def map_versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the stored versions, ascending."""
    return table_set.set_numbers(spark, folder)


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(virtual_slot, doc_id, size, text_crc32, copies): the different rows, and how often each is there.

    Copies are counted before the shuffle, so a row that is there very often is one row of each task.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        size_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return rows.groupBy(virtual_slot(F.col("doc_id")).alias("virtual_slot"), "doc_id", "size", "text_crc32").agg(
        F.count(F.lit(1)).alias("copies")
    )


def place_rows(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Add `first`, the place of the first copy in its shard, to rows of `sized_rows`, and the columns of `slots`.

    `slots` has (virtual_slot, shard, ...), one row per slot. Places go by virtual slot, part and id, from 0 without
    gaps. They are counted inside parts of about ROWS_PER_PART different rows and shifted by the counts before.
    """
    # one row per slot, which is a fixed number
    parts = rows.groupBy("virtual_slot").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_PART).alias("parts"))
    dealt = rows.join(F.broadcast(parts), "virtual_slot").withColumn(
        "part", F.pmod(F.xxhash64("text_crc32", "size", "doc_id"), F.col("parts"))
    )
    before = (
        dealt.groupBy("virtual_slot", "part")
        .agg(F.sum("copies").alias("n"))
        .join(F.broadcast(slots), "virtual_slot")
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("virtual_slot", "part")) - F.col("n"))
        .drop("n")
    )
    inside = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "size", "text_crc32")
    placed = dealt.withColumn("upto", F.sum("copies").over(inside)).join(before, ["virtual_slot", "part"])
    return placed.withColumn("first", F.col("before") + F.col("upto") - F.col("copies")).drop("before", "upto", "part", "parts")


def each_copy(placed: DataFrame) -> DataFrame:
    """One row per copy, with `slot`, its place: `first` and the numbers after it.

    Rows with many copies are cut into runs of COPIES_AT_ONCE that are spread over tasks before they are numbered.
    """
    few = placed.where(F.col("copies") <= COPIES_AT_ONCE)
    last = F.floor((F.col("copies") - 1) / COPIES_AT_ONCE)
    many = (
        placed.where(F.col("copies") > COPIES_AT_ONCE)
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("end", F.col("first") + F.col("copies"))
        .withColumn("first", F.col("first") + F.col("run") * COPIES_AT_ONCE)
        .withColumn("copies", F.least(F.lit(COPIES_AT_ONCE).cast("long"), F.col("end") - F.col("first")))
        .repartition("shard", "first")
        .drop("run", "end")
    )
    runs = few.unionByName(many)
    return runs.withColumn("slot", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1))).drop("first", "copies")


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", map_folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, map): each row's shard under `shards` and under one shard more, and both versions of the slot map.

    The law is `key`: the id and the number of shards decide. Both versions are stored in `map_folder`, which must hold
    no map yet (by default a new folder of this application), and opened from there by their numbers. `slot` is the
    row's place in its shard, from 0 without gaps. Equal rows are counted before the shuffle and numbered at the end; no
    shard is sorted as a whole, and the text itself is never shuffled.

    A null text has no bytes and the checksum of an empty one; null ids share a slot; repeated rows share a shard and
    get places of their own; extra columns are ignored; an empty table gives an empty result and maps of empty slots.
    """
    spark = docs.sparkSession
    folder = map_folder or new_path(spark, "slot-map")
    rows = stage_table(sized_rows(docs, id_col, text_col), "slots")
    save_map(first_map(slot_sizes(rows), shards), folder)
    save_map(grow_map(open_map(spark, folder, 1), shards), folder)
    now, grown = open_map(spark, folder, 1), open_map(spark, folder, 2)
    slots = now.select("virtual_slot", "shard", "slot_bytes").join(
        grown.select("virtual_slot", F.col("shard").alias("grown_shard")), "virtual_slot"
    )
    placed = stage_table(place_rows(rows, slots), "places")
    out = each_copy(placed).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "virtual_slot", "slot_bytes"
    )
    return out, now.unionByName(grown)
