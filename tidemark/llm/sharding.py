"""Fixed virtual slots: records are hashed into thousands of slots, bytes are summed per slot, and a
versioned map says which shard holds each slot. Rebalancing and growing edit the map; records keep
their slot for ever. DataFrame functions only.

The map is one row per slot, `SLOTS` in all, whatever the data: that bounds every broadcast here. Its versions
are small Parquet folders below a folder of the data set, so that the next run edits what this one left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table
from tidemark.session import work_dir
from tidemark.state.files import SharedFiles

SLOTS = 4096
SHARDS = 16
#: parts of a slot, so that positions inside a shard are counted in small groups
PARTS = 16
#: a map is edited once a shard holds so much more than the mean
TOLERANCE = 0.01


def with_slots(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, vslot, part) of every row; no text leaves the scan.

    The slot follows from key and text, so rows without a key still spread. A null text is empty, has
    crc32 0 and size 1. Repeated rows share a slot.
    """
    h = F.xxhash64(F.col(key), F.col(text))
    size = F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long")) + 1
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return docs.select(
        F.col(key), size.alias("size"), crc.alias("text_crc32"),
        F.pmod(h, F.lit(slots)).cast("int").alias("vslot"),
        F.pmod(F.shiftrightunsigned(h, 40), F.lit(PARTS)).cast("int").alias("part"),
    )


def slot_bytes(placed: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes) of all slots, empty ones included."""
    sums = placed.groupBy("vslot").agg(F.sum("size").alias("bytes"))  # of rows or of counts
    every = placed.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(sums, "vslot", "left").select("vslot", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt in turn. Columns version, vslot, shard."""
    return spark.range(slots).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("vslot"), (F.col("id") % shards).cast("int").alias("shard"))


def _assign(pool: Column, loads: Column) -> Column:
    """Give each (bytes, vslot) of an array, in its order, to the shard with the least bytes so far."""
    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("to"))

    def step(state: Column, item: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        grown = F.transform(state["loads"], lambda x, i: F.when(i == least, x + item["bytes"]).otherwise(x))
        return F.struct(grown.alias("loads"), F.concat(state["to"], F.array(least)).alias("to"))

    return F.aggregate(pool, start, step, lambda state: state["to"])


def rebalance(shard_map: DataFrame, sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of a map: each shard keeps its largest slots up to the mean load, the rest of
    the slots go, largest first, to the least loaded shard. Also grows a map to more shards, which
    start empty. Shards differ by at most the largest slot that moved; empty slots stay."""
    slots = shard_map.join(sizes, "vslot")
    running = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot"))
    total = F.sum("bytes").over(Window.partitionBy())
    kept = slots.withColumn("keep", (F.col("bytes") == 0) | (running * shards <= total))
    load = [F.coalesce(F.sum(F.when(F.col("keep") & (F.col("shard") == s), F.col("bytes"))), F.lit(0).cast("long")) for s in range(shards)]
    pool = F.sort_array(F.collect_list(F.when(~F.col("keep"), F.struct("bytes", "vslot"))), asc=False)
    one = kept.agg(F.array(*load).alias("loads"), pool.alias("pool"))
    moved = one.select(F.explode(F.arrays_zip("pool", _assign(F.col("pool"), F.col("loads")).alias("to"))).alias("m")).select(
        F.col("m.pool.vslot").alias("vslot"), F.col("m.to").alias("moved_to"))
    return kept.join(moved, "vslot", "left").select(
        (F.col("version") + 1).alias("version"), "vslot", F.coalesce("moved_to", "shard").cast("int").alias("shard"))


def _versions(spark: SparkSession, folder: str) -> list[int]:
    files = SharedFiles(spark, folder)
    return sorted(int(n[2:]) for n in files.names(folder) if n.startswith("v=") and files.exists(f"{folder}/{n}/_SUCCESS"))


def stored_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame | None:
    """A version of the map below a folder, by default the newest; None if there is none."""
    known = _versions(spark, folder)
    if not known:
        return None
    return spark.read.parquet(f"{folder}/v={known[-1] if version is None else version}")


def _store(shard_map: DataFrame, folder: str, version: int) -> DataFrame:
    shard_map.coalesce(1).write.mode("overwrite").parquet(f"{folder}/v={version}")
    return shard_map.sparkSession.read.parquet(f"{folder}/v={version}")


def edited_map(spark: SparkSession, sizes: DataFrame, folder: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The newest map of a folder, after a version more if it does not fit: for other shards, or for a load of
    more than TOLERANCE above the mean. A folder without a map gets version 0, slots dealt in turn. Versions
    are never rewritten once complete; one writer at a time."""
    held = stored_map(spark, folder)
    if held is None:
        held = _store(first_map(spark, shards, slots), folder, 0)
    loads = held.join(sizes, "vslot").groupBy("shard").agg(F.sum("bytes").alias("load"))
    known = held.agg(F.max("version").alias("version"), F.max("shard").alias("last")).first()
    heaviest, total = loads.agg(F.max("load"), F.sum("load")).first()
    if known["last"] == shards - 1 and (not total or heaviest * shards <= total * (1 + TOLERANCE)):
        return held
    return _store(rebalance(held, sizes, shards), folder, known["version"] + 1)


def _spread(placed: DataFrame, counts: DataFrame, shards: int, slots: int) -> tuple[DataFrame, DataFrame]:
    """Rows and counts with the rows of overfull slots dealt to all slots by their place in the table. A slot is
    overfull with more than a quarter of a shard's share, so there are few: equal rows, which share a
    slot, are a large part of the table then."""
    sizes = counts.groupBy("vslot").agg(F.sum("size").alias("bytes"))
    total = counts.agg(F.sum("size")).first()[0] or 0
    overfull = [r["vslot"] for r in sizes.where(F.col("bytes") * 4 * shards > total).collect()]  # fewer than 4 * shards
    if not overfull or total < slots:
        return placed, counts
    row = F.xxhash64(F.monotonically_increasing_id())
    moved = F.col("vslot").isin(overfull)
    placed = materialise(placed.withColumns({
        "vslot": F.when(moved, F.pmod(row, F.lit(slots))).otherwise(F.col("vslot")).cast("int"),
        "part": F.when(moved, F.pmod(F.shiftrightunsigned(row, 40), F.lit(PARTS))).otherwise(F.col("part")).cast("int")}))
    return placed, materialise(slot_counts(placed))


def slot_counts(placed: DataFrame) -> DataFrame:
    return placed.groupBy("vslot", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Every row with its shard and its gapless position inside the shard, by the newest map.

    The map is kept below `folder`, where a later run finds and edits it (without one, in a folder of its own).
    The law is bytes: shards hold nearly equal sizes. Positions follow (vslot, part, key, crc32,
    size); repeated rows take neighbouring positions, unless they are so many that they are spread over all
    slots. An empty input gives no rows. Only the key and the text are read: other columns, whatever
    their names, do not matter.
    """
    spark = docs.sparkSession
    placed = with_slots(docs, slots, key, text)
    placed, counts = _spread(placed, materialise(slot_counts(placed)), shards, slots)
    newest = edited_map(spark, materialise(slot_bytes(counts, slots)), folder or work_dir(spark, "shard-map"), shards, slots).select("vslot", "shard")
    # SLOTS * PARTS rows at most
    ahead = counts.join(F.broadcast(newest), "vslot").withColumn(
        "base", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    order = Window.partitionBy("vslot", "part").orderBy(F.col(key), "text_crc32", F.col("size"))
    ranked = placed.withColumn("rn", F.row_number().over(order))
    return ranked.join(F.broadcast(ahead.select("vslot", "part", "shard", "base")), ["vslot", "part"]).select(
        F.col(key), F.col("size"), "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("rn") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))
