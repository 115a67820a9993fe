"""Sharding by virtual slots: rows hash into a fixed number of slots, and a stored map sends slots to shards.

Only the map knows the number of shards. It is made from the bytes each slot holds, so that shards are of
near equal size, and it is edited, as a new version, when shards are added: slots then move into the new
shard only and no row is hashed again. The map has one row per slot, whatever the corpus holds.
"""

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.staging import stage, stage_path

SLOTS = 4096
ROW_OVERHEAD = 16
MAP = T.StructType([
    T.StructField("map_version", T.IntegerType(), False),
    T.StructField("virtual_slot", T.IntegerType(), False),
    T.StructField("shard", T.IntegerType(), False),
])


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of each row; a null text counts as empty.

    The slot hashes the id and the text, so rows without an id, and repeats of an id with other texts, spread.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    plain = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    return plain.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(bytes, rows) of every slot, on the driver: one pair per slot."""
    sizes = [(0, 0)] * slots
    held = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    for row in held.collect():
        sizes[row["virtual_slot"]] = (row["bytes"], row["n"])
    return sizes


def assign(sizes: list[int], shards: int) -> list[int]:
    """Shard of each slot: the largest slot not yet placed goes to the shard with the fewest bytes."""
    placed, heap = [0] * len(sizes), [(0, shard) for shard in range(shards)]
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        total, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (total + sizes[slot], shard))
    return placed


def grow(placed: list[int], sizes: list[int]) -> list[int]:
    """The map with one shard more: slots of the fullest shards move into it until it holds its share.

    No slot moves between the old shards. A slot moves only if its old shard then still holds at least the
    new share, or comes closer to it than before; so shards end near the new mean.
    """
    shards = max(placed, default=-1) + 2
    new, share = list(placed), sum(sizes) / shards
    held, of = [0] * shards, [[] for _ in range(shards)]
    for slot, shard in enumerate(placed):
        held[shard] += sizes[slot]
        of[shard].append(slot)
    fullest = [(-held[shard], shard) for shard in range(shards - 1)]
    heapq.heapify(fullest)
    while fullest and held[-1] < share:
        _, shard = heapq.heappop(fullest)
        over = min(held[shard] - share, share - held[-1])
        fitting = [s for s in of[shard] if 0 < sizes[s] < 2 * over]
        if not fitting:
            continue
        slot = max(fitting, key=lambda s: (min(sizes[s], 2 * over - sizes[s]), -s))
        of[shard].remove(slot)
        new[slot] = shards - 1
        held[shard] -= sizes[slot]
        held[-1] += sizes[slot]
        heapq.heappush(fullest, (-held[shard], shard))
    return new


def write_map(spark: SparkSession, path: str, placed: list[int], version: int) -> DataFrame:
    """Stores a map as one version beside the earlier ones, and reads it back."""
    rows = [(version, slot, shard) for slot, shard in enumerate(placed)]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("error").parquet(f"{path}/version={version}")
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP).parquet(f"{path}/version={version}")


def place(rows: DataFrame, slot_map: DataFrame, counts: list[tuple[int, int]]) -> DataFrame:
    """Adds shard and ``slot``, the row's place in its shard, gapless from 0.

    Rows are numbered inside their virtual slot (the finest even split there is; never inside a whole shard)
    and moved up by the rows of the shard's earlier slots. Map and counts have one row per slot: broadcast.
    """
    spark = rows.sparkSession
    held = spark.createDataFrame([(s, n) for s, (_, n) in enumerate(counts)], "virtual_slot int, n long")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(F.broadcast(held), "virtual_slot").withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_nth", F.row_number().over(inside))
        .join(F.broadcast(starts.drop("n")), "virtual_slot")
        .withColumn("slot", F.col("first") + F.col("_nth") - 1)
        .drop("_nth", "first")
    )


def shard(docs: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Places all rows of ``docs`` in ``shards`` shards of near equal bytes; the map is kept at ``map_path``."""
    spark = docs.sparkSession
    rows = stage(records(docs, slots=slots), "slots")
    counts = slot_sizes(rows, slots)
    path = map_path or stage_path(spark, "slot-map")
    return place(rows, write_map(spark, path, assign([b for b, _ in counts], shards), 1), counts)


def latest_version(spark: SparkSession, path: str) -> int:
    """The newest version of the map kept at ``path``."""
    return spark.read.schema(MAP).parquet(f"{path}/version=*").agg(F.max("map_version")).first()[0]


def rebalance(docs: DataFrame, map_path: str, shards: int) -> DataFrame:
    """Places all rows by the newest map edited for ``shards`` shards, which is written as the next version.

    The slots' bytes are measured on ``docs``. Shards are added one at a time, each taking whole slots from the fullest ones; rows
    of other slots stay in their shard. The map says how many slots there are. Fewer shards than it has are an
    error; as many leave it as it is, and the rows are placed by it. Of two edits at once the second fails, since its version is there.
    """
    spark = docs.sparkSession
    version = latest_version(spark, map_path)
    placed = [r["shard"] for r in read_map(spark, map_path, version).orderBy("virtual_slot").collect()]  # one per slot
    rows = stage(records(docs, slots=len(placed)), "slots")
    counts = slot_sizes(rows, len(placed))
    now = max(placed) + 1
    if shards < now:
        raise ValueError(f"the map has {now} shards, more than {shards}")
    for _ in range(shards - now):
        placed = grow(placed, [b for b, _ in counts])
    edited = write_map(spark, map_path, placed, version + 1) if shards > now else read_map(spark, map_path, version)
    return place(rows, edited, counts)
