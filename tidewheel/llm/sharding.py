"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots (thousands). The bytes of each slot are summed, and a map from slot to
shard, kept as a versioned table, says where a slot lives. Rebalancing edits the newest version: it moves or swaps a few
slots between the fullest and the emptiest shard and stores the result as the next one; slots that are not edited stay,
and no version is ever written over. A shard that is new starts empty and is filled by such moves; slots of a shard that
is gone are dealt to the others.
The map has as many rows as there are slots, whatever the data, so editing it on the driver is bounded.

The slot comes from a hash of doc_id and text, so rows with a null or repeated doc_id still spread. Rows equal in both
share a slot. A doc_id is a whole number, or text of one. Nulls: a null text has 0 bytes. An empty table gives no rows and an even map.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import shared_dir

SLOTS, ROW_BYTES = 4096, 16
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, rows long"


def record_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def virtual_slot(slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text")), F.lit(slots)).cast("int")


def slot_sizes(docs: DataFrame, slots: int = SLOTS) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of the slots that have rows; at most ``slots`` of them."""
    sized = docs.select(virtual_slot(slots).alias("v"), record_size().alias("size"))
    return [tuple(r) for r in sized.groupBy("v").agg(F.sum("size"), F.count("*")).collect()]


def first_map(slots: int, shards: int) -> list[int]:
    """Version 1, before anything is known of the sizes: slots dealt round."""
    return [s % shards for s in range(slots)]


def rebalance(placed: list[int], sizes: dict[int, int], shards: int, edits: int = 20_000) -> list[int]:
    """Edit a slot-to-shard map until no move or swap between the fullest and the emptiest shard narrows their gap.

    Each edit takes the slot (or pair of slots) whose difference is nearest to half the gap. Ties go to the smaller
    slot, so the same sizes give the same map.
    """
    import bisect

    placed = list(placed)
    total = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(placed):
        total[shard] += sizes.get(slot, 0)
        bisect.insort(held[shard], (sizes.get(slot, 0), slot))
    for _ in range(edits):
        full, empty = max(range(shards), key=lambda s: (total[s], -s)), min(range(shards), key=lambda s: (total[s], s))
        gap = total[full] - total[empty]
        if gap <= 1:
            break
        best = None
        for size, slot in held[full]:
            for other in [None, *_near(held[empty], size - gap / 2)]:
                moved = size - (other[0] if other else 0)
                if 0 < moved < gap and (best is None or abs(2 * moved - gap) < best[0]):
                    best = (abs(2 * moved - gap), (size, slot), other)
        if best is None:
            break
        _, one, other = best
        held[full].remove(one)
        bisect.insort(held[empty], one)
        placed[one[1]] = empty
        if other:
            held[empty].remove(other)
            bisect.insort(held[full], other)
            placed[other[1]] = full
        moved = one[0] - (other[0] if other else 0)
        total[full] -= moved
        total[empty] += moved
    return placed


def _near(held: list[tuple[int, int]], size: float) -> list[tuple[int, int]]:
    import bisect

    k = bisect.bisect_left(held, (size, -1))
    return held[max(0, k - 1) : k + 1]


def store_map(spark: SparkSession, path: str, version: int, placed: list[int], sizes: list[tuple[int, int, int]]) -> DataFrame:
    """Write one version of the map beside the earlier ones; returns it with each slot's first position in its shard."""
    known = {s: (b, r) for s, b, r in sizes}
    rows = [(version, s, shard, *known.get(s, (0, 0))) for s, shard in enumerate(placed)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("error").parquet(f"{path}/version={version}")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    stored = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={version}")
    return stored.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def newest_version(spark: SparkSession, path: str) -> int:
    """The newest version of the map at a path; 0 if there is none."""
    try:
        found = spark.read.parquet(path).agg(F.max(F.col("version").cast("int"))).first()[0]
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0
    return found or 0


def read_map(spark: SparkSession, path: str, version: int) -> list[int]:
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/version={version}").select("vslot", "shard").collect()
    return [shard for _, shard in sorted(map(tuple, rows))]


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """All columns of docs with ``virtual_slot``, ``shard``, ``slot`` (place in the shard, gapless from 0), ``size`` and ``text_crc32``.

    Without a map at ``map_path``, version 1 deals slots round. The newest version is then edited for the bytes found and
    stored, with the bytes and rows of now, as the next. Columns of these names in docs are replaced.
    """
    import uuid

    spark = docs.sparkSession
    path = map_path or f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    sizes = slot_sizes(docs, slots)
    version = newest_version(spark, path)
    if not version:
        version = 1
        store_map(spark, path, version, first_map(slots, shards), sizes)
    before = read_map(spark, path, version)
    if len(before) != slots:
        raise ValueError(f"the map at {path} has {len(before)} slots, not {slots}")
    placed = rebalance([s if s < shards else k % shards for k, s in enumerate(before)], {s: b for s, b, _ in sizes}, shards)
    stored = store_map(spark, path, version + 1, placed, sizes).select(F.col("vslot").alias("__vslot"), F.col("shard").alias("__shard"), F.col("start").alias("__start"))
    own = ("virtual_slot", "shard", "slot", "size", "text_crc32")
    rows = docs.drop(*own).withColumns({"virtual_slot": virtual_slot(slots), "size": record_size(), "text_crc32": F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))})
    place = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    placed_rows = rows.withColumn("__at", F.row_number().over(place) - 1)
    # The map has one row per slot, at most `slots`, whatever the data: a broadcast of proven size.
    joined = placed_rows.join(F.broadcast(stored), F.col("virtual_slot") == F.col("__vslot"))
    return joined.withColumn("shard", F.col("__shard")).withColumn("slot", (F.col("__start") + F.col("__at")).cast("long")).drop("__vslot", "__shard", "__start", "__at")
