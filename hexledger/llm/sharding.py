"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups (documents with equal texts) are sorted by size and enter the bin whose remaining capacity is the
tightest that still holds them, found in a balanced search tree. Packing all groups in one place would not
scale, so it goes in two levels. Tasks pack the many small groups into blocks of a fixed capacity; blocks and
the few groups larger than a block are then packed into the shards. The second level sees at most about
2 * shards * BLOCKS_PER_SHARD pieces, plus one part-filled block a task, whatever the number of groups.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexledger.llm.frames import bound_batches
from hexledger.session import materialize

SHARDS = 40
# Blocks of the first level that a shard would hold.
BLOCKS_PER_SHARD = 250
# Bytes that count for a row besides its text.
ROW_BYTES = 16
# Rows that one task numbers at a time within a shard, on average.
NUMBERED_ROWS = 100_000


class BestFit:
    """Bins in a balanced tree (a treap) ordered by (remaining capacity, bin)."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]
        self.dice = random.Random(0)

    def add(self, remaining: int, bin_: int) -> None:
        key = (remaining, bin_)
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, self.dice.random(), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest (remaining, bin) with remaining >= size."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        first, high = self._pop_first(high)
        self.root = self._merge(low, high)
        return first

    def take_emptiest(self) -> tuple[int, int]:
        node = self.root
        while node[3] is not None:
            node = node[3]
        key = node[0]
        self.root, _ = self._split(self.root, key)
        return key

    def _split(self, node: list | None, key: tuple) -> tuple[list | None, list | None]:
        """Nodes under `key`, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _merge(self, low: list | None, high: list | None) -> list | None:
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high

    def _pop_first(self, node: list) -> tuple[tuple, list | None]:
        if node[2] is None:
            return node[0], node[3]
        first, node[2] = self._pop_first(node[2])
        return first, node


def pack(sizes: Iterable[int], capacity: int) -> Iterator[int]:
    """Bins for sizes that come in decreasing order: the tightest bin that holds one, else a new bin.

    A size over the capacity gets a bin of its own.
    """
    bins, used = BestFit(), 0
    for size in sizes:
        found = bins.take(size)
        if found is None:
            found, used = (max(capacity, size), used), used + 1
        yield found[1]
        bins.add(found[0] - size, found[1])


def pack_into(sizes: Iterable[int], capacity: int, n_bins: int) -> Iterator[int]:
    """As `pack`, with a fixed number of bins: what fits nowhere enters the emptiest bin."""
    bins = BestFit()
    for k in range(n_bins):
        bins.add(capacity, k)
    for size in sizes:
        remaining, bin_ = bins.take(size) or bins.take_emptiest()
        yield bin_
        bins.add(remaining - size, bin_)


def sized(documents: DataFrame) -> DataFrame:
    """`documents` (doc_id, text) as doc_id, size, text_crc32 and the group of equal texts (null: empty)."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return documents.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("group"),
    )


def assign(rows: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """(group, shard) for rows with group and size: shards with sizes as near equal as whole groups allow.

    A group larger than an equal share makes its shard larger; the other shards stay near equal. Ties in size
    are broken by the group's name. An empty table has no groups.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    groups = materialize(rows.groupBy("group").agg(F.sum("size").alias("size")), "groups")
    total, n_groups = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    block = max(total // (shards * blocks_per_shard), 1)
    tasks = max(1, n_groups // 100_000 + 1)

    small = groups.where(F.col("size") < block)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []

        def in_order() -> Iterator[int]:
            for batch in batches:
                held.append(batch)
                yield from batch.column("size").to_pylist()

        bins: list[int] = []
        for bin_ in pack(in_order(), block):
            bins.append(bin_)
            if len(held) > 1:  # a batch is done
                yield _numbered(held.pop(0), bins, task)
        for batch in held:
            yield _numbered(batch, bins, task)

    packed = materialize(
        small.repartition(tasks, "group")
        .sortWithinPartitions(F.desc("size"), "group")
        .mapInArrow(blocks, "group string, size long, task int, block int"),
        "blocks",
    )
    pieces = (
        packed.groupBy("task", "block")
        .agg(F.sum("size").alias("size"))
        .select("size", "task", "block", F.lit(None).cast("string").alias("group"))
        .unionByName(
            groups.where(F.col("size") >= block).select(
                "size", F.lit(-1).alias("task"), F.lit(-1).alias("block"), "group"
            )
        )
    )
    # At most about 2 * shards * blocks_per_shard rows, and one more a task.
    ordered = sorted(
        pieces.collect(), key=lambda r: (-r["size"], r["task"], r["block"], r["group"] or "")
    )
    homes = pack_into([r["size"] for r in ordered], -(-total // shards), shards)
    schema = "task int, block int, group string, shard int"
    placed = spark.createDataFrame(
        [(r["task"], r["block"], r["group"], home) for r, home in zip(ordered, homes, strict=True)], schema
    )
    # `placed` has the bounded number of rows just collected.
    of_blocks = packed.join(
        F.broadcast(placed.where("group IS NULL").drop("group")), ["task", "block"]
    ).select("group", "shard")
    return of_blocks.unionByName(placed.where("group IS NOT NULL").select("group", "shard"))


def _numbered(batch: pa.RecordBatch, bins: list[int], task: int) -> pa.RecordBatch:
    own, bins[: batch.num_rows] = bins[: batch.num_rows], []
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array([task] * batch.num_rows, pa.int32()), pa.array(own, pa.int32())],
        names=["group", "size", "task", "block"],
    )


def slots(placed: DataFrame, order: str = "doc_id", numbered_rows: int = NUMBERED_ROWS) -> DataFrame:
    """`placed` (with shard) plus slot: 0, 1, 2, ... within each shard, without a shard in one task.

    Rows of a shard are dealt to lanes by a hash of `order`; each lane is numbered on its own from the number
    of rows in the lanes before. Rows that share a null or repeated `order` get different slots.
    """
    stored = materialize(placed, "placed")
    lanes = stored.count() // numbered_rows + 1
    # A salt by the row's other columns spreads rows that share an id.
    names = [c for c in stored.columns if c != "shard"]
    laned = stored.withColumn("lane", F.pmod(F.xxhash64(*names), F.lit(lanes)).cast("int"))
    counts = laned.groupBy("shard", "lane").agg(F.count("*").alias("rows"))
    before = F.coalesce(
        F.sum("rows").over(Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = counts.select("shard", "lane", before.alias("start"))  # shards x lanes rows
    numbered = laned.withColumn("at", F.row_number().over(Window.partitionBy("shard", "lane").orderBy(order, *names)))
    return (
        numbered.join(starts, ["shard", "lane"])
        .withColumn("slot", F.col("start") + F.col("at") - 1)
        .drop("lane", "at", "start")
    )


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document's doc_id, size, text_crc32, law, shard, slot and grown_shard.

    The law kept is `bytes`: shard sizes are near equal, so grown_shard is null. Equal texts, null and empty
    ones together, share a shard. Repeated rows are rows of their own. An empty table gives no rows.
    """
    rows = sized(documents)
    homes = assign(rows, shards)
    placed = rows.join(homes, "group").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard"
    )
    return slots(placed).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
